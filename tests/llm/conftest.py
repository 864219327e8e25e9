import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = [a + b + c for a in "ba ke li mo tu".split() for b in "ra se ni do gu".split() for c in ("", "ph", "st", "l")]


def prose(seed: int, n: int) -> str:
    """n invented words, different for each seed, in lines of about thirty."""
    out, state = [], seed * 7919 + 17
    for i in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(WORDS[(state >> 33) % len(WORDS)] + (".\n" if i % 30 == 29 else ""))
    return " ".join(out).replace("\n ", "\n").strip()


@pytest.fixture(scope="session")
def documents(spark):
    """Builds the table documents from (doc_id, text) or whole rows."""

    def build(rows, extra=()):
        whole = [r if len(r) == 5 else (r[0], r[1], "en", "s0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(whole, DOCUMENTS)
        return df.withColumns({name: F.lit(name) for name in extra})

    return build


def collected(df, *columns):
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=repr)
