"""Quality rules against a plain restatement, and the sketches' error and merging."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import collected, prose
from vaultwright.llm import quality_rules as q
from vaultwright.llm.queries import TEXT_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for w in words for c in w),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
    )


TEXTS = [
    None, "", " \t\n", "a", "é ü#*", "a b c a b c", "x x x x x", "one\none\n\none\ntwo", "a\x1cb c d", "|<>&%$ !!",
    "a b c d a b c e b c d", "word " * 60, prose(1, 80) + "\n" + prose(1, 80), "long" * 5000, prose(2, 5000),
]


def test_base_counts(documents):
    found = q.judge(documents(list(enumerate(TEXTS))))
    expected = sorted(((i, *base(t)) for i, t in enumerate(TEXTS)), key=repr)
    assert collected(found, "doc_id", *q.BASE) == expected


def test_base_rules_and_clashing_columns(documents):
    rows = [(1, prose(1, 60)), (2, prose(2, 49)), (3, "a b c " * 30), (4, None), (1, prose(1, 60))]
    docs = documents(rows, extra=["kept", "n_words", "median", "m", "measure", "rows"])
    kept = q.keep(docs)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1, 1]


def test_junk_goes_and_clean_texts_stay(documents):
    clean = [(i, prose(i, 120), "en", f"s{i % 2}", 0) for i in range(60)]
    shouted = [(100 + i, prose(i, 120).upper().replace(" ", "!! "), "en", "s0", 0) for i in range(12)]
    symbols = [(200 + i, prose(i, 120).replace(" ", "### "), None, None, 0) for i in range(3)]
    found = {r["doc_id"]: r["kept"] for r in q.judge(documents(clean + shouted + symbols)).collect()}
    assert all(found[i] for i in range(60))
    assert not any(found[100 + i] for i in range(12))


def test_empty_table(documents):
    assert q.judge(documents([])).count() == 0
    assert q.keep(documents([])).count() == 0


def test_bucket_error_and_merging(spark):
    values = [random.Random(5).randrange(0, 10**6) for _ in range(300)] + list(range(70))
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", q.bucket(F.col("v")).alias("b")).collect()
    assert all(r["b"] <= r["v"] and r["v"] - r["b"] <= r["v"] / 32 for r in rows)
    measured = spark.createDataFrame(
        [(i % 3, 1, *[(i * 7919 + k) % 1000 for k in range(len(q.MEASURES))]) for i in range(200)],
        ["part", "n_words", *[m.name for m in q.MEASURES]],
    )
    merged = q.merge(q.sketch(measured, "part"))
    whole = q.sketch(measured).select("measure", "bucket", "n")
    assert collected(merged, "measure", "bucket", "n") == collected(whole)


@pytest.mark.parametrize("name", ["op10_quality_rules"])
def test_query_over_the_table(spark, data, name):
    found = TEXT_QUERIES[name](spark, data)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert collected(found, "doc_id", *q.BASE) == sorted(((i, *base(t)) for i, t in texts.items()), key=repr)
    for r in found.collect():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
