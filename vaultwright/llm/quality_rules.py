"""Quality rules whose cutoffs follow the corpus, per language and source.

Every text is measured (shares in thousandths, whole numbers only).  The values of
each (language, source) go into a quantile sketch: counts per bucket, where a bucket
keeps the leading six bits of a value.  Such sketches merge by adding counts, in any
order and number, and a quantile read from them is at most 1/32 too low.  A measure
is out of line when it leaves ``median +- reach * spread``; the spread is the distance
of the median to the quantile `low` below it, at least the measure's own least spread, so
that up to half of a source may be junk.  Sources with fewer than ``least_rows``
measured texts use the merged sketch of their language.

Defined cases: a null or empty text has no words, fails the base rules and takes no part
in the sketches; null languages and sources are values of their own; equal rows are judged
alike; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vaultwright.llm.common import WORD, stage

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Measure:
    """``low_too``: values far below the median are out of line as well."""

    name: str
    least_spread: int
    low_too: bool = False


MEASURES = (
    Measure("symbol_share", 30),
    Measure("dup_line_share", 120),
    Measure("repeat_share", 100),
    Measure("capital_share", 60),
    Measure("shout_share", 20),
    Measure("word_length", 500, low_too=True),
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    low: float = 0.05
    reach: int = 4
    least_rows: int = 100


_SYMBOL_CODES = [ord(c) for c in SYMBOLS]
_MEASURED = T.StructType(
    [T.StructField(n, T.LongType()) for n in [*BASE, *(m.name for m in MEASURES)]]
)


def _measure(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * (len(BASE) + len(MEASURES))
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return (0,) * (len(BASE) + len(MEASURES))
    codes = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    spaces = int(codes[0x20] + codes[0x09:0x0E].sum())
    chars = len(text) - spaces
    symbols = int(codes[_SYMBOL_CODES].sum())
    lines = [line for line in text.split("\n") if WORD.search(line)] if "\n" in text else [text]
    repeats = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, k in Counter(windows).items() if k > 1}
        last = 0
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(i, last)
                last = i + 3
    capitals, small = int(codes[65:91].sum()), int(codes[97:123].sum())
    return (
        n, chars, symbols, repeats, repeated,
        1000 * symbols // n,
        1000 * repeats // len(lines),
        1000 * repeated // n,
        1000 * capitals // max(1, capitals + small),
        1000 * int(codes[33]) // n,
        1000 * chars // n,
    )


def measure(docs: DataFrame, text: str = "text") -> Column:
    """A struct of the base counts and the measures of a text column."""

    @F.pandas_udf(_MEASURED)
    def measured(texts):
        import pandas as pd

        return pd.DataFrame([_measure(t) for t in texts], columns=_MEASURED.names)

    return measured(docs[text].cast("string"))


def bucket(value: Column) -> Column:
    """The value with all but its six leading bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(measured: DataFrame, *groups: str) -> DataFrame:
    """Counts per group, measure and bucket."""
    values = F.explode(
        F.array(*[F.struct(F.lit(m.name).alias("measure"), F.col(m.name).alias("value")) for m in MEASURES])
    )
    return (
        measured.filter("n_words > 0")
        .select(*groups, values.alias("v"))
        .groupBy(*groups, F.col("v.measure").alias("measure"), bucket(F.col("v.value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merge(sketches: DataFrame, *groups: str) -> DataFrame:
    return sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def cutoffs(sketches: DataFrame, groups: list[str], rules: Rules) -> DataFrame:
    """One row per group: ``rows`` and, per measure, ``<measure>_low`` and ``<measure>_high``."""
    whole = Window.partitionBy(*groups, "measure")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketches.withColumn("total", F.sum("n").over(whole)).withColumn("below", F.sum("n").over(upto))
    at = lambda percent: F.min(F.when(F.col("below") * 100 >= F.col("total") * percent, F.col("bucket")))
    quantiles = ranked.groupBy(*groups, "measure").agg(
        F.max("total").alias("rows"),
        at(50).alias("median"),
        at(round(100 * rules.low)).alias("lower"),
    )
    out = []
    for m in MEASURES:
        mine = F.col("measure") == m.name
        spread = F.greatest(F.col("median") - F.col("lower"), F.lit(m.least_spread)) * rules.reach
        low = F.col("median") - spread if m.low_too else F.lit(-1)
        out.append(F.max(F.when(mine, F.col("median") + spread)).alias(f"{m.name}_high"))
        out.append(F.max(F.when(mine, low)).alias(f"{m.name}_low"))
    return quantiles.groupBy(*groups).agg(F.max("rows").alias("rows"), *out)


def group_cutoffs(measured: DataFrame, rules: Rules) -> DataFrame:
    """Cutoffs for every (lang, source) that occurs, its own or those of its language."""
    own = stage(sketch(measured, "lang", "source"), "quality-sketch")
    sources = cutoffs(own, ["lang", "source"], rules)
    langs = cutoffs(merge(own, "lang"), ["lang"], rules)
    names = [f"{m.name}_{side}" for m in MEASURES for side in ("high", "low")]
    small = F.col("s.rows") < rules.least_rows
    joined = sources.alias("s").join(langs.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")))
    return joined.select(
        "s.lang", "s.source", *[F.when(small, F.col(f"l.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in names]
    )


def verdicts(measured: DataFrame, limits: DataFrame, rules: Rules) -> DataFrame:
    """``measured`` with base_failed, failed (names of the measures out of line) and kept.

    The limits have a row per source: Spark broadcasts them when they turn out small, else
    the join is shuffled, where adaptive execution splits the rows of a hot source.
    """
    names = [f"{m.name}_{side}" for m in MEASURES for side in ("high", "low")]
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *names)
    joined = measured.join(
        limits,
        measured["lang"].eqNullSafe(F.col("_lang")) & measured["source"].eqNullSafe(F.col("_source")),
        "left",
    )
    failed = F.filter(
        F.array(
            *[
                F.when((F.col(m.name) > F.col(f"{m.name}_high")) | (F.col(m.name) < F.col(f"{m.name}_low")), m.name)
                for m in MEASURES
            ]
        ),
        lambda name: name.isNotNull(),
    )
    base = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    return joined.withColumns({"base_failed": base, "failed": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)
    )


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per document: doc_id, lang, source, the base counts and measures, base_failed, failed, kept."""
    measured = stage(
        docs.select("doc_id", "lang", "source", measure(docs).alias("m")).select("doc_id", "lang", "source", "m.*"),
        "quality-measures",
    )
    return verdicts(measured, group_cutoffs(measured, rules), rules)


def keep(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, unchanged.

    The texts are measured twice, for the cutoffs and for the verdicts, so that they need
    neither be shuffled nor written in between.
    """
    measured = docs.select("lang", "source", measure(docs).alias("m")).select("lang", "source", "m.*")
    limits = stage(group_cutoffs(measured, rules), "quality-limits")
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    rows = docs.select(whole, "lang", "source", measure(docs).alias("m")).select("_row", "lang", "source", "m.*")
    return verdicts(rows, limits, rules).filter("kept").select("_row.*")
