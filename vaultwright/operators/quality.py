"""Quality reports over whole tables.  Each returns the offending keys or rows.

``fingerprint`` sums up rows in a few numbers that add up over parts, so that what went into a load and what
came out, or a table before and after it, are compared without a join or a shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.functions import column, identity_millis, to_column_type
from vaultwright.spec import KeyedSpec, SatSpec

N_ROWS = "n_rows"
REASON = "reason"


@dataclass(frozen=True)
class Fingerprint:
    """Number of rows, and their hashes by exclusive or and by sum; equal rows count as often as they occur.

    Exclusive or alone cannot see a row that is lost twice or doubled twice, the sum of the upper halves of
    the hashes can.
    """

    n_rows: int
    xor: int
    total: int

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.n_rows + other.n_rows, self.xor ^ other.xor, self.total + other.total)


def fingerprint_columns(columns: Sequence[str]) -> list[Column]:
    """The aggregates of a fingerprint: n_rows, xor and total."""
    key = F.xxhash64(*[column(c) for c in columns]) if columns else F.lit(0).cast("bigint")
    total = F.coalesce(F.sum(F.shiftright(key, 32).cast("decimal(20, 0)")), F.lit(0))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.bit_xor(key), F.lit(0).cast("bigint")).alias("xor"),
        total.alias("total"),
    ]


def fingerprint(rows: DataFrame, columns: Sequence[str]) -> Fingerprint:
    """One aggregate over the rows; one row comes back."""
    found = rows.agg(*fingerprint_columns(columns)).first()
    return Fingerprint(found.n_rows, found.xor, int(found.total))


def load_report(given: DataFrame, output: DataFrame, inserts: DataFrame, table: DataFrame, spec: KeyedSpec) -> DataFrame:
    """One row on a hub or link load: rows in and out, new rows and stored ones, keys by sketch.

    ``all_consumed``: the output has the rows of the input; ``approx_keys`` counts the keys that the table holds by a
    mergeable sketch, within about 2 %, without a shuffle of keys.
    """
    keys = list(spec.keys.values())
    rows_in = given.agg(*fingerprint_columns(list(spec.keys)))
    rows_out = output.agg(*fingerprint_columns(list(spec.keys))).toDF("n_out", "xor_out", "total_out")
    added = inserts.agg(F.count(F.lit(1)).alias("inserted"))
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*[column(k) for k in keys]), 14))
    stored = table.agg(F.count(F.lit(1)).alias("stored"), F.coalesce(sketch, F.lit(0)).alias("approx_keys"))
    same = (F.col("n_rows") == F.col("n_out")) & (F.col("xor") == F.col("xor_out")) & (F.col("total") == F.col("total_out"))
    # Four frames of one row each.
    return rows_in.join(rows_out).join(added).join(stored).select(
        F.col("n_rows").alias("rows_in"),
        F.col("n_out").alias("rows_out"),
        same.alias("all_consumed"),
        "inserted",
        "stored",
        "approx_keys",
    )


def duplicate_keys(table: DataFrame, spec: KeyedSpec) -> DataFrame:
    """Keys that a hub or link holds more than once."""
    keys = [column(c) for c in spec.keys.values()]
    return _repeated(table, keys)


def duplicate_records(table: DataFrame, spec: SatSpec) -> DataFrame:
    """Identities that a satellite holds more than once, from-dates in milliseconds."""
    keys = [column(spec.fk_col)]
    if spec.is_temporal:
        type_ = table.schema[spec.from_col].dataType
        keys.append(identity_millis(column(spec.from_col), type_).alias(f"{spec.from_col}_millis"))
    return _repeated(table, keys)


def _repeated(table: DataFrame, keys: list[Column]) -> DataFrame:
    counts = table.groupBy(*keys).agg(F.count(F.lit(1)).alias(N_ROWS))
    return counts.filter(column(N_ROWS) > F.lit(1))


def unresolved_keys(df: DataFrame, table: DataFrame, spec: KeyedSpec) -> DataFrame:
    """Keys of the input that the table does not hold; empty after a load."""
    spec.check_stream(df)
    parts = [
        to_column_type(
            column(f), df.schema[f].dataType, spec.column_type(df, table, f, c)
        ).alias(c)
        for f, c in spec.keys.items()
    ]
    wanted = df.groupBy(*parts).agg(F.count(F.lit(1)).alias(N_ROWS))
    stored = table.select(*[column(c) for c in spec.keys.values()])
    return wanted.join(stored, list(spec.keys.values()), "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys of a link or satellite that its parent does not hold.

    Child rows are counted per key before they meet the parent, so a key with
    very many rows is one row in the join.
    """
    counts = child.groupBy(column(fk)).agg(F.count(F.lit(1)).alias(N_ROWS))
    return counts.join(parent.select(column(key).alias(fk)), fk, "left_anti")


def invalid_rows(df: DataFrame, spec: KeyedSpec | SatSpec) -> DataFrame:
    """Input rows a load refuses, with the reason for each."""
    spec.check_stream(df)
    blank_is_invalid = isinstance(spec, KeyedSpec)
    fields = list(spec.keys) if blank_is_invalid else [spec.fk_field]
    if isinstance(spec, SatSpec) and spec.is_temporal:
        fields.append(spec.from_field)
    reasons = []
    for name in fields:
        found = F.when(column(name).isNull(), F.lit(f"{name} is NULL"))
        if blank_is_invalid and isinstance(df.schema[name].dataType, T.StringType):
            found = found.when(column(name) == F.lit(""), F.lit(f"{name} is empty"))
        reasons.append(found)
    reason = F.concat_ws("; ", *reasons)
    return df.withColumn(REASON, reason).filter(column(REASON) != F.lit(""))
