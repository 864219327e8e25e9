"""A named sequence for technical keys: a small state table next to the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vaultwright.staging import read_parquet


@dataclass(frozen=True)
class Sequence:
    """Hands out ranges of numbers.  A range that is not used up leaves a gap.

    The state is one row per range; the largest end is where the next one starts.
    """

    spark: SparkSession
    path: str
    start: int = 1
    increment: int = 1

    def next_value(self) -> int:
        state = read_parquet(self.spark, self.path)
        if state is None:
            return self.start
        past_end = F.max("past_end") if self.increment > 0 else F.min("past_end")
        return state.agg(past_end).first()[0]

    def reserve(self, count: int) -> int:
        """Reserve ``count`` numbers and return the first."""
        first = self.next_value()
        past_end = first + count * self.increment
        self.spark.range(1).select(
            F.lit(first).cast("bigint").alias("first"),
            F.lit(past_end).cast("bigint").alias("past_end"),
        ).write.mode("append").parquet(self.path)
        return first
