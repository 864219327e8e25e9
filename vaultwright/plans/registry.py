"""Registered queries: a Spark callable and, next to it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Input before this date is in the table already, the rest is the new batch.
SPLIT = "1998-07-01"


def earlier(df: DataFrame, date_column: str) -> DataFrame:
    return df.filter(f"{date_column} < TIMESTAMP_NTZ '{SPLIT} 00:00:00'")


def later(df: DataFrame, date_column: str) -> DataFrame:
    return df.filter(f"{date_column} >= TIMESTAMP_NTZ '{SPLIT} 00:00:00'")


def sql_earlier(date_column: str) -> str:
    return f"{date_column} < TIMESTAMP '{SPLIT} 00:00:00'"


def sql_later(date_column: str) -> str:
    return f"{date_column} >= TIMESTAMP '{SPLIT} 00:00:00'"


def sql_digest(*keys: str) -> str:
    """The digits that spread keys over buckets, see ``operators.numbering``."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"substr(md5(concat_ws('|', {text})), 1, 4)"


def sql_rank(*keys: str) -> str:
    """Position of a new key among the new keys."""
    return f"row_number() OVER (ORDER BY {sql_digest(*keys)}, {', '.join(keys)})"
