"""Append-only targets: hubs, links and satellites without stored to-dates.

A target is read as a DataFrame and appended to.  There is one writer per
target at a time, as the loads look up keys before they insert them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vaultwright.staging import read_parquet
from vaultwright.sources.schemas import quoted
from vaultwright.functions import column
from vaultwright.spec import KeyedSpec, TableSpec


@dataclass(frozen=True)
class ParquetTable:
    spark: SparkSession
    path: str

    def read(self) -> DataFrame | None:
        return read_parquet(self.spark, self.path)

    def append(self, rows: DataFrame):
        rows.write.mode("append").parquet(self.path)


@dataclass(frozen=True)
class CatalogTable:
    """A catalog table; ``bucket_by`` co-locates its rows by key for later joins.

    Bucketed by the business keys of a hub or link, or by the foreign key of a satellite, lookups leave
    its rows where they are.  ``path`` keeps the files of a new table there.
    """

    spark: SparkSession
    name: str
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    path: str | None = None

    @classmethod
    def of(cls, spark: SparkSession, spec: TableSpec, **options) -> CatalogTable:
        parts = [quoted(n) for n in (spec.schema, spec.table) if n]
        return cls(spark, ".".join(parts), **options)

    def read(self) -> DataFrame | None:
        return self.spark.table(self.name) if self.spark.catalog.tableExists(self.name) else None

    def key_buckets(self, spec: TableSpec) -> int | None:
        """Number of buckets if the table is bucketed by just the keys that loads look up."""
        keys = spec.keys.values() if isinstance(spec, KeyedSpec) else [spec.fk_col]
        return self.buckets if self.bucket_by and list(self.bucket_by) == list(keys) else None

    def append(self, rows: DataFrame):
        if self.bucket_by:
            # One task writes a bucket, so a load adds one file to each.
            rows = rows.repartition(self.buckets, *[column(c) for c in self.bucket_by])
        writer = rows.write.mode("append").format("parquet")
        if self.path:
            writer = writer.option("path", self.path)
        if self.bucket_by:
            first, *others = self.bucket_by
            writer = writer.bucketBy(self.buckets, first, *others).sortBy(first, *others)
        writer.saveAsTable(self.name)
