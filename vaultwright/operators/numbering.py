"""Technical keys for new rows, numbered in parallel.

A global ``row_number`` would pull every new key through one task.  Here the
keys are spread over 65,536 buckets by a digest of the key.  The keys are
unique, so the buckets are even whatever the data looks like.  Inside a bucket
rows are numbered in key order, and each bucket starts where the ones before it
end.  The number of a key follows from the set of new keys alone: a task that
runs twice, or a plan that is evaluated twice, gives the same numbers.

Numbers in the order of the business keys (``key_order=BY_KEY``) come the same way from key ranges instead
of digests.  The ranges are cut where a sample says, so they are about even; they are written
once with their number, and counts of ranges, not the sample, decide the numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultwright.functions import column
from vaultwright.spec import AUTO_INCREMENT, BY_KEY, SEQUENCE, KeyedSpec
from vaultwright.staging import stage

BUCKET_DIGITS = 4
BUCKETS = 16**BUCKET_DIGITS

_BUCKET = "__bucket"
_RANK = "__rank"
_OFFSET = "__offset"


def key_bucket(keys: list[str]) -> Column:
    """First hexadecimal digits of the MD5 digest of the key parts joined by '|'."""
    text = F.concat_ws("|", *[column(k).cast("string") for k in keys])
    return F.substring(F.md5(text.cast("binary")), 1, BUCKET_DIGITS)


def largest_key(table: DataFrame | None, tech_key: str) -> Column:
    """Largest stored key, 0 for an empty or missing table, as a scalar subquery."""
    if table is None:
        return F.lit(0).cast("bigint")
    largest = table.agg(F.max(column(tech_key)).cast("bigint"))
    return F.coalesce(largest.scalar(), F.lit(0).cast("bigint"))


def add_tech_keys(
    rows: DataFrame,
    keys: list[str],
    name: str,
    spec: KeyedSpec,
    table: DataFrame | None,
    sequence_start: int | None = None,
) -> DataFrame:
    """Add the technical key as column ``name`` to rows that are unique in ``keys``.

    * table maximum: dense, from the largest stored key + 1
    * sequence: dense steps of ``sequence_increment`` from ``sequence_start``
    * auto increment: unique and above the largest stored key, with gaps; needs
      no offsets and so reads the new keys once
    """
    in_bucket = Window.partitionBy(_BUCKET).orderBy(*[column(k) for k in keys])
    in_key_order = spec.key_order == BY_KEY
    if in_key_order:
        ranges = rows.repartitionByRange(*[column(k) for k in keys])
        bucketed = stage(ranges.withColumn(_BUCKET, F.spark_partition_id()), "ranges")
    else:
        bucketed = rows.withColumn(_BUCKET, key_bucket(keys))
    ranked = bucketed.withColumn(_RANK, F.row_number().over(in_bucket).cast("bigint"))

    if spec.key_method == AUTO_INCREMENT:
        bucket_no = F.conv(F.col(_BUCKET), 16, 10).cast("bigint")
        number = (
            largest_key(table, spec.tech_key)
            + (F.col(_RANK) - F.lit(1)) * F.lit(BUCKETS)
            + bucket_no
            + F.lit(1)
        )
        return ranked.withColumn(name, number).drop(_BUCKET, _RANK)

    if table is None or in_key_order:
        sizes = bucketed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    else:
        # New keys come out of a join: with the last rank as size both uses read
        # the same shuffle, and the join runs once.
        sizes = ranked.groupBy(_BUCKET).agg(F.max(_RANK).alias("__n"))
    # At most BUCKETS rows, or shuffle partitions, so one task and a broadcast are safe at any scale.
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFFSET))
    position = F.col(_OFFSET) + F.col(_RANK)
    if spec.key_method == SEQUENCE:
        start = spec.sequence_start if sequence_start is None else sequence_start
        number = F.lit(start) + F.lit(spec.sequence_increment) * (position - F.lit(1))
    else:
        number = largest_key(table, spec.tech_key) + position
    return (
        ranked.join(F.broadcast(offsets), _BUCKET)
        .withColumn(name, number.cast("bigint"))
        .drop(_BUCKET, _RANK, _OFFSET)
    )
