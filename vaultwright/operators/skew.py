"""Decisions that depend on how the keys of the data are spread.

Two facts decide how a lookup is joined, both taken from one aggregate that
returns a single row:

* How large is the set of distinct keys?  Up to ``BROADCAST_BYTES`` it may be
  broadcast: the large side is then filtered or joined where it is, without a
  shuffle.  Beyond that the join is left to a shuffle.
* How many rows has the largest key?  A key with more than ``hot_rows`` rows is
  *hot*.  There can be no more than ``rows / hot_rows`` hot keys, which is what
  makes it safe to broadcast them: with the default of two million rows, 10^12
  rows hold at most 500,000 hot keys.  Any other key fits a task by definition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.functions import column

HOT_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 2**20

# Assumed bytes of one entry in a broadcast hash table, apart from the key itself.
ENTRY_BYTES = 32
# Types of 16 bytes at most.
FIXED_WIDTH = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)

ROWS = "__rows"


def rows_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))


@dataclass(frozen=True)
class KeyStats:
    """Size of a set of distinct keys as broadcast, rows of the largest key, and both numbers."""

    key_bytes: int
    largest: int
    keys: int = 0
    rows: int = 0

    @classmethod
    def of(cls, counts: DataFrame, keys: list[str]) -> KeyStats:
        width = F.lit(ENTRY_BYTES)
        for key in keys:
            if isinstance(counts.schema[key].dataType, FIXED_WIDTH):
                width = width + F.lit(16)
            else:
                width = width + F.octet_length(column(key).cast("string"))
        row = counts.agg(
            F.sum(width.cast("bigint")), F.max(ROWS), F.count(F.lit(1)), F.sum(ROWS)
        ).first()
        return cls(*[value or 0 for value in row])

    def fits(self, broadcast_bytes: int) -> bool:
        return self.key_bytes <= broadcast_bytes

    def has_hot(self, hot_rows: int | None) -> bool:
        return hot_rows is not None and self.largest > hot_rows


def hot_keys(counts: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: few enough to be broadcast."""
    return counts.filter(F.col(ROWS) > F.lit(hot_rows)).select(*keys)


def to_buckets(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Deal rows as a table bucketed by ``keys`` is, so that a join with it moves no stored row."""
    return rows.repartition(buckets, *[column(k) for k in keys])


# Bits of one bitmap of Spark's bitmap functions, and of one word that is tested.
BITMAP_BITS, WORD_BITS = 1 << 15, 64
# A bitmap worth its while has this many bits per key: some 12 % of other keys pass at 8, 6 % at 16.
BITS_PER_KEY = (8, 16)
_PLACE, _BITMAP, _NUMBER = "__place", "__bitmap", "__number"


def key_bitmap(wanted: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Hashes of the wanted keys as one row per 32,768 bits: its number, and the bits as 64-bit words."""
    place = F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(bits))
    chunks = (
        wanted.select(place.alias(_PLACE))
        .groupBy(F.floor(F.col(_PLACE) / BITMAP_BITS).cast("int").alias(_NUMBER))
        .agg(F.bitmap_construct_agg(F.col(_PLACE) % BITMAP_BITS).alias(_BITMAP))
    )

    def word(i):
        # Bits are numbered within bytes, so bytes in reverse order make a word with bit n in place n.
        eight = F.reverse(F.sequence(F.lit(1), F.lit(8)))
        digits = F.array_join(F.transform(eight, lambda b: F.hex(F.substring(F.col(_BITMAP), i * 8 + b, 1))), "")
        return F.conv(digits, 16, -10).cast("bigint")

    words = F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // WORD_BITS - 1)), word)
    return chunks.select(_NUMBER, words.alias(_BITMAP))


def maybe_wanted(
    stored: DataFrame, wanted: DataFrame, keys: list[str], n_wanted: int, bitmap_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Stored rows whose key may be wanted, by a bitmap of hashes in a broadcast of ``bitmap_bytes`` at most.

    All rows of wanted keys pass and a few others, which the join that follows removes.
    What it saves is their shuffle.  With so many wanted keys that most others would pass, all rows do.
    """
    least, best = BITS_PER_KEY
    bits = max(BITMAP_BITS, 1 << (n_wanted * best).bit_length())
    bits = min(bits, 1 << (bitmap_bytes * 8).bit_length() - 1)
    if bits < n_wanted * least:
        return stored
    place = F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(bits))
    number = F.floor(place / BITMAP_BITS).cast("int")
    within = (place % BITMAP_BITS).cast("int")
    bitmap = F.broadcast(key_bitmap(wanted, keys, bits))
    columns = [column(c) for c in stored.columns]
    placed = stored.withColumns({_NUMBER: number, _PLACE: within})
    word = F.get(_BITMAP, F.floor(F.col(_PLACE) / WORD_BITS).cast("int"))
    hit = F.getbit(word, F.col(_PLACE) % WORD_BITS) == 1
    return placed.join(bitmap, _NUMBER).filter(hit).select(*columns)


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    counts: DataFrame,
    stats: KeyStats,
    hot_rows: int | None,
    broadcast_bytes: int,
) -> DataFrame:
    """Inner join of rows with a lookup that is unique in ``keys``."""
    if stats.fits(broadcast_bytes):
        return rows.join(F.broadcast(lookup), keys)
    if not stats.has_hot(hot_rows):
        return rows.join(lookup, keys)
    # Rows of hot keys stay where they are, the others are shuffled.  Long keys are checked again:
    # the number of hot keys is bounded, their bytes are not.
    if not KeyStats.of(counts.filter(F.col(ROWS) > F.lit(hot_rows)), keys).fits(broadcast_bytes):
        return rows.join(lookup, keys)
    hot = F.broadcast(hot_keys(counts, keys, hot_rows))
    hot_lookup = F.broadcast(lookup.join(hot, keys, "left_semi"))
    stay = rows.join(hot_lookup, keys)
    move = rows.join(hot, keys, "left_anti").join(lookup, keys)
    return stay.unionByName(move)
