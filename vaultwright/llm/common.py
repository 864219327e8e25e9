"""What several text operators share: words, folds, staging, weighted splits of hot keys."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.staging import discard, free_shuffles, new_folder, stage, staged_for_now

__all__ = [
    "SpanHashes", "WORD", "WORD_PATTERN", "discard", "fold", "free_shuffles", "hash_words", "mix", "mix_one", "new_folder", "rows_of", "shared_bytes",
    "stage", "staged_for_now", "table", "word_spans",
]

# A word is a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Upper case ASCII letters to lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str) -> Column:
    """crc32 of the key as text, modulo 5; a null key counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5).cast("int")


def shared_bytes(df: DataFrame, column: str) -> int:
    """Bytes of UTF-8 in a column, for choosing a number of groups."""
    return df.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[pa.RecordBatch, list[list]]]:
    """Each batch with the named columns as Python lists."""
    for batch in batches:
        yield batch, [batch.column(n).to_pylist() for n in names]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def word_spans(buffer: np.ndarray, separator: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words in bytes of UTF-8."""
    inside = np.zeros(len(buffer) + 2, bool)
    inside[1:-1] = ~(_SPACE if separator is None else separator)[buffer]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


_BASE = 0x5851F42D4C957F2D  # odd, so that powers can be divided out
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            known = np.multiply.accumulate(steps)
        _powers[base] = known
    return known[:n]


class SpanHashes:
    """64-bit hashes of spans of bytes: a prefix polynomial shifted to the span's start, mixed with its length.

    The prefix is worked out once for all spans.  Spans may overlap and must not be empty.
    """

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        self._inverse = _power_table(_INVERSE, n + 1)
        self._prefix = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, n), out=self._prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            value = (self._prefix[ends] - self._prefix[starts]) * self._inverse[starts]
            return mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def hash_words(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans, see ``SpanHashes``."""
    return SpanHashes(buffer)(starts, ends) if len(starts) else np.zeros(0, np.uint64)


_MASK = (1 << 64) - 1


def mix_one(x: int) -> int:
    """``mix`` of a single number."""
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & _MASK
    return x ^ x >> 31
