"""Hub and link loads.

Both find the technical key of every input row, give unseen keys a new one and
return the input with the key appended.  They differ in the number of key
parts only, so they share one function.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.functions import (
    audit_columns,
    check_order,
    column,
    is_blank,
    to_column_type,
    valid_or_fail,
)
from vaultwright.operators.numbering import add_tech_keys
from vaultwright.operators.skew import (
    BROADCAST_BYTES,
    HOT_ROWS,
    KeyStats,
    join_lookup,
    maybe_wanted,
    rows_per_key,
    to_buckets,
)
from vaultwright.spec import SEQUENCE, HubSpec, KeyedSpec, LinkSpec, type_of

_FIRST = "__first"
_TECH_KEY = "__tech_key"


@dataclass
class KeyedLoad:
    """Result of a hub or link load.

    ``inserts``  the rows to append to the table
    ``output``   the input rows with the technical key appended
    ``rejects``  the input rows with an invalid key (None unless asked for)
    ``stats``    sizes that decide how keys are joined, worked out when first needed
    ``known``    the stored keys that the input asks for (None without a table)
    """

    inserts: DataFrame
    rejects: DataFrame | None
    known: DataFrame | None
    _rows: DataFrame = field(repr=False)
    _stats: Callable[[], KeyStats] = field(repr=False)
    _attach: Callable[[DataFrame | None, KeyStats], DataFrame] = field(repr=False)

    @cached_property
    def stats(self) -> KeyStats:
        return self._stats()

    @cached_property
    def output(self) -> DataFrame:
        return self._attach(None, self.stats)

    def valid(self, df: DataFrame) -> DataFrame:
        """The rows of the input that take part: all of them unless invalid ones are rejected."""
        return df if self.rejects is None else self._rows.select(*df.columns)

    def attach(self, df: DataFrame) -> DataFrame:
        """Another DataFrame with the same key fields, with the technical key appended."""
        return self._attach(df, self.stats)


@dataclass(frozen=True)
class _Input:
    rows: DataFrame
    rejects: DataFrame | None
    columns: list[str]
    keys: list[str]


def _key_name(i: int) -> str:
    return f"__key{i}"


def _prepare(df: DataFrame, table: DataFrame | None, spec: KeyedSpec, on_invalid: str) -> _Input:
    """Decode and check the input; add the key parts in their column types."""
    if on_invalid not in ("error", "reject"):
        raise ValueError("on_invalid is 'error' or 'reject'")
    spec.check_stream(df)
    spec.check_table(table)

    blank = {f: is_blank(column(f), type_of(df, f)) for f in spec.keys}
    any_blank = None
    for test in blank.values():
        any_blank = test if any_blank is None else any_blank | test

    rejects = None
    rows = df
    if on_invalid == "reject":
        rejects = df.filter(any_blank)
        rows = df.filter(~any_blank)

    # Binary input mapped to another type leaves the load decoded.
    decoded = {}
    for stream_field, col in spec.mapping():
        source = type_of(df, stream_field)
        target = spec.column_type(df, table, stream_field, col)
        if isinstance(source, T.BinaryType) and not isinstance(target, T.BinaryType):
            decoded[stream_field] = to_column_type(column(stream_field), source, target)

    key_parts = []
    for i, (stream_field, col) in enumerate(spec.keys.items()):
        target = spec.column_type(df, table, stream_field, col)
        part = to_column_type(column(stream_field), type_of(df, stream_field), target)
        if on_invalid == "error":
            message = f"{spec.table}: key field {stream_field} is NULL or empty"
            part = valid_or_fail(part, blank[stream_field], message)
        key_parts.append(part.alias(_key_name(i)))

    out = [decoded.get(c, column(c)).alias(c) for c in df.columns]
    keys = [_key_name(i) for i in range(len(spec.keys))]
    return _Input(rows.select(*out, *key_parts), rejects, df.columns, keys)


def _lookup(table, spec, wanted, keys, stats, broadcast_bytes, stored_buckets=None) -> DataFrame:
    """Stored keys that the input asks for, one row each.

    When the wanted keys are few they are broadcast and filter the table while
    it is scanned.  More of them go to the buckets of a bucketed table; before any other table is
    shuffled, a bitmap of their hashes filters it.  A key stored twice (a defect, see ``duplicate_keys``) yields
    its smallest technical key, so it cannot multiply rows.
    """
    parts = [column(c).alias(k) for k, c in zip(keys, spec.keys.values())]
    stored = table.select(*parts, column(spec.tech_key).cast("bigint").alias(_TECH_KEY))
    wanted = wanted.select(*keys)
    if stats.fits(broadcast_bytes):
        wanted = F.broadcast(wanted)
    elif not stored_buckets:
        stored = maybe_wanted(stored, wanted, keys, stats.keys)
    return (
        stored.join(wanted, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.min(_TECH_KEY).alias(_TECH_KEY))
    )


def _order_columns(
    order_by: Sequence[str | Column] | None, default: Sequence[str]
) -> list[Column]:
    if order_by is None:
        return [column(c) for c in default]
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [column(c) if isinstance(c, str) else c for c in order_by]


def load_keyed(
    df: DataFrame,
    table: DataFrame | None,
    spec: KeyedSpec,
    *,
    order_by: Sequence[str | Column] | None = None,
    load_ts: datetime | None = None,
    on_invalid: str = "error",
    sequence_start: int | None = None,
    stored_buckets: int | None = None,
    hot_rows: int | None = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> KeyedLoad:
    """Load a hub or link from ``df`` into ``table`` (None: not there yet).

    Of several rows with the same unseen key the first in ``order_by`` gives the
    other attributes, ties and the default are decided by the attributes
    themselves, ascending.  A stored key never changes.

    A sequence does not look at the table, so a load into one needs to be told where the
    numbers go on: ``sequence_start``, as ``Sequence.reserve`` returns it.

    ``stored_buckets`` says that ``table`` is bucketed by its key columns, in this order: keys too many for
    a broadcast are then shuffled to the buckets, and the stored rows stay where they are.
    """
    check_order(order_by)
    if spec.key_method == SEQUENCE and table is not None and sequence_start is None:
        raise ValueError(f"{spec.table}: a sequence needs sequence_start when the table has rows already")
    given = _prepare(df, table, spec, on_invalid)
    rows, keys = given.rows, given.keys
    others = {
        c: to_column_type(column(f), type_of(rows, f), spec.column_type(df, table, f, c))
        for f, c in spec.others.items()
    }

    # Partial aggregation makes this one row per key and task before the shuffle.
    counts = wanted = rows_per_key(rows, keys)
    stats = cache(lambda: KeyStats.of(counts, keys))
    if table is None:
        known, unseen = None, wanted
    else:
        if stored_buckets and not stats().fits(broadcast_bytes):
            wanted = to_buckets(wanted, keys, stored_buckets)
        known = _lookup(table, spec, wanted, keys, stats(), broadcast_bytes, stored_buckets)
        # Not an anti join: with the technical key in every use, all of them read
        # one and the same shuffle of the stored keys.
        unseen = wanted.join(known, keys, "left").filter(F.col(_TECH_KEY).isNull())

    numbered = add_tech_keys(unseen.select(*keys), keys, _TECH_KEY, spec, table, sequence_start)
    new = numbered
    if others:
        order = _order_columns(order_by, [])
        ranked = [o.alias(f"o{i}") for i, o in enumerate(order)]
        ranked += [v.alias(f"v{i}") for i, v in enumerate(others.values())]
        fresh = rows
        if known is not None and stats().fits(broadcast_bytes):
            # Few keys: rows of stored ones are left out where they are read.
            fresh = rows.join(F.broadcast(known.select(*keys)), keys, "left_anti")
        first = fresh.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias(_FIRST))
        new = numbered.join(first, keys)

    stored_form = [column(k).alias(c) for k, c in zip(keys, spec.keys.values())]
    stored_form += [F.col(f"{_FIRST}.v{i}").alias(c) for i, c in enumerate(others)]
    stored_form += audit_columns(spec, load_ts)
    inserts = new.select(*stored_form, F.col(_TECH_KEY).alias(spec.tech_key))

    lookup = numbered if known is None else known.unionByName(numbered)

    def attach(other: DataFrame | None, sizes: KeyStats) -> DataFrame:
        to = given if other is None else _prepare(other, table, spec, on_invalid)
        joined = join_lookup(to.rows, lookup, keys, wanted, sizes, hot_rows, broadcast_bytes)
        return _with_key(joined, to, spec)

    return KeyedLoad(inserts, given.rejects, known, given.rows, stats, attach)


def _with_key(joined: DataFrame, given: _Input, spec: KeyedSpec) -> DataFrame:
    key = F.col(_TECH_KEY).alias(spec.key_field)
    return joined.select(*[column(c) for c in given.columns], key)


def attach_keys(
    df: DataFrame,
    table: DataFrame,
    spec: KeyedSpec,
    *,
    on_invalid: str = "error",
    hot_rows: int | None = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    stored_buckets: int | None = None,
    stats: KeyStats | None = None,
) -> DataFrame:
    """Look up stored keys only: the input rows whose key is in the table, with it.

    After a load has been written this gives the same rows as its ``output``
    without numbering anything again.  ``stats`` of that load save working them
    out once more.
    """
    given = _prepare(df, table, spec, on_invalid)
    rows, keys = given.rows, given.keys
    wanted = rows_per_key(rows, keys)
    stats = stats or KeyStats.of(wanted, keys)
    if stored_buckets and not stats.fits(broadcast_bytes):
        wanted = to_buckets(wanted, keys, stored_buckets)
    known = _lookup(table, spec, wanted, keys, stats, broadcast_bytes, stored_buckets)
    joined = join_lookup(rows, known, keys, wanted, stats, hot_rows, broadcast_bytes)
    return _with_key(joined, given, spec)


def load_hub(df: DataFrame, table: DataFrame | None, spec: HubSpec, **options) -> KeyedLoad:
    """Load a hub; see ``load_keyed`` for the options."""
    if not isinstance(spec, HubSpec):
        raise ValueError("load_hub needs a HubSpec")
    return load_keyed(df, table, spec, **options)


def load_link(df: DataFrame, table: DataFrame | None, spec: LinkSpec, **options) -> KeyedLoad:
    """Load a link: a hub load over two or more hub keys."""
    if not isinstance(spec, LinkSpec):
        raise ValueError("load_link needs a LinkSpec")
    return load_keyed(df, table, spec, **options)
