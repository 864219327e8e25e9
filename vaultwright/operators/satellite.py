"""Satellite loads: static, as is, idempotent, with or without closing dates.

The stored records of the parents in the batch and the new records are put on
one timeline per parent.  Window functions over that timeline decide which new
records are kept and which validity ends move.

A parent with few records is one window partition, and everything after the one
shuffle by parent happens in place.  A *hot* parent (more than ``hot_rows``
records) is cut into time slices.  Identity is one record per millisecond, so a
slice of 2^22 ms (about 70 minutes) holds at most four million records however
hot the parent is.  What a slice must know of its neighbours is their first
and last record, exchanged through one summary row per slice; a tree over the
summaries keeps them, too, out of one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.functions import (
    audit_columns,
    check_order,
    column,
    comparable,
    empty_to_null,
    identity_millis,
    to_column_type,
    valid_or_fail,
)
from vaultwright.operators.skew import (
    BROADCAST_BYTES,
    HOT_ROWS,
    KeyStats,
    hot_keys,
    maybe_wanted,
    rows_per_key,
    to_buckets,
)
from vaultwright.staging import stage
from vaultwright.spec import SatSpec

SLICE_MILLIS = 2**22
# Summaries of a parent's slices that meet in one window.
FANOUT = 1024

# Working columns: parent key, from-date and its milliseconds, stored flag, slice.
FK, FROM, MS, STORED, SLICE = "__fk", "__from", "__ms", "__stored", "__slice"
# Whether a stored record is its parent's current one.
OPEN = "__open"
# Neighbours: has a record before, repeats it, is repeated by the next one; the next one.
HAS_PREV, REPEATS, REPEATED, NEXT = "__has_prev", "__repeats", "__repeated", "__next"
# First and last record of a slice, the last one before it and the first one after it.
HEAD, TAIL, BEFORE, AFTER = "__head", "__tail", "__before", "__after"
# Per parent: where its first run of equal records ends, and its first stored record.
FIRST_CHANGE, FIRST_STORED = "__first_change", "__first_stored"

IS_CLOSING, WAS_OPEN = "is_closing", "was_open"
# Columns of a satellite store: open or closed, and the to-date that a record was stored with, which
# is no earlier than the one that counts now.
STATE, ENDS = "_state", "_ends"


@dataclass(frozen=True)
class SatLoad:
    """Result of a satellite load.

    ``output``    the input, unchanged
    ``inserts``   records to append
    ``closings``  stored records whose to-date moves: fk, from-date, new to-date
                  (None unless closing dates are on)
    ``rejects``   input rows without foreign key or from-date (None unless asked for)
    ``changes``   inserts and closings in one DataFrame, told apart by the flags
                  ``is_closing`` and ``was_open``; one evaluation gives both
    ``dropped``   identities of new records that repeat the one before them: fk, from-date
                  (None unless asked for)
    """

    output: DataFrame
    inserts: DataFrame
    closings: DataFrame | None = None
    rejects: DataFrame | None = None
    changes: DataFrame | None = None
    dropped: DataFrame | None = None


class _Names:
    """Working names of the mapped columns, so that no table name can clash."""

    def __init__(self, spec: SatSpec, n_order: int):
        self.attributes = {c: f"__a{i}" for i, c in enumerate(spec.attributes.values())}
        self.meta = {c: f"__m{i}" for i, c in enumerate(spec.meta.values())}
        self.order = [f"__o{i}" for i in range(n_order)]

    @property
    def tie_break(self) -> list[str]:
        return [*self.order, FROM, *self.attributes.values(), *self.meta.values()]


def load_satellite(
    df: DataFrame,
    table: DataFrame | None,
    spec: SatSpec,
    *,
    order_by: Sequence[str | Column] | None = None,
    load_ts: datetime | None = None,
    on_invalid: str = "error",
    lookback: str | None = None,
    stored_buckets: int | None = None,
    handled: DataFrame | None = None,
    with_dropped: bool = False,
    hot_rows: int | None = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    slice_millis: int = SLICE_MILLIS,
) -> SatLoad:
    """Load a satellite from ``df`` into ``table`` (None: not there yet).

    Of several input rows with the same identity the first in ``order_by`` wins;
    ties and the default are decided by the mapped columns, ascending.  One call
    is one batch: the idempotent rules look at the stored records and at all
    rows of the call together.

    ``lookback`` leaves out stored records that cannot matter, with the same
    result: ``"from_date"`` looks up, per parent, the last record before its
    first new one; ``"to_date"`` skips, while scanning, records that ended before
    the first new one of the batch, and trusts that stored to-dates are complete.

    ``stored_buckets`` says that ``table`` is bucketed by its foreign key: a batch with too many parents
    for a broadcast is then shuffled to the buckets, and the stored rows stay where they are.

    ``handled`` holds identities (columns of the table) that take no part any more, such as those which
    earlier loads dropped; ``with_dropped`` returns those that this one drops.
    """
    if lookback not in (None, "from_date", "to_date"):
        raise ValueError("lookback is None, 'from_date' or 'to_date'")
    if lookback == "to_date" and not spec.uses_to_date:
        raise ValueError(f"{spec.table}: has no to-date to look back with")
    spec.check_stream(df)
    spec.check_table(table)
    check_order(order_by)
    batch, rejects, names = _batch(df, table, spec, order_by, on_invalid)
    if handled is not None:
        batch = batch.join(_stored_keys(handled, spec), [FK, MS], "left_anti")

    counts = rows_per_key(batch, [FK])
    parents = few = None
    if table is not None:
        of_batch = KeyStats.of(counts, [FK])
        few = of_batch.fits(broadcast_bytes)
        parents = F.broadcast(counts.select(FK)) if few else counts.select(FK)
    in_place = bool(stored_buckets) and few is False
    if in_place:
        parents = to_buckets(parents, [FK], stored_buckets)

    def of_parents(stored):
        if stored is None:
            return None
        if not few and not in_place:
            stored = maybe_wanted(stored, parents, [FK], of_batch.keys)
        return _of_parents(stored, parents)


    if not spec.is_temporal or not (spec.idempotent or spec.uses_to_date):
        identity = [FK, MS] if spec.is_temporal else [FK]
        inserts = _unseen(batch, of_parents(_stored_keys(table, spec)), identity, names)
        return SatLoad(df, _table_form(inserts, df, table, spec, names, load_ts), None, rejects)

    if table is not None and lookback == "to_date":
        first = batch.agg(F.min(FROM)).scalar()
        if ENDS in table.columns:
            table = table.filter(F.col(ENDS) >= first)  # tested while scanning
        table = table.filter(column(spec.to_date_col) >= first)
    stored = of_parents(_stored(table, spec, names))
    if stored is not None:
        if lookback == "from_date":
            stored = _since(batch, stored, few, slice_millis)
        counts = rows_per_key(batch.select(FK).unionAll(stored.select(FK)), [FK])
    if hot_rows is not None:
        stats = KeyStats.of(counts, [FK])

    if hot_rows is not None and stats.has_hot(hot_rows):
        rows = _union(stored, batch, names)
        hot = F.broadcast(stage(hot_keys(counts, [FK], hot_rows), "hot"))
        kept, dropped = _timelines(rows.join(hot, FK, "left_anti"), spec, names, with_dropped)
        sliced = _sliced_timelines(rows.join(hot, FK, "left_semi"), spec, names, slice_millis, with_dropped)
        kept = kept.unionByName(sliced[0])
        dropped = None if dropped is None else dropped.unionByName(sliced[1])
    else:
        # The union of two sides that are dealt alike is so as well.
        rows = _union(stored, to_buckets(batch, [FK], stored_buckets) if in_place else batch, names)
        kept, dropped = _timelines(rows, spec, names, with_dropped, in_place)
    if dropped is not None:
        dropped = dropped.select(F.col(FK).alias(spec.fk_col), F.col(FROM).alias(spec.from_col))

    if not spec.uses_to_date:
        new = kept.filter(~F.col(STORED))
        return SatLoad(df, _table_form(new, df, table, spec, names, load_ts), None, rejects, None, dropped)

    followed_by_new = ~F.coalesce(F.col(f"{NEXT}.stored"), F.lit(True))
    changed = kept.filter(~F.col(STORED) | followed_by_new)
    flags = [F.col(STORED).alias(IS_CLOSING), F.col(OPEN).alias(WAS_OPEN)]
    changes = _table_form(changed, df, table, spec, names, load_ts, flags)
    inserts = changes.filter(~F.col(IS_CLOSING)).drop(IS_CLOSING, WAS_OPEN)
    closings = changes.filter(F.col(IS_CLOSING)).select(
        *[column(c) for c in (spec.fk_col, spec.from_col, spec.to_date_col)]
    )
    return SatLoad(df, inserts, closings, rejects, changes, dropped)


# -- input and stored records ------------------------------------------------


def _batch(df, table, spec, order_by, on_invalid):
    if on_invalid not in ("error", "reject"):
        raise ValueError("on_invalid is 'error' or 'reject'")
    required = [spec.fk_field] + ([spec.from_field] if spec.is_temporal else [])
    rejects, rows = None, df
    if on_invalid == "reject":
        invalid = column(required[0]).isNull()
        for name in required[1:]:
            invalid = invalid | column(name).isNull()
        rejects, rows = df.filter(invalid), df.filter(~invalid)

    def checked(name, value):
        if on_invalid == "reject":
            return value
        return valid_or_fail(value, column(name).isNull(), f"{spec.table}: {name} is NULL")

    def mapped(stream_field, col, blank_is_null):
        source = df.schema[stream_field].dataType
        target = spec.column_type(df, table, stream_field, col)
        value = to_column_type(column(stream_field), source, target)
        return empty_to_null(value, target) if blank_is_null else value

    order = [] if order_by is None else order_by
    if isinstance(order, (str, Column)):
        order = [order]
    names = _Names(spec, len(order))

    select = [checked(spec.fk_field, column(spec.fk_field).cast("bigint")).alias(FK)]
    if spec.is_temporal:
        from_type = _from_type(df, table, spec)
        start = checked(spec.from_field, mapped(spec.from_field, spec.from_col, False))
        select += [start.alias(FROM), identity_millis(start, from_type).alias(MS)]
    for stream_field, col in spec.attributes.items():
        select.append(mapped(stream_field, col, True).alias(names.attributes[col]))
    for stream_field, col in spec.meta.items():
        select.append(mapped(stream_field, col, False).alias(names.meta[col]))
    for name, key in zip(names.order, order):
        select.append((column(key) if isinstance(key, str) else key).alias(name))
    return rows.select(*select), rejects, names


def _from_type(df, table, spec) -> T.DataType:
    return spec.column_type(df, table, spec.from_field, spec.from_col)


def _stored_keys(table, spec) -> DataFrame | None:
    if table is None:
        return None
    keys = [column(spec.fk_col).cast("bigint").alias(FK)]
    if spec.is_temporal:
        type_ = table.schema[spec.from_col].dataType
        keys.append(identity_millis(column(spec.from_col), type_).alias(MS))
    return table.select(*keys)


def _stored(table, spec, names) -> DataFrame | None:
    """Stored records without meta and audit columns: only what is compared."""
    if table is None:
        return None
    type_ = table.schema[spec.from_col].dataType
    select = [
        column(spec.fk_col).cast("bigint").alias(FK),
        column(spec.from_col).alias(FROM),
        identity_millis(column(spec.from_col), type_).alias(MS),
    ]
    for col, name in names.attributes.items():
        select.append(empty_to_null(column(col), table.schema[col].dataType).alias(name))
    if spec.uses_to_date:
        # A store says itself which records are open; the date depends on flag and time zone.
        by_date = column(spec.to_date_col) == F.lit(spec.max_date)
        is_open = column(STATE) == F.lit("open") if STATE in table.columns else by_date
        select.append(is_open.alias(OPEN))
    return table.select(*select)


def _union(stored, batch, names) -> DataFrame:
    """One set of records; stored ones have no meta and no order values."""
    new = batch.withColumns({STORED: F.lit(False), OPEN: F.lit(None).cast("boolean")})
    if stored is None:
        return new
    if OPEN not in stored.columns:
        stored = stored.withColumn(OPEN, F.lit(None).cast("boolean"))
    absent = [*names.meta.values(), *names.order]
    types = dict(batch.dtypes)
    old = stored.withColumns(
        {STORED: F.lit(True), **{n: F.lit(None).cast(types[n]) for n in absent}}
    )
    return old.unionByName(new)


# -- dedupe and anti join: static satellites and loads as is -------------------


def _first_per(rows, keys, names, lead=(), extra=()) -> DataFrame:
    """First row per key.  Aggregates before the shuffle, so copies never pile up."""
    values = [c for c in [*lead, *names.tie_break, *extra] if c in rows.columns and c not in keys]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*values)).alias("__first"))
    return first.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in values])


def _unseen(batch, stored_keys, keys, names) -> DataFrame:
    first = _first_per(batch, keys, names)
    if stored_keys is None:
        return first
    return first.join(stored_keys, keys, "left_anti")


# -- timelines ---------------------------------------------------------------


def _of_parents(stored, parents) -> DataFrame:
    """Stored records of the parents in the batch.

    The broadcast of few parents filters the table while it is scanned; more of
    them go to the buckets of a bucketed table.  Otherwise a bitmap of their hashes has filtered the
    table, and what passed meets them in a shuffle of the columns that are compared; the rows of
    other parents go no further: neither into the sort nor into the count of hot
    parents.
    """
    return stored.join(parents, FK, "left_semi")


def _since(batch, stored, few_parents, slice_millis) -> DataFrame:
    """Stored records from the time slice of the last one before the first new record onward.

    The slice is found on one row per parent and slice, which is aggregated before
    the shuffle, so a hot parent is no more than its slices.
    """
    at = F.floor(F.col(MS) / F.lit(slice_millis)).alias(SLICE)
    starts = batch.groupBy(FK).agg(F.min(MS).alias("__start"))
    slices = stored.groupBy(FK, at).agg(F.min(MS).alias("__first"))
    bounds = (
        slices.join(F.broadcast(starts) if few_parents else starts, FK)
        .filter(F.col("__first") < F.col("__start"))
        .groupBy(FK)
        .agg((F.max(SLICE) * F.lit(slice_millis)).alias("__bound"))
    )
    stored = stored.join(F.broadcast(bounds) if few_parents else bounds, FK, "left")
    return stored.filter(F.col("__bound").isNull() | (F.col(MS) >= F.col("__bound"))).drop("__bound")


def _timelines(rows, spec, names, with_dropped, in_place=False) -> tuple[DataFrame, DataFrame | None]:
    """Parents that fit a task: one shuffle (none if all their rows are in place) and one sort, all windows on them."""
    # Stored records win over new ones, then the first new one wins.
    ranked = Window.partitionBy(FK).orderBy(
        MS, F.col(STORED).desc(), *[F.col(c) for c in names.tie_break]
    )
    rows = rows if in_place else rows.repartition(FK)
    rows = rows.withColumn("__same", F.lag(MS).over(ranked).eqNullSafe(F.col(MS)))
    rows = rows.filter(~F.col("__same")).drop("__same")

    timeline = Window.partitionBy(FK).orderBy(MS)
    dropped = None
    if spec.idempotent:
        rows = rows.withColumn("__prev", F.lag(_payload(spec, rows, names)).over(timeline))
        rows = rows.withColumns(_repeats(F.col("__prev"), _payload(spec, rows, names)))
        rows = rows.drop("__prev").withColumns(
            {
                REPEATED: F.coalesce(F.lead(REPEATS).over(timeline), F.lit(False)),
                FIRST_CHANGE: F.min(F.when(_changes(), F.col(MS))).over(_whole(timeline)),
                FIRST_STORED: F.min(F.when(F.col(STORED), F.col(MS))).over(_whole(timeline)),
            }
        )
        rows, dropped = _split(rows, spec, with_dropped)
    if spec.uses_to_date:
        rows = _with_next(rows)
    return rows.select(*_result_columns(spec, names)), dropped


def _split(rows, spec, with_dropped) -> tuple[DataFrame, DataFrame | None]:
    """The records that stay; if asked for, also the others, from one evaluation that is written."""
    if not with_dropped:
        return rows.filter(_kept(spec)), None
    marked = stage(rows.withColumn("__kept", _kept(spec)), "marked")
    return marked.filter("__kept").drop("__kept"), marked.filter("NOT __kept").select(FK, FROM)


def _sliced_timelines(rows, spec, names, slice_millis, with_dropped) -> tuple[DataFrame, DataFrame | None]:
    """Parents too large for a task, cut into time slices.

    The records are read more than once, so they are staged: first without
    copies, then (for closing dates) only those that stay.
    """
    rows = rows.withColumn("__is_new", ~F.col(STORED))
    rows = _first_per(rows, [FK, MS], names, lead=["__is_new"], extra=[OPEN])
    rows = rows.withColumns(
        {STORED: ~F.col("__is_new"), SLICE: F.floor(F.col(MS) / F.lit(slice_millis))}
    )
    rows = stage(rows.drop("__is_new"), "records")

    dropped = None
    if spec.idempotent:
        in_slice = Window.partitionBy(FK, SLICE).orderBy(MS)
        rows = rows.withColumn("__v", _payload(spec, rows, names))
        rows = rows.withColumn("__prev", F.lag("__v").over(in_slice))
        rows = rows.withColumns(_repeats(F.col("__prev"), F.col("__v")))
        across = _slice_facts(rows)
        rows = rows.withColumn("__follow", F.lead(REPEATS).over(in_slice))
        rows = rows.join(across, [FK, SLICE])
        prev = F.coalesce("__prev", BEFORE)
        rows = rows.withColumns(
            {
                **_repeats(prev, F.col("__v")),
                REPEATED: F.coalesce("__follow", "__after_repeats", F.lit(False)),
            }
        )
        rows, dropped = _split(rows, spec, with_dropped)
    if spec.uses_to_date:
        kept = [FK, FROM, MS, STORED, OPEN, SLICE, *names.attributes.values()]
        rows = _with_next(stage(rows.select(*kept, *names.meta.values()), "kept"))
    return rows.select(*_result_columns(spec, names)), dropped


def _slice_facts(rows) -> DataFrame:
    """One row per slice: what lies before and after it in its parent's timeline."""
    ends = rows.groupBy(FK, SLICE).agg(
        F.min_by("__v", MS).alias(HEAD),
        F.max_by("__v", MS).alias(TAIL),
        F.min(MS).alias("__start"),
        F.min(F.when(_changes(), F.col(MS))).alias("__change"),
        F.min(F.when(F.col(STORED), F.col(MS))).alias("__stored_at"),
    )
    ends = stage(ends, "slices")
    ends = ends.join(_neighbours(ends.select(FK, SLICE, HEAD, TAIL)), [FK, SLICE])
    changes_at_start = F.col(BEFORE).isNotNull() & (F.col(BEFORE) != F.col(HEAD))
    change = F.least("__change", F.when(changes_at_start, F.col("__start")))
    after_repeats = F.col(AFTER).isNotNull() & F.col(AFTER).eqNullSafe(F.col(TAIL))
    # One row per hot parent, of which there are few.
    parents = ends.groupBy(FK).agg(F.min(change).alias(FIRST_CHANGE), F.min("__stored_at").alias(FIRST_STORED))
    facts = ends.select(FK, SLICE, BEFORE, after_repeats.alias("__after_repeats"))
    return facts.join(F.broadcast(parents), FK)


def _neighbours(ends: DataFrame, fanout: int | None = None) -> DataFrame:
    """The tail of the slice before each slice and the head of the one after it, NULL at the ends.

    A scan over a tree: up to ``fanout`` slices of a parent make a group, groups make larger ones,
    and only neighbours in the same group meet in a window.  The first and the last of a group look to
    the neighbours of the group, one level up.  So no window holds more than ``fanout`` rows
    of a parent, however many slices there are.  Heads and tails are never NULL.
    """
    fanout = fanout or FANOUT
    span = ends.agg(F.max(SLICE) - F.min(SLICE)).first()[0] or 0
    names = [F.col(SLICE), F.col(BEFORE), F.col(AFTER)]
    if span < fanout:
        return _in_window(ends, Window.partitionBy(FK).orderBy(SLICE)).select(FK, *names)
    group = F.floor(F.col(SLICE) / F.lit(fanout))
    inner = _in_window(ends.withColumn("__group", group), Window.partitionBy(FK, "__group").orderBy(SLICE))
    groups = ends.groupBy(FK, group.alias(SLICE)).agg(
        F.min_by(HEAD, SLICE).alias(HEAD), F.max_by(TAIL, SLICE).alias(TAIL)
    )
    outer = _neighbours(stage(groups, "groups"), fanout)
    outer = outer.withColumnsRenamed({SLICE: "__group", BEFORE: "__outer_before", AFTER: "__outer_after"})
    around = {BEFORE: F.coalesce(BEFORE, "__outer_before"), AFTER: F.coalesce(AFTER, "__outer_after")}
    return inner.join(outer, [FK, "__group"]).withColumns(around).select(FK, *names)


def _in_window(ends, window) -> DataFrame:
    return ends.withColumns({BEFORE: F.lag(TAIL).over(window), AFTER: F.lead(HEAD).over(window)})


def _whole(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _repeats(prev: Column, payload: Column) -> dict[str, Column]:
    """``prev`` is a struct, so NULL means that there is no record before."""
    return {
        HAS_PREV: prev.isNotNull(),
        REPEATS: prev.isNotNull() & prev.eqNullSafe(payload),
    }


def _changes() -> Column:
    return F.col(HAS_PREV) & ~F.col(REPEATS)


def _with_next(rows) -> DataFrame:
    """Add start and stored flag of the next record; NULL after the last one."""
    value = F.struct(F.col(FROM).alias("start"), F.col(STORED).alias("stored"))
    if SLICE not in rows.columns:
        return rows.withColumn(NEXT, F.lead(value).over(Window.partitionBy(FK).orderBy(MS)))
    in_slice = Window.partitionBy(FK, SLICE).orderBy(MS)
    heads = rows.groupBy(FK, SLICE).agg(F.min_by(value, MS).alias(HEAD))
    across = _neighbours(stage(heads.withColumn(TAIL, F.col(HEAD)), "heads")).drop(BEFORE)
    dated = rows.withColumn(NEXT, F.lead(value).over(in_slice)).join(across, [FK, SLICE])
    return dated.withColumn(NEXT, F.coalesce(NEXT, AFTER)).drop(AFTER, SLICE)


def _payload(spec, rows, names) -> Column:
    """What makes two records the same: all attributes, nothing else."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    parts = [comparable(F.col(n), types[n]).alias(n) for n in names.attributes.values()]
    # Without attributes all records of a parent are alike.
    return F.struct(*(parts or [F.lit(0).alias("none")]))


def _kept(spec) -> Column:
    """Records that survive an idempotent load.

    Stored records always do.  A new record does when it differs from the one
    before it.  Of a first run without any stored record, one new record stays.
    """
    open_run = F.col(FIRST_CHANGE).isNull()
    in_first_run = open_run | (F.col(MS) < F.col(FIRST_CHANGE))
    run_has_stored = F.col(FIRST_STORED).isNotNull() & (
        open_run | (F.col(FIRST_STORED) < F.col(FIRST_CHANGE))
    )
    chosen = ~F.col(REPEATED) if spec.first_run == "latest" else ~F.col(HAS_PREV)
    return F.col(STORED) | _changes() | (in_first_run & ~run_has_stored & chosen)


def _result_columns(spec, names) -> list[str]:
    columns = [FK, FROM, STORED, *names.attributes.values(), *names.meta.values()]
    return columns + ([OPEN, NEXT] if spec.uses_to_date else [])


def _table_form(rows, df, table, spec, names, load_ts, flags=()) -> DataFrame:
    select = [F.col(FK).alias(spec.fk_col)]
    if spec.is_temporal:
        select.append(F.col(FROM).alias(spec.from_col))
    for group in (names.attributes, names.meta):
        select += [F.col(name).alias(col) for col, name in group.items()]
    if spec.uses_to_date:
        until = F.lit(spec.max_date).cast(_from_type(df, table, spec))
        select.append(F.coalesce(F.col(f"{NEXT}.start"), until).alias(spec.to_date_col))
    return rows.select(*select, *audit_columns(spec, load_ts), *flags)


def idempotent_view(table: DataFrame, spec: SatSpec, **options) -> DataFrame:
    """What one idempotent load of all records in ``table`` leaves, however they were cut into batches.

    An idempotent load decides with what it knows: a record that repeats the one before is dropped for good, and the latest of a
    leading run is the latest of its batch.  A satellite that is loaded as is (``idempotent=False``) keeps
    every record, so its leading runs stay open; this view applies the rules of ``spec`` while
    reading, to all of them at once.  ``options`` are those of ``load_satellite``.
    """
    names = {c: c for c in spec.attributes.values()}
    as_stored = replace(
        spec,
        fk={spec.fk_col: spec.fk_col},
        from_date={spec.from_col: spec.from_col},
        attributes=names,
        meta={c: c for c in spec.meta.values()},
        load_dts_col=None,
        rec_src_col=None,
        rec_src=None,
        idempotent=True,
    )
    return load_satellite(table, None, as_stored, **options).inserts


def validity_view(
    table: DataFrame,
    spec: SatSpec,
    *,
    hot_rows: int | None = HOT_ROWS,
    slice_millis: int = SLICE_MILLIS,
) -> DataFrame:
    """A satellite stored without to-dates, with them worked out while reading."""
    if not spec.uses_to_date:
        raise ValueError(f"{spec.table}: the specification has no to-date column")
    type_ = table.schema[spec.from_col].dataType
    rows = table.withColumns(
        {
            FK: column(spec.fk_col).cast("bigint"),
            FROM: column(spec.from_col),
            MS: identity_millis(column(spec.from_col), type_),
            STORED: F.lit(True),
        }
    )
    counts = rows_per_key(rows, [FK])
    if hot_rows is None or not KeyStats.of(counts, [FK]).has_hot(hot_rows):
        dated = _with_next(rows)
    else:
        hot = F.broadcast(stage(hot_keys(counts, [FK], hot_rows), "hot"))
        sliced = rows.join(hot, FK, "left_semi")
        sliced = sliced.withColumn(SLICE, F.floor(F.col(MS) / F.lit(slice_millis)))
        dated = _with_next(rows.join(hot, FK, "left_anti")).unionByName(_with_next(sliced))
    until = F.coalesce(F.col(f"{NEXT}.start"), F.lit(spec.max_date).cast(type_))
    return dated.withColumn(spec.to_date_col, until).select(
        *[column(c) for c in table.columns if c != spec.to_date_col], column(spec.to_date_col)
    )
