"""A load and its write in one call, with counts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vaultwright.functions import column
from vaultwright.operators import attach_keys, load_keyed, load_satellite
from vaultwright.operators.quality import Fingerprint, duplicate_keys, fingerprint, unresolved_keys
from vaultwright.sources import CatalogTable, SatelliteStore, Sequence, stage
from vaultwright.spec import SEQUENCE, KeyedSpec, SatSpec, TableSpec


@dataclass(frozen=True)
class Loaded:
    """``output`` for the next step, and how many rows were inserted and updated."""

    output: DataFrame
    metrics: dict[str, int] = field(default_factory=dict)


def load_into(
    target,
    df: DataFrame,
    spec: TableSpec,
    *,
    load_id: str | None = None,
    sequence: Sequence | None = None,
    verify: bool = False,
    **options,
) -> Loaded:
    """Load ``df`` into ``target`` and return the input with keys appended.

    ``target`` is a ``ParquetTable``, ``CatalogTable`` or ``SatelliteStore``.
    New rows are staged, and a hub or link load checks before it appends them that
    every key of the input is either stored or new.  The keys of the output are looked up in
    the written table.  ``verify`` also checks afterwards that the whole table holds
    every key once and nothing but what it held and the new rows, and that the output has every valid row of the input.
    """
    if isinstance(spec, SatSpec):
        return _satellite_into(target, df, spec, load_id, options)
    return _keyed_into(target, df, spec, sequence, verify, options)


def _buckets(target, spec) -> dict[str, int | None]:
    return {"stored_buckets": target.key_buckets(spec) if isinstance(target, CatalogTable) else None}


def _append(target, rows: DataFrame) -> int:
    counted = Observation()
    target.append(rows.observe(counted, F.count(F.lit(1)).alias("inserted")))
    return counted.get["inserted"]


def _satellite_into(target, df, spec, load_id, options) -> Loaded:
    if not isinstance(target, SatelliteStore):
        if spec.uses_to_date:
            raise ValueError(f"{spec.table}: stored to-dates need a SatelliteStore")
        load = load_satellite(df, target.read(), spec, **_buckets(target, spec), **options)
        return Loaded(load.output, {"inserted": _append(target, load.inserts), "updated": 0})
    done = target.applied(load_id) if load_id else None
    load = None
    if done is None:
        # The store keeps every to-date complete, so old records can be skipped.
        options = {"lookback": "to_date", **options}
        if target.remember_dropped:
            options = {**options, "handled": target.dropped(), "with_dropped": True}
        version = target.version()
        load = load_satellite(df, target.read(with_state=True), spec, **options)
        done = target.apply(load, load_id, version)
    return Loaded(df if load is None else load.output, {"inserted": done["inserted"], "updated": done["closed"]})


def _keyed_into(target, df, spec: KeyedSpec, sequence, verify, options) -> Loaded:
    table = target.read()
    numbered_later = spec.key_method == SEQUENCE and sequence is not None
    if numbered_later:
        if sequence.increment != spec.sequence_increment:
            raise ValueError(f"{spec.table}: the sequence has another increment")
        options = {**options, "sequence_start": 0}
    buckets = _buckets(target, spec)
    load = load_keyed(df, table, spec, **buckets, **options)
    # Worked out once: counted and checked before anything is appended.
    inserts = stage(load.inserts, "inserts")
    inserted = inserts.count()
    known = 0 if load.known is None else load.known.count()
    if known + inserted != load.stats.keys:
        raise RuntimeError(
            f"{spec.table}: {load.stats.keys} keys in the input, {known} of them stored, {inserted} new"
        )
    if numbered_later:
        # The range is reserved before the insert: a failed load leaves a gap.
        first = sequence.reserve(inserted)
        inserts = inserts.withColumn(spec.tech_key, column(spec.tech_key) + F.lit(first))
    before = _keys_of(table, spec) if verify and table is not None else None
    target.append(inserts)
    lookup_options = {
        k: v for k, v in options.items() if k in ("on_invalid", "hot_rows", "broadcast_bytes")
    }
    written = target.read()
    if verify:
        _verify(df, written, spec, options)
        added = _keys_of(inserts, spec)
        if _keys_of(written, spec) != (added if before is None else before + added):
            raise RuntimeError(f"{spec.table}: does not hold what it held and the {inserted} new rows")
    output = attach_keys(df, written, spec, stats=load.stats, **buckets, **lookup_options)
    if verify:
        check_consumed(load.valid(df), output, spec)
    # Every key is stored once, so each valid row comes out once.
    return Loaded(output, {"inserted": inserted, "updated": 0, "rows": load.stats.rows})


def _keys_of(table: DataFrame, spec: KeyedSpec) -> Fingerprint:
    return fingerprint(table, [*spec.keys.values(), spec.tech_key])


def check_consumed(given: DataFrame, output: DataFrame, spec: KeyedSpec) -> None:
    """Raise unless the output of a load has the rows of its input, by count and fingerprint of their keys."""
    # A field that was decoded on the way has another type and so another hash.
    fields = [f for f in spec.keys if given.schema[f].dataType == output.schema[f].dataType]
    rows_in, rows_out = fingerprint(given, fields), fingerprint(output, fields)
    if rows_in != rows_out:
        raise RuntimeError(f"{spec.table}: {rows_in.n_rows} rows went in, {rows_out.n_rows} came out or others than went in")


def _verify(df, written, spec, options):
    if not duplicate_keys(written, spec).isEmpty():
        raise RuntimeError(f"{spec.table}: holds a key more than once")
    missing = unresolved_keys(df, written, spec)
    if options.get("on_invalid") != "reject" and not missing.isEmpty():
        raise RuntimeError(f"{spec.table}: some keys of the input were not stored")
