"""Several loads in a row: keys appended by one are read by the next."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame

from vaultwright.operators import KeyedLoad, SatLoad, load_keyed, load_satellite
from vaultwright.plans.into import Loaded, load_into
from vaultwright.sources import stage
from vaultwright.spec import KeyedSpec, TableSpec


@dataclass(frozen=True)
class ChainLoad:
    """The last step's output, and the load of every table by name."""

    output: DataFrame
    loads: dict[str, KeyedLoad | SatLoad | Loaded]
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)


def _check(specs: Sequence[TableSpec]) -> None:
    names = [spec.table for spec in specs]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"{', '.join(twice)}: loaded twice in one chain")


def load_chain(
    df: DataFrame,
    specs: Sequence[TableSpec],
    tables: Mapping[str, DataFrame | None],
    *,
    order_by: Sequence[str | Column] | None = None,
    load_ts: datetime | None = None,
    cut: bool = True,
    options: Mapping[str, Mapping[str, Any]] | None = None,
) -> ChainLoad:
    """Run hub, link and satellite loads in the order given; writes no table.

    ``options`` holds further options of single steps by table name, such as
    ``sequence_start``, ``on_invalid`` or an ``order_by`` of its own.

    Steps that need no key of an earlier one read the input itself; their keys are
    appended together.  With ``cut`` the rows with those keys are written to the
    shared folder once, before the first step that reads such a key, so that later
    steps do not repeat the joins.
    """
    _check(specs)
    loads: dict[str, KeyedLoad | SatLoad] = {}
    waiting: list[KeyedLoad] = []  # loads whose keys ``df`` does not have yet
    pending: set[str] = set()

    def catch_up(rows: DataFrame) -> DataFrame:
        for load in waiting:
            rows = load.attach(rows)
        waiting.clear()
        pending.clear()
        return rows

    for spec in specs:
        step = {"order_by": order_by, "load_ts": load_ts, **(options or {}).get(spec.table, {})}
        drops_rows = step.get("on_invalid") == "reject"
        if drops_rows or pending & {field for field, _ in spec.mapping()}:
            df = catch_up(df)
            df = stage(df, "chain") if cut else df
        if isinstance(spec, KeyedSpec):
            if spec.key_field in pending:
                raise ValueError(f"{spec.table}: key field {spec.key_field!r} is appended twice")
            load = load_keyed(df, tables.get(spec.table), spec, **step)
            waiting.append(load)
            pending.add(spec.key_field)
        else:
            load = load_satellite(df, tables.get(spec.table), spec, **step)
        loads[spec.table] = load
        if drops_rows and isinstance(spec, KeyedSpec):
            df = catch_up(df)  # later steps see valid rows only
    return ChainLoad(catch_up(df), loads)


def load_chain_into(
    df: DataFrame,
    specs: Sequence[TableSpec],
    targets: Mapping[str, Any],
    *,
    options: Mapping[str, Mapping[str, Any]] | None = None,
    load_id: str | None = None,
) -> ChainLoad:
    """Run the loads in the order given and write each into its target; see ``load_into``.

    ``options`` holds options by table name, such as ``sequence``, ``load_id`` or ``on_invalid``; ``load_id``
    names the load of every table.  A chain that stopped between two tables can be run again.
    """
    _check(specs)
    loads: dict[str, Loaded] = {}
    for spec in specs:
        own = {"load_id": load_id, **(options or {}).get(spec.table, {})}
        loaded = load_into(targets[spec.table], df, spec, **own)
        df = loaded.output
        if isinstance(spec, KeyedSpec) and spec is not specs[-1]:
            df = stage(df, "chain")
            came_out = df.count()  # from the footers of the files
            if came_out != loaded.metrics["rows"]:
                raise RuntimeError(f"{spec.table}: {loaded.metrics['rows']} rows went in, {came_out} came out")
        loads[spec.table] = loaded
    return ChainLoad(df, loads, {name: loaded.metrics for name, loaded in loads.items()})
