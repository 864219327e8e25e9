"""Loads as sinks of a Structured Streaming query.

Every micro-batch is one load.  The only state is the target table: late records
are accepted however late they are, and nothing is dropped.  Spark may repeat the
latest micro-batch after a failure; its keys and records are then already stored
and change nothing.  A chain may have stopped between two of its tables: the repeated batch
finds the keys of the tables before and goes on with those after.  One query writes to a target at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from threading import Event
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vaultwright.plans import ChainLoad, load_chain_into, load_into
from vaultwright.spec import TableSpec
from vaultwright.staging import stage, staged_for_now


def load_stream(
    stream: DataFrame,
    target,
    spec: TableSpec,
    *,
    checkpoint: str,
    then: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start loading ``stream`` into ``target``.

    ``then`` receives each micro-batch with its keys appended, so that further
    loads can follow on the same batch; it must not keep them for later.  The size of a micro-batch is set with
    the options of the source, such as ``maxFilesPerTrigger``.
    """

    def load(batch: DataFrame, batch_id: int, load_id: str):
        loaded = load_into(target, batch, spec, load_id=load_id, **options)
        if then is not None:
            then(loaded.output, batch_id)

    return _start(stream, load, checkpoint, trigger)


def load_chain_stream(
    stream: DataFrame,
    specs: Sequence[TableSpec],
    targets: Mapping[str, Any],
    *,
    checkpoint: str,
    options: Mapping[str, Mapping[str, Any]] | None = None,
    then: Callable[[ChainLoad, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start loading ``stream`` into several tables, each micro-batch in the order of ``specs``.

    Every table gets one load per micro-batch, all of the same name.  ``then`` receives what the chain
    returned; ``options`` holds options by table name, see ``load_chain_into``.
    """

    def load(batch: DataFrame, batch_id: int, load_id: str):
        loaded = load_chain_into(batch, specs, targets, options=options, load_id=load_id)
        if then is not None:
            then(loaded, batch_id)

    return _start(stream, load, checkpoint, trigger)


def _start(stream: DataFrame, load: Callable[[DataFrame, int, str], None], checkpoint, trigger) -> StreamingQuery:
    started = Event()
    running: list[StreamingQuery] = []

    def load_batch(batch: DataFrame, batch_id: int):
        # The id of a query survives restarts, so a repeated batch has the same name.
        started.wait()
        # Read several times by the load, so written once to the shared folder.
        with staged_for_now(batch.sparkSession):
            load(stage(batch, "micro-batch"), batch_id, f"{running[0].id}-{batch_id}")

    query = (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    running.append(query)
    started.set()
    return query
