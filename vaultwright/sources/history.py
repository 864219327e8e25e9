"""Satellites with stored to-dates, merged while reading.

Parquet cannot update rows, so a load never touches what is stored.  It appends one
directory with two kinds of rows: new records, and *closings*, which name a stored
record by parent and from-date and give it a new to-date.  A to-date only ever moves
back, so the one that counts is the smallest of a record's own and those of its closings,
in whatever order they came: readers need no versions, only a minimum per record.

    loads/<version>-<inserted>-<closed>-<dropped>-<load id>   rows of one load
    base/<version>                                            all loads up to that version, merged
    folded/<version>                                          which loads those were, and their counts
    properties.json                                           schema and max flag

A load is written aside and then moved into place by one rename, so it is there as a whole or not
at all; a file system with atomic rename of directories is needed.  The counts in the name
say, without reading anything, how many closings readers have to merge: none is no join, few are
broadcast, many are shuffled.  ``compact`` folds all loads into a new base with one query.  What
a base replaces is deleted by the compaction after it, so that readers can finish.

The rows a load writes are its own, late ones included, and the number of directories follows
the number of loads since the last compaction, whatever time span the records cover.  The files of a base (up to ``buckets``) are
ranges of to-dates, so a scan that looks back to a date skips, by the statistics in their footers, all files
that ended before; what a late load reads follows its first date.

A load that was applied is not applied again, and one that was worked out from an older state of
the table is refused.  Idempotent loads drop records that repeat the one before; with ``remember_dropped``
their identities are kept as well, so that any batch, however old and under whatever name, inserts nothing when it comes
again, though a record before one of them may have changed meanwhile.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import cached_property
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.functions import column
from vaultwright.operators.satellite import ENDS, IS_CLOSING, STATE, WAS_OPEN, SatLoad
from vaultwright.operators.skew import BROADCAST_BYTES, ENTRY_BYTES
from vaultwright.sources.files import Folder
from vaultwright.spec import SatSpec

OPEN, CLOSED, DROPPED = "open", "closed", "dropped"
# A closing in a broadcast: parent, from-date and to-date.
CLOSING_BYTES = ENTRY_BYTES + 3 * 16
_END = "__end"


@dataclass(frozen=True)
class AppliedLoad:
    """A load in the table, with its counts; ``path`` is None once it is folded into the base."""

    version: int
    load_id: str
    inserted: int
    closed: int
    dropped: int = 0
    path: str | None = None


@dataclass(frozen=True)
class SatelliteStore:
    spark: SparkSession
    path: str
    spec: SatSpec
    buckets: int = 256
    remember_dropped: bool = False

    def __post_init__(self):
        if not self.spec.uses_to_date:
            raise ValueError(f"{self.spec.table}: has no to-date, an append-only table will do")

    @cached_property
    def _folder(self) -> Folder:
        return Folder(self.spark, self.path)

    # -- what is there -------------------------------------------------------

    def _base(self) -> int:
        """Version of the base, 0 without one."""
        return max((int(name) for name in self._folder.names("base")), default=0)

    def loads(self) -> list[AppliedLoad]:
        """The loads that are not part of the base, in the order in which they were applied."""
        base, found = self._base(), []
        for name in self._folder.names("loads"):
            *counts, load_id = name.split("-", 4)
            version, inserted, closed, dropped = map(int, counts)
            if version > base:
                path = self._folder.path("loads", name)
                found.append(AppliedLoad(version, unquote(load_id), inserted, closed, dropped, path))
        return sorted(found, key=lambda load: load.version)

    def version(self) -> int:
        """Number of loads applied so far."""
        loads = self.loads()
        return loads[-1].version if loads else self._base()

    def _find(self, load_id: str) -> AppliedLoad | None:
        for load in self.loads():
            if load.load_id == load_id:
                return load
        if not self._base():
            return None
        folded = self.spark.read.parquet(*[self._folder.path("folded", n) for n in self._folder.names("folded")])
        row = folded.filter(F.col("load_id") == F.lit(load_id)).first()
        return None if row is None else AppliedLoad(row.version, load_id, row.inserted, row.closed)

    def applied(self, load_id: str) -> dict[str, int] | None:
        """The counts of a load that was applied before."""
        load = self._find(load_id)
        return None if load is None else {"inserted": load.inserted, "closed": load.closed}

    def _properties(self) -> dict | None:
        text = self._folder.read_text("properties.json")
        if text is None:
            return None
        found = json.loads(text)
        if found["max_flag"] != self.spec.max_flag:
            raise ValueError(f"{self.path} was written with another max flag")
        return found

    # -- reading -------------------------------------------------------------

    def read(self, with_state: bool = False) -> DataFrame | None:
        """The table with its to-dates as they are now; None when nothing was loaded yet.

        ``with_state`` adds what loads need: which records are open, and the to-date that a record was
        stored with, which is no earlier than the one that counts and can be tested while scanning.
        """
        properties = self._properties()
        if properties is None:
            return None
        merged = self._merged(T.StructType.fromJson(properties["schema"])).filter(F.col(STATE) != F.lit(DROPPED))
        return merged if with_state else merged.drop(STATE, ENDS)

    def dropped(self) -> DataFrame | None:
        """Parent and from-date of records that loads dropped as repetitions; None when nothing was loaded yet."""
        properties = self._properties()
        if properties is None:
            return None
        base = self._base()
        paths = [load.path for load in self.loads() if load.dropped]
        paths += [self._folder.path("base", str(base))] if base else []
        rows = self.spark.read.schema(self._stored(T.StructType.fromJson(properties["schema"]))).parquet(*paths)
        return rows.filter(F.col(STATE) == F.lit(DROPPED)).select(*[column(c) for c in self._identity])

    @property
    def _identity(self) -> list[str]:
        return [self.spec.fk_col, self.spec.from_col]

    @staticmethod
    def _stored(schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(STATE, T.StringType())])

    def _merged(self, schema: T.StructType) -> DataFrame:
        """All records, dropped ones included."""
        base, loads = self._base(), self.loads()
        stored = self._stored(schema)
        appended = T.StructType([*stored.fields, T.StructField(IS_CLOSING, T.BooleanType())])
        rows = self.spark.read.schema(appended).parquet(*[load.path for load in loads])
        records = rows.filter(~F.col(IS_CLOSING)).drop(IS_CLOSING)
        if base:
            records = self.spark.read.schema(stored).parquet(self._folder.path("base", str(base))).unionByName(records)
        ends = column(self.spec.to_date_col)
        records = records.withColumn(ENDS, ends)
        n_closings = sum(load.closed for load in loads)
        if not n_closings:
            return records
        key = self._identity
        closings = rows.filter(F.col(IS_CLOSING)).groupBy(*[column(c) for c in key]).agg(F.min(ends).alias(_END))
        few = n_closings * CLOSING_BYTES <= BROADCAST_BYTES
        closed = F.col(_END).isNotNull()
        joined = records.join(F.broadcast(closings) if few else closings, key, "left")
        return joined.select(
            *[F.least(ends, _END).alias(c) if c == self.spec.to_date_col else column(c) for c in schema.names],
            F.when(closed, F.lit(CLOSED)).otherwise(F.col(STATE)).alias(STATE),
            ENDS,
        )

    # -- writing -------------------------------------------------------------

    def apply(self, load: SatLoad, load_id: str | None = None, version: int | None = None) -> dict[str, int]:
        """Append the inserts and closings of a load; return their numbers.

        ``version`` is that of the table the load was worked out from.
        """
        load_id = load_id or uuid.uuid4().hex
        done = self.applied(load_id)
        if done is not None:
            return done
        current = self.version()
        if version is not None and version != current:
            raise RuntimeError(f"{self.path}: the table has changed since load {load_id} was worked out")
        table = [f for f in load.changes.schema.fields if f.name not in (IS_CLOSING, WAS_OPEN)]
        if self._properties() is None:
            properties = {"max_flag": self.spec.max_flag, "schema": T.StructType(table).jsonValue()}
            self._folder.write_text("properties.json", json.dumps(properties))
        is_open = ~F.col(IS_CLOSING) & (column(self.spec.to_date_col) == F.lit(self.spec.max_date))
        state = F.when(is_open, F.lit(OPEN)).otherwise(F.lit(CLOSED)).alias(STATE)
        aside = self._folder.path("_aside", uuid.uuid4().hex)
        load.changes.select(*[column(f.name) for f in table], state, IS_CLOSING).write.parquet(aside)
        if self.remember_dropped and load.dropped is not None:
            absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in table if f.name not in self._identity]
            kind = [F.lit(DROPPED).alias(STATE), F.lit(False).alias(IS_CLOSING)]
            load.dropped.select(*[column(c) for c in self._identity], *absent, *kind).write.mode("append").parquet(aside)
        dropped = F.col(STATE) == F.lit(DROPPED)
        counts = self.spark.read.schema(f"{STATE} string, {IS_CLOSING} boolean").parquet(aside)
        inserted, closed, forgone = counts.agg(
            F.count_if(~F.col(IS_CLOSING) & ~dropped), F.count_if(F.col(IS_CLOSING)), F.count_if(dropped)
        ).first()
        name = f"{current + 1:010d}-{inserted}-{closed}-{forgone}-{quote(load_id, safe='')}"
        self._folder.move(aside, self._folder.path("loads", name))
        return {"inserted": inserted, "closed": closed}

    def compact(self) -> int:
        """Fold all loads into a new base; return how many there were."""
        loads, old = self.loads(), self._base()
        if not loads:
            return 0
        schema = T.StructType.fromJson(self._properties()["schema"])
        version = str(loads[-1].version)
        facts = [(load.version, load.load_id, load.inserted, load.closed) for load in loads]
        told = self.spark.createDataFrame(facts, "version long, load_id string, inserted long, closed long")
        told.coalesce(1).write.mode("overwrite").parquet(self._folder.path("folded", version))
        aside = self._folder.path("_aside", uuid.uuid4().hex)
        fk, ends = column(self.spec.fk_col), column(self.spec.to_date_col)
        merged = self._merged(schema).drop(ENDS)
        # Open records all have the same to-date, so the parent cuts their ranges.
        merged.repartitionByRange(self.buckets, ends, fk).sortWithinPartitions(ends, fk).write.parquet(aside)
        self._folder.move(aside, self._folder.path("base", version))
        # Readers of the old base and of these loads may still be at work; earlier ones are not.
        for name in self._folder.names("base"):
            if int(name) < old:
                self._folder.delete("base", name)
        for name in self._folder.names("loads"):
            if int(name.split("-", 1)[0]) <= old:
                self._folder.delete("loads", name)
        return len(loads)
