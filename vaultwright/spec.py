"""Load specifications: what to read from the stream and where it goes.

A specification is plain data.  Field mappings are given either as a list of
names (stream field and table column share the name) or as a dict
``{stream field: table column}``.  All argument checks that need no data are
made here or in ``check_stream`` / ``check_table``, so a wrong set-up fails
before any Spark job starts.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

Fields = Mapping[str, str] | Sequence[str] | str

# Key generation methods.
TABLE_MAX = "tablemax"
SEQUENCE = "sequence"
AUTO_INCREMENT = "autoinc"
KEY_METHODS = (TABLE_MAX, SEQUENCE, AUTO_INCREMENT)

# In which order new keys are numbered: by (digest, key), which is cheapest, or by the key alone.
BY_DIGEST, BY_KEY = "digest", "key"
KEY_ORDERS = (BY_DIGEST, BY_KEY)

# Default end of validity, its format, and "no to-date column".
MAX_FLAG = "01-01-4000"
MAX_FLAG_FORMAT = "%d-%m-%Y"
NOT_USED = "n.a."

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def as_mapping(fields: Fields | None) -> dict[str, str]:
    if not fields:
        return {}
    if isinstance(fields, str):
        fields = [fields]
    if isinstance(fields, Mapping):
        return dict(fields)
    mapping = {}
    for name in fields:
        if name in mapping:
            raise ValueError(f"field {name!r} is mapped twice")
        mapping[name] = name
    return mapping


def substitute(text: str | None, variables: Mapping[str, str]) -> str | None:
    """Replace ``${name}`` by its value; unknown names stay as they are."""
    if text is None:
        return None
    return re.sub(
        r"\$\{([^}]+)\}", lambda m: str(variables.get(m.group(1), m.group(0))), text
    )


def as_type(type_: T.DataType | str) -> T.DataType:
    return type_ if isinstance(type_, T.DataType) else T.DataType.fromDDL(type_)


def _absent(names: list[str], df: DataFrame) -> list[str]:
    """Names that ``df`` does not have, with or without regard to case as Spark is set."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return [n for n in names if n not in df.columns]
    known = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() not in known]


def type_of(df: DataFrame, name: str) -> T.DataType:
    """Type of a column, found as Spark finds it."""
    if name in df.columns:
        return df.schema[name].dataType
    return next(f.dataType for f in df.schema.fields if f.name.lower() == name.lower())


@dataclass(frozen=True, kw_only=True)
class TableSpec:
    """What hubs, links and satellites have in common."""

    table: str
    schema: str | None = None
    load_dts_col: str | None = None
    rec_src_col: str | None = None
    rec_src: str | None = None
    variables: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, T.DataType | str] = field(default_factory=dict)

    def _freeze(self, **values):
        for name, value in values.items():
            object.__setattr__(self, name, value)

    def __post_init__(self):
        if not self.table:
            raise ValueError("the target table is not set")
        self._freeze(
            table=substitute(self.table, self.variables),
            schema=substitute(self.schema, self.variables),
            rec_src=substitute(self.rec_src, self.variables),
            types={c: as_type(t) for c, t in self.types.items()},
        )

    @property
    def qualified_table(self) -> str:
        return f"{self.schema}.{self.table}" if self.schema else self.table

    def mapping(self) -> list[tuple[str, str]]:
        """All mapped (stream field, table column) pairs."""
        raise NotImplementedError

    def _check_mapping(self, *groups: Mapping[str, str]):
        columns: set[str] = set()
        for group in groups:
            for column in group.values():
                if column in columns:
                    raise ValueError(f"column {column!r} of {self.table} is mapped twice")
                columns.add(column)
        for audit in (self.load_dts_col, self.rec_src_col):
            if audit in columns:
                raise ValueError(f"audit column {audit!r} of {self.table} is also mapped")

    def check_stream(self, df: DataFrame):
        missing = _absent([f for f, _ in self.mapping()], df)
        if missing:
            raise ValueError(f"{self.table}: fields not found in the input: {missing}")

    def table_columns(self) -> list[str]:
        """Every column the load writes, in table order."""
        raise NotImplementedError

    def check_table(self, table: DataFrame | None):
        if table is None:
            return
        missing = _absent(self.table_columns(), table)
        if missing:
            raise ValueError(f"{self.table}: columns not found in the target table: {missing}")

    def column_type(self, df: DataFrame, table: DataFrame | None, stream_field: str, column: str):
        """Type a mapped column has in the target table."""
        if table is not None and not _absent([column], table):
            return type_of(table, column)
        if column in self.types:
            return self.types[column]
        return type_of(df, stream_field)


@dataclass(frozen=True, kw_only=True)
class KeyedSpec(TableSpec):
    """A table whose rows get a technical key: hubs and links."""

    tech_key: str
    keys: Fields
    others: Fields = ()
    key_field: str | None = None
    key_method: str = TABLE_MAX
    key_order: str = BY_DIGEST
    sequence_start: int = 1
    sequence_increment: int = 1

    MIN_KEYS = 1

    def __post_init__(self):
        super().__post_init__()
        if not self.tech_key:
            raise ValueError(f"{self.table}: the technical key column is not set")
        if self.key_method not in KEY_METHODS:
            raise ValueError(
                f"{self.table}: unknown key method {self.key_method!r}, use one of {KEY_METHODS}"
            )
        if self.key_order not in KEY_ORDERS:
            raise ValueError(f"{self.table}: unknown key order {self.key_order!r}, use one of {KEY_ORDERS}")
        if self.key_order == BY_KEY and self.key_method == AUTO_INCREMENT:
            raise ValueError(f"{self.table}: auto increment numbers keys by digest")
        if self.sequence_increment == 0:
            raise ValueError(f"{self.table}: sequence_increment must not be 0")
        self._freeze(
            keys=as_mapping(self.keys),
            others=as_mapping(self.others),
            key_field=self.key_field or self.tech_key,
        )
        if len(self.keys) < self.MIN_KEYS:
            raise ValueError(
                f"{self.table}: needs at least {self.MIN_KEYS} key field(s), got {len(self.keys)}"
            )
        self._check_mapping(self.keys, self.others, {"": self.tech_key})

    def mapping(self):
        return [*self.keys.items(), *self.others.items()]

    def table_columns(self):
        audit = [c for c in (self.load_dts_col, self.rec_src_col) if c]
        return [*self.keys.values(), *self.others.values(), *audit, self.tech_key]

    def check_stream(self, df):
        super().check_stream(df)
        if self.key_field in df.columns:
            raise ValueError(
                f"{self.table}: the input already has a column {self.key_field!r}; set key_field"
            )


@dataclass(frozen=True, kw_only=True)
class HubSpec(KeyedSpec):
    """A hub: one or more business keys."""


@dataclass(frozen=True, kw_only=True)
class LinkSpec(KeyedSpec):
    """A link: two or more hub keys."""

    MIN_KEYS = 2


@dataclass(frozen=True, kw_only=True)
class SatSpec(TableSpec):
    """A satellite: attribute history of one hub or link key.

    Without ``from_date`` the satellite is static (one record per key).
    ``first_run`` says which record of a leading run of equal new records an
    idempotent load keeps: the ``latest`` (default) or the ``earliest``.
    """

    fk: Fields
    attributes: Fields = ()
    from_date: Fields | None = None
    meta: Fields = ()
    idempotent: bool = True
    first_run: str = "latest"
    to_date_col: str | None = None
    max_flag: str = MAX_FLAG

    def __post_init__(self):
        super().__post_init__()
        self._freeze(
            fk=as_mapping(self.fk),
            attributes=as_mapping(self.attributes),
            from_date=as_mapping(self.from_date),
            meta=as_mapping(self.meta),
        )
        if len(self.fk) != 1:
            raise ValueError(f"{self.table}: needs exactly one foreign key, got {list(self.fk)}")
        if len(self.from_date) > 1:
            raise ValueError(f"{self.table}: at most one from-date, got {list(self.from_date)}")
        if not self.attributes:
            warnings.warn(f"{self.table}: has no attributes, so records differ by date only", stacklevel=3)
        if self.first_run not in ("latest", "earliest"):
            raise ValueError(f"{self.table}: first_run is 'latest' or 'earliest'")
        groups = [self.fk, self.from_date, self.attributes, self.meta]
        if self.uses_to_date:
            groups.append({"": self.to_date_col})
            self.max_date  # a wrong max flag fails here
        self._check_mapping(*groups)

    @property
    def is_temporal(self) -> bool:
        return bool(self.from_date)

    @property
    def uses_to_date(self) -> bool:
        return self.is_temporal and bool(self.to_date_col) and self.to_date_col != NOT_USED

    @property
    def max_date(self) -> date:
        try:
            return datetime.strptime(self.max_flag, MAX_FLAG_FORMAT).date()
        except ValueError as error:
            raise ValueError(f"{self.table}: max_flag must look like dd-MM-yyyy") from error

    @property
    def fk_field(self) -> str:
        return next(iter(self.fk))

    @property
    def fk_col(self) -> str:
        return next(iter(self.fk.values()))

    @property
    def from_field(self) -> str | None:
        return next(iter(self.from_date), None)

    @property
    def from_col(self) -> str | None:
        return next(iter(self.from_date.values()), None)

    def mapping(self):
        groups = (self.fk, self.from_date, self.attributes, self.meta)
        return [pair for group in groups for pair in group.items()]

    def table_columns(self):
        columns = [*self.fk.values(), *self.from_date.values()]
        columns += [*self.attributes.values(), *self.meta.values()]
        if self.uses_to_date:
            columns.append(self.to_date_col)
        return columns + [c for c in (self.load_dts_col, self.rec_src_col) if c]

    def check_stream(self, df):
        super().check_stream(df)
        self._check_types(df, self.fk_field, self.from_field, "input")

    def check_table(self, table):
        super().check_table(table)
        if table is not None:
            self._check_types(table, self.fk_col, self.from_col, "target table")

    def _check_types(self, df, fk, from_, where):
        fk_type = type_of(df, fk)
        if not isinstance(fk_type, INTEGRAL):
            raise ValueError(f"{self.table}: foreign key {fk!r} of the {where} is {fk_type}, not integral")
        if from_ is not None:
            from_type = type_of(df, from_)
            if not isinstance(from_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                raise ValueError(
                    f"{self.table}: from-date {from_!r} of the {where} is {from_type}, not a date or timestamp"
                )
