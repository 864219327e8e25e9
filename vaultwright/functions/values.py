"""Column expressions shared by the loaders.  All are built-in Spark expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLIS_PER_DAY = 86_400_000
# From 0001-01-01 to 1970-01-01 in the proleptic Gregorian calendar.
MILLIS_TO_1970 = 719_162 * MILLIS_PER_DAY


def column(name: str) -> Column:
    """Column by exact name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_order(order_by: Sequence[str | Column] | str | Column | None) -> None:
    """The first row is the smallest: sort orders cannot be part of that comparison."""
    given = [order_by] if isinstance(order_by, (str, Column)) else order_by or []
    for key in given:
        if isinstance(key, Column) and re.search(r" (ASC|DESC) NULLS (FIRST|LAST)'>$", repr(key)):
            raise ValueError(
                f"order_by takes values, smallest first, not the sort order {key!r}; "
                "negate numbers, or dates as numbers, to turn the order round"
            )


def to_column_type(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Bring a stream value to its column type; binary input is decoded once."""
    if source == target:
        return value
    if isinstance(source, T.BinaryType) and not isinstance(target, T.BinaryType):
        value = F.decode(value, "UTF-8")
        if isinstance(target, T.StringType):
            return value
    return value.cast(target)


def is_blank(value: Column, type_: T.DataType) -> Column:
    """NULL, or the empty string: not allowed in a key part.  Nothing is trimmed."""
    blank = value.isNull()
    if isinstance(type_, T.StringType):
        blank = blank | (value == F.lit(""))
    elif isinstance(type_, T.BinaryType):
        blank = blank | (F.length(value) == F.lit(0))
    return blank


def valid_or_fail(value: Column, invalid: Column, message: str) -> Column:
    """The value itself; a row that is invalid fails the job with the message.

    The test sits in the expression that every later step reads, so it costs
    no extra pass over the input.
    """
    return F.when(invalid, F.raise_error(F.lit(message))).otherwise(value)


def empty_to_null(value: Column, type_: T.DataType) -> Column:
    """Satellites treat the empty string as NULL."""
    return F.nullif(value, F.lit("")) if isinstance(type_, T.StringType) else value


def identity_millis(value: Column, type_: T.DataType) -> Column:
    """Milliseconds since 1970 as bigint: how from-dates and dates are compared.

    Independent of the session time zone for dates and timestamps without one.
    """
    if isinstance(type_, T.DateType):
        return F.unix_date(value).cast("bigint") * F.lit(MILLIS_PER_DAY)
    if isinstance(type_, T.TimestampNTZType):
        # Counted from year 1, so that dividing rounds down before 1970 as well.
        since_year_1 = value - F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
        millisecond = F.expr("INTERVAL '0.001' SECOND")
        return F.call_function("div", since_year_1, millisecond) - F.lit(MILLIS_TO_1970)
    return F.unix_millis(value)


def comparable(value: Column, type_: T.DataType) -> Column:
    """Form in which two attribute values are compared: timestamps by millisecond."""
    if isinstance(type_, (T.TimestampType, T.TimestampNTZType)):
        return identity_millis(value, type_)
    return value


def audit_columns(spec, load_ts: datetime | None) -> list[Column]:
    """Load timestamp (one value for the whole load) and record source."""
    columns = []
    if spec.load_dts_col:
        type_ = spec.types.get(spec.load_dts_col, T.TimestampType())
        moment = load_ts or datetime.now()
        if isinstance(type_, T.TimestampNTZType):
            # As text, so that no time zone shifts it.
            stamp = F.lit(moment.replace(tzinfo=None).isoformat(sep=" "))
        else:
            stamp = F.lit(moment)
        columns.append(stamp.cast(type_).alias(spec.load_dts_col))
    if spec.rec_src_col:
        columns.append(F.lit(spec.rec_src).cast("string").alias(spec.rec_src_col))
    return columns
