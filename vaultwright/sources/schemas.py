"""Target tables derived from a specification and the input it loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vaultwright.spec import KeyedSpec, TableSpec


def target_schema(df: DataFrame, spec: TableSpec) -> T.StructType:
    """Schema of the table that a load of ``df`` creates."""
    spec.check_stream(df)
    types = {c: spec.column_type(df, None, f, c) for f, c in spec.mapping()}
    if isinstance(spec, KeyedSpec):
        types[spec.tech_key] = T.LongType()
    else:
        types[spec.fk_col] = T.LongType()
        if spec.uses_to_date:
            types[spec.to_date_col] = types[spec.from_col]
    if spec.load_dts_col:
        types[spec.load_dts_col] = spec.types.get(spec.load_dts_col, T.TimestampType())
    if spec.rec_src_col:
        types[spec.rec_src_col] = T.StringType()
    return T.StructType([T.StructField(c, types[c]) for c in spec.table_columns()])


def empty_table(spark: SparkSession, df: DataFrame, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], target_schema(df, spec))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_statement(df: DataFrame, spec: TableSpec, using: str = "parquet") -> str:
    """``CREATE TABLE`` statement for the target of a load, all names quoted."""
    columns = ",\n  ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}" for f in target_schema(df, spec)
    )
    names = [n for n in (spec.schema, spec.table) if n]
    table = ".".join(quoted(n) for n in names)
    return f"CREATE TABLE IF NOT EXISTS {table} (\n  {columns}\n) USING {using}"
