"""Every registered query against the same result in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from vaultwright.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    result = QUERIES[name](spark, data)
    expected = duck.execute(ORACLES[name])
    columns = sorted(result.columns)
    assert sorted(d[0] for d in expected.description) == columns
    names = [d[0] for d in expected.description]
    order = [names.index(c) for c in columns]
    expected_rows = [tuple(row[i] for i in order) for row in expected.fetchall()]
    rows = [tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect()]
    assert ordered(rows) == ordered(expected_rows)
    assert rows


def test_entry(spark):
    assert contract.entry(spark).count() > 0
