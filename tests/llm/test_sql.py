"""Queries next to their SQL in DuckDB, over the tables and over made-up conversations with quotes."""

import duckdb
import pytest

from tests.llm.conftest import collected
from tests.llm.test_quotation_linking import thread
from vaultwright.llm import quotation_linking, sql
from vaultwright.llm.queries import TEXT_ORACLES, TEXT_QUERIES

TABLES = ("documents", "pages", "conversations", "benchmark", "labels")


@pytest.mark.parametrize("name", sorted(TEXT_ORACLES))
def test_query_equals_sql(spark, data, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    expected = duck.execute(TEXT_ORACLES[name])
    columns = [d[0] for d in expected.description]
    found = TEXT_QUERIES[name](spark, data)
    assert sorted(found.columns) == sorted(columns)
    rows = collected(found, *columns)
    assert rows and rows == sorted(expected.fetchall(), key=repr)


def test_quotes_equal_sql(spark):
    rows = [r for seed in range(4) for r in thread(seed, 20)] + [
        (9, 0, "a", "the first message here\n\nwith two parts"),
        (9, 1, "b", "Some Body wrote yesterday, 3 pm:\n> The first   message here\n > > deeper\n\nI agree\n>x\nbye \n"),
        (9, 2, None, None), (9, 4, "d", ""), (9, 5, "e", "he wrote this:\nno quote"),
    ]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    expected = duck.execute(sql.quotation_linking())
    columns = [d[0] for d in expected.description]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert collected(quotation_linking.link(frame), *columns) == sorted(expected.fetchall(), key=repr)
