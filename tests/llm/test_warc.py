"""Archives: written, indexed, read back; the query next to its SQL."""

import hashlib

import duckdb
import pytest

from tests.llm.conftest import collected
from vaultwright.llm import warc
from vaultwright.llm.queries import TEXT_ORACLES, TEXT_QUERIES

BIG = "<p>é" + "x" * 2000


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, archive int, digest string")


def stored(spark, rows, **options):
    table = pages(spark, [(*r, 7, "clash") for r in rows])
    folder = warc.new_archive_folder(table)
    index = warc.write_archives(table, folder, **options)
    return index, folder


def test_round_trip_and_revisits(spark):
    rows = [
        (1, "http://a/\r\nX: y z", BIG), (5, None, BIG), (3, "http://b", BIG), (5, "http://twin", BIG), (None, "http://n", BIG),
        (7, "http://c", None), (8, "http://d", ""), (9, "http://e", "short"), (10, "http://f", "short"),
        (11, "http://g", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" + " " * 400),
    ]
    index, folder = stored(spark, rows)
    records = {(r["page_id"], r["url"]): r for r in warc.read_records(index, folder).collect()}
    assert len(records) == len(rows)
    for page_id, url, html in rows:
        record = records[(page_id, warc._uri(url))]
        payload = (html or "").encode()
        revisit = page_id in (1, 3)
        assert record["record_type"] == ("revisit" if revisit else "response")
        assert record["refers_to"] == (5 if revisit else None)
        assert (record["payload_bytes"], record["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert record["payload"] == (None if revisit else payload)
    known = {(r["page_id"], r["url"]): r for r in index.collect()}
    assert {k[0] for k in known} == {r[0] for r in rows}


def test_reads_only_what_is_selected(spark):
    rows = [(i, f"http://h/{i}", f"{i}" * 3000) for i in range(40)]
    index, folder = stored(spark, rows)
    chosen = index.filter("page_id % 7 = 3")
    assert [r[0] for r in collected(warc.read_records(chosen, folder), "page_id")] == [10, 17, 24, 3, 31, 38]


def test_records_lie_where_the_index_says(spark):
    index, folder = stored(spark, [(i, "u", "x" * i) for i in range(5)])
    for r in index.collect():
        with open(f"{folder.removeprefix('file:')}/{r['archive']}", "rb") as archive:
            archive.seek(r["offset"])
            record = archive.read(r["length"])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert warc.parse(record)["page_id"] == r["page_id"]


def test_damage_is_found():
    record = warc._format(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, "2000-01-01T00:00:00Z")
    assert warc.parse(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"payload", b"payloaD"))


def test_empty_table(spark):
    index, folder = stored(spark, [])
    assert index.count() == 0 and warc.read_records(index, folder).count() == 0


def test_query_equals_sql(spark, data):
    name = "op3_warc"
    found = TEXT_QUERIES[name](spark, data)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    expected = duck.execute(TEXT_ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert collected(found, *columns) == sorted(expected.fetchall(), key=repr)
