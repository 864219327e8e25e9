import random
import uuid
from dataclasses import replace
from datetime import datetime
from pathlib import Path
from threading import Event, Thread

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_satellite import MAX, TEMPORAL, at, frame, random_records
from vaultwright.operators import load_satellite, quality, validity_view
from vaultwright.plans import into as into_module
from vaultwright.plans import load_chain, load_chain_into, load_into
from vaultwright.sources import (
    CatalogTable,
    ParquetTable,
    SatelliteStore,
    Sequence,
    create_statement,
    empty_table,
    shared_folder,
    stage,
    staged_for_now,
    target_schema,
)
from vaultwright.sources.files import Folder
from vaultwright.spec import SEQUENCE, HubSpec, LinkSpec, SatSpec
from vaultwright.streaming import load_stream

HUB = HubSpec(table="hub", tech_key="id", keys=["k"])


def pairs(spark, keys):
    return spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k string, n int")


@pytest.fixture
def folder(spark, tmp_path):
    return f"file:{tmp_path}"


def test_two_loads_into_a_parquet_table(spark, folder):
    target = ParquetTable(spark, f"{folder}/hub")
    assert target.read() is None
    first = load_into(target, pairs(spark, ["a", "b", "a"]), HUB, verify=True)
    second = load_into(target, pairs(spark, ["b", "c"]), HUB, verify=True)
    assert first.metrics == {"inserted": 2, "updated": 0, "rows": 3}
    assert second.metrics == {"inserted": 1, "updated": 0, "rows": 2}
    ids = {r.k: r.id for r in target.read().collect()}
    assert sorted(ids.values()) == [1, 2, 3]
    assert {(r.k, r.id) for r in first.output.collect()} == {(k, ids[k]) for k in "ab"}
    assert {(r.k, r.id) for r in second.output.collect()} == {(k, ids[k]) for k in "bc"}


def test_verify_finds_duplicates(spark, folder):
    target = ParquetTable(spark, f"{folder}/hub")
    target.append(spark.createDataFrame([("a", 1), ("a", 2)], "k string, id bigint"))
    with pytest.raises(RuntimeError, match="more than once"):
        load_into(target, pairs(spark, ["a"]), HUB, verify=True)


def test_catalog_table_in_buckets(spark):
    spec = HubSpec(table=f"hub_{uuid.uuid4().hex}", tech_key="id", keys=["k"])
    target = CatalogTable.of(spark, spec, bucket_by=("k",), buckets=4)
    try:
        load_into(target, pairs(spark, ["a", "b"]), spec)
        load_into(target, pairs(spark, ["b", "c"]), spec)
        assert target.read().count() == 3
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {spec.table}")


def test_sequence_state(spark, folder):
    sequence = Sequence(spark, f"{folder}/sequence", start=100, increment=10)
    spec = HubSpec(
        table="h", tech_key="id", keys="k", key_method=SEQUENCE, sequence_increment=10
    )
    target = ParquetTable(spark, f"{folder}/hub")
    load_into(target, pairs(spark, ["a", "b"]), spec, sequence=sequence)
    load_into(target, pairs(spark, ["b", "c"]), spec, sequence=sequence)
    assert {r.id for r in target.read().collect()} == {100, 110, 120}
    assert sequence.next_value() == 130
    wrong = Sequence(spark, f"{folder}/sequence", increment=1)
    with pytest.raises(ValueError, match="increment"):
        load_into(target, pairs(spark, ["d"]), spec, sequence=wrong)


def test_schema_and_create_statement(spark):
    df = spark.createDataFrame([], "k string, n int, at date, v string")
    hub = HubSpec(
        schema="raw", table="hub`x", tech_key="id", keys={"k": "business key"}, others="n",
        load_dts_col="dts", rec_src_col="src",
    )
    assert target_schema(df, hub).simpleString() == (
        "struct<business key:string,n:int,dts:timestamp,src:string,id:bigint>"
    )
    statement = create_statement(df, hub)
    assert "`raw`.`hub``x`" in statement and "`business key` string" in statement
    sat = SatSpec(
        table="s", fk={"n": "hub_id"}, from_date="at", attributes="v", meta="k", to_date_col="to"
    )
    assert target_schema(df, sat).simpleString() == (
        "struct<hub_id:bigint,at:date,v:string,k:string,to:date>"
    )
    name = f"created_{uuid.uuid4().hex}"
    spark.sql(create_statement(df, HubSpec(table=name, tech_key="id", keys={"k": "my key"})))
    try:
        assert spark.table(name).columns == ["my key", "id"]
    finally:
        spark.sql(f"DROP TABLE {name}")
    empty = empty_table(spark, df, sat)
    rows = spark.createDataFrame([(1, "2020-01-01", "A", "x")], "n int, at string, v string, k string")
    rows = rows.withColumn("at", F.col("at").cast("date"))
    inserts = load_satellite(rows, empty, sat).inserts
    assert inserts.schema == empty.schema or inserts.columns == empty.columns
    assert inserts.count() == 1
    assert target_schema(rows, sat)["hub_id"].dataType == T.LongType()


def contents(table):
    rows = [(r.fk, r.at, r.value, r.until) for r in table.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_satellite_store_against_the_view(spark, folder):
    """Batches in any time order, compacted at times: stored to-dates stay equal to computed ones."""
    rng = random.Random(23)
    store = SatelliteStore(spark, f"{folder}/sat", TEMPORAL, buckets=3)
    total = closed = 0
    for n in range(6):
        batch = frame(spark, random_records(rng, 40, 4, 25))
        counts = load_into(store, batch, TEMPORAL, load_id=f"load {n}", order_by="pos").metrics
        total += counts["inserted"]
        closed += counts["updated"]
        table = store.read()
        assert contents(table) == contents(validity_view(table.drop("until"), TEMPORAL))
        if n in (1, 2, 4):
            before = contents(table)
            assert store.compact() == (1 if n == 2 else 2)
            assert contents(store.read()) == before and store.version() == n + 1
    assert store.read().count() == total and closed > 0
    state = store.read(with_state=True)
    assert state.filter("(_state = 'open') <> (until = timestamp_ntz'4000-01-01')").count() == 0
    assert state.filter("_ends < until").count() == 0


DAY = 24 * 3600 * 1000


def files(folder):
    root = Path(folder.removeprefix("file:")) / "sat"
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def rows_of(spark, folder, part):
    return spark.read.parquet(f"{folder}/sat/{part}").count()


def test_a_load_writes_only_its_own_rows(spark, folder):
    """Loads on six days, then a late record: no file changes, one directory with two rows is new."""
    store = SatelliteStore(spark, f"{folder}/sat", TEMPORAL, buckets=2)
    for n in range(0, 12, 2):
        load_into(store, frame(spark, [(fk, n * DAY, f"v{n}") for fk in range(4)]), TEMPORAL)
    before = files(folder)
    assert load_into(store, frame(spark, [(1, 3 * DAY, "late")]), TEMPORAL, load_id="late").metrics == {
        "inserted": 1, "updated": 1
    }
    after = files(folder)
    assert before.items() <= after.items()
    assert {p.split("/")[1] for p in after.keys() - before.keys()} == {"0000000007-1-1-0-late"}
    assert rows_of(spark, folder, "loads/0000000007-1-1-0-late") == 2
    table = store.read()
    assert contents(table) == contents(validity_view(table.drop("until"), TEMPORAL)) and table.count() == 25
    assert store.compact() == 7 and store.compact() == 0
    assert contents(store.read()) == contents(table)
    assert rows_of(spark, folder, "base/7") == 25
    assert len([p for p in files(folder) if p.startswith("base/")]) <= 2


def test_late_scans_skip_what_ended_before(spark, folder):
    """The bound of a load reaches the scan, also where closings are merged above it."""
    store = SatelliteStore(spark, f"{folder}/sat", TEMPORAL, buckets=1)
    for n in (1, 5, 9):
        load_into(store, frame(spark, [(1, n * DAY, f"v{n}"), (2, n * DAY, "same")]), TEMPORAL)
    batch = frame(spark, [(1, 7 * DAY, "late")])
    load = load_satellite(batch, store.read(with_state=True), TEMPORAL, lookback="to_date")
    plan = load.changes._jdf.queryExecution().executedPlan().toString()
    assert any("Filter" in line and "until" in line and "Join" not in line for line in plan.splitlines())
    assert {r["at"] for r in load.inserts.collect()} == {at(7 * DAY)}
    assert [(r["at"], r["until"]) for r in load.closings.collect()] == [(at(5 * DAY), at(7 * DAY))]


def test_satellite_store_goes_on_after_a_crash(spark, folder, monkeypatch):
    """Nothing of a load is there before its last step, and everything after it."""
    store = SatelliteStore(spark, f"{folder}/sat", TEMPORAL, buckets=2)
    store.apply(load_satellite(frame(spark, [(1, 1, "A"), (2, 1, "A")]), None, TEMPORAL), "one")
    batch = frame(spark, [(1, 5, "B"), (2, 5, "A")])

    def crash(self, *args):
        raise RuntimeError("lost")

    monkeypatch.setattr(Folder, "move", crash)
    with pytest.raises(RuntimeError, match="lost"):
        load_into(store, batch, TEMPORAL, load_id="two")
    monkeypatch.undo()
    assert contents(store.read()) == {(1, at(1), "A", MAX), (2, at(1), "A", MAX)} and store.version() == 1
    expected = {
        (1, at(1), "A", at(5)),
        (1, at(5), "B", MAX),
        (2, at(1), "A", MAX),
    }
    for _ in range(2):
        assert load_into(store, batch, TEMPORAL, load_id="two").metrics == {"inserted": 1, "updated": 1}
        assert contents(store.read()) == expected
    monkeypatch.setattr(Folder, "move", crash)
    with pytest.raises(RuntimeError, match="lost"):
        store.compact()
    monkeypatch.undo()
    assert contents(store.read()) == expected and store.compact() == 2
    # Known by name also when it is folded.
    assert load_into(store, batch, TEMPORAL, load_id="two").metrics == {"inserted": 1, "updated": 1}
    assert contents(store.read()) == expected and store.version() == 2


def test_a_load_from_an_older_state_is_refused(spark, folder):
    store = SatelliteStore(spark, f"{folder}/sat", TEMPORAL, buckets=1)
    load_into(store, frame(spark, [(1, 1, "A")]), TEMPORAL, load_id="one")
    stale = load_satellite(frame(spark, [(3, 3, "C")]), store.read(with_state=True), TEMPORAL)
    version = store.version()
    load_into(store, frame(spark, [(2, 2, "B")]), TEMPORAL, load_id="a/b - c")
    with pytest.raises(RuntimeError, match="has changed"):
        store.apply(stale, "three", version)
    assert store.applied("a/b - c") == {"inserted": 1, "closed": 0} and store.applied("three") is None
    assert contents(store.read()) == {(1, at(1), "A", MAX), (2, at(2), "B", MAX)}


def test_open_records_do_not_depend_on_flag_or_time_zone(spark, folder):
    spec = SatSpec(table="s", fk="fk", from_date="at", attributes="value", to_date_col="until")
    store = SatelliteStore(spark, f"{folder}/sat", spec, buckets=1)
    zoned = lambda rows: frame(spark, rows).withColumn("at", F.col("at").cast("timestamp"))
    load_into(store, zoned([(1, 1, "A")]), spec)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert load_into(store, zoned([(1, 10**8, "B")]), spec).metrics == {"inserted": 1, "updated": 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    states = store.read(with_state=True).groupBy("_state").count().collect()
    assert {r["_state"]: r["count"] for r in states} == {"open": 1, "closed": 1}
    other = SatSpec(
        table="s", fk="fk", from_date="at", attributes="value", to_date_col="until", max_flag="31-12-9999"
    )
    with pytest.raises(ValueError, match="max flag"):
        load_into(SatelliteStore(spark, f"{folder}/sat", other, buckets=1), zoned([(1, 3, "C")]), other)


def test_any_batch_may_come_again(spark, folder):
    """A record dropped as a repetition stays dropped, also when another one has come in between."""
    first, second = frame(spark, [(1, 1, "A"), (1, 5, "B"), (1, 9, "B")]), frame(spark, [(1, 7, "C")])
    for remember in (False, True):
        store = SatelliteStore(spark, f"{folder}/sat", TEMPORAL, buckets=1, remember_dropped=remember)
        store = replace(store, path=f"{store.path}_{remember}")
        for batch in (first, second):
            load_into(store, batch, TEMPORAL)
        before = contents(store.read())
        assert before == {(1, at(1), "A", at(5)), (1, at(5), "B", at(7)), (1, at(7), "C", MAX)}
        again = load_into(store, first, TEMPORAL).metrics["inserted"]
        assert again == (0 if remember else 1) and (contents(store.read()) == before) == remember
    assert [load.dropped for load in store.loads()] == [1, 0, 0]
    assert store.compact() == 3 and contents(store.read()) == before
    assert load_into(store, first, TEMPORAL).metrics["inserted"] == 0 and store.dropped().count() == 1


def test_fingerprints_add_up_and_see_what_is_lost(spark):
    df = spark.createDataFrame([(i % 7, f"v{i % 3}") for i in range(40)] + [(None, None)], "k int, v string")
    whole = quality.fingerprint(df, ["k", "v"])
    parts = [quality.fingerprint(df.filter(c), ["k", "v"]) for c in ("k < 3", "k >= 3", "k IS NULL")]
    assert parts[0] + parts[1] + parts[2] == whole == quality.fingerprint(df.repartition(5), ["k", "v"])
    # A pair of equal rows more or less, which exclusive or does not see; another row of the same number.
    pair = df.filter("k = 1 AND v = 'v0'").limit(1)
    twice = quality.fingerprint(df.unionAll(pair).unionAll(pair), ["k", "v"])
    assert twice.xor == whole.xor and twice != whole
    other = quality.fingerprint(df.filter("k IS NOT NULL").unionAll(pair), ["k", "v"])
    assert other.n_rows == whole.n_rows and other != whole
    assert quality.fingerprint(df.limit(0), ["k"]) == quality.Fingerprint(0, 0, 0)


def test_lost_rows_are_noticed(spark, folder, monkeypatch):
    """Rows that a lookup drops fail a load that is verified, and a chain before its next step."""
    rows = pairs(spark, ["a", "b", "a", "c"])
    whole = into_module.attach_keys
    monkeypatch.setattr(into_module, "attach_keys", lambda *args, **options: whole(*args, **options).filter("n <> 2"))
    with pytest.raises(RuntimeError, match="4 rows went in, 3 came out"):
        load_into(ParquetTable(spark, f"{folder}/one"), rows, HUB, verify=True)
    other = HubSpec(table="other", tech_key="other_id", keys="n")
    targets = {name: ParquetTable(spark, f"{folder}/{name}") for name in ("hub", "other")}
    with pytest.raises(RuntimeError, match="hub: 4 rows went in, 3 came out"):
        load_chain_into(rows, [HUB, other], targets)
    monkeypatch.undo()
    blank = rows.unionAll(spark.createDataFrame([("", 9)], "k string, n int"))
    loaded = load_into(ParquetTable(spark, f"{folder}/two"), blank, HUB, verify=True, on_invalid="reject")
    assert loaded.output.count() == 4


def test_many_small_loads_of_shuffled_parents(spark, folder):
    """No stored row of another parent is sorted, whatever the number of parents."""
    stored = frame(spark, [(fk, n, f"v{n % 3}") for fk in range(200) for n in range(1, 4)])
    batch = frame(spark, [(fk, 9, "new") for fk in range(5)])
    plain = SatSpec(table="s", fk="fk", from_date="at", attributes="value")
    table = load_satellite(stored, None, plain).inserts
    for options in ({}, {"lookback": "from_date"}):
        load = load_satellite(batch, table, plain, broadcast_bytes=0, hot_rows=None, **options)
        assert load.inserts.count() == 5
        plan = load.inserts._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftSemi") > plan.index("Window")  # below, so before, the windows


def test_sequences_do_not_repeat(spark, folder):
    spec = HubSpec(table="h", tech_key="id", keys="k", key_method=SEQUENCE)
    target = ParquetTable(spark, f"{folder}/hub")
    load_into(target, pairs(spark, ["a", "b"]), spec)
    with pytest.raises(ValueError, match="sequence_start"):
        load_into(target, pairs(spark, ["c"]), spec)
    load_into(target, pairs(spark, ["c"]), spec, sequence_start=3)
    assert {r.id for r in target.read().collect()} == {1, 2, 3}


def test_sort_orders_are_refused(spark):
    for order in (F.col("n").desc(), [F.col("k"), F.col("n").asc_nulls_last()]):
        with pytest.raises(ValueError, match="smallest first"):
            load_chain(pairs(spark, ["a"]), [HUB], {}, order_by=order)


def test_names_in_other_case(spark):
    spec = HubSpec(table="h", tech_key="id", keys={"K": "key"})
    assert load_chain(pairs(spark, ["a", "b"]), [spec], {}).loads["h"].inserts.count() == 2


def test_staged_for_now(spark):
    with staged_for_now(spark):
        folder = stage(spark.range(3), "short").inputFiles()[0]
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder)


def test_staged_for_now_keeps_to_its_thread(spark):
    """What others stage stays, whatever ends meanwhile; so does what an inner block leaves to the outer one."""
    inside, go_on = Event(), Event()

    def other():
        with staged_for_now(spark):
            inside.set()
            go_on.wait(60)

    thread = Thread(target=other)
    thread.start()
    inside.wait(60)
    kept = stage(spark.range(3), "kept")
    with staged_for_now(spark):
        outer = stage(spark.range(4), "outer")
        with staged_for_now(spark):
            inner = stage(spark.range(5), "inner").inputFiles()[0]
        assert outer.count() == 4
        with pytest.raises(AnalysisException):
            spark.read.parquet(inner)
        go_on.set()
        thread.join()
        assert outer.count() == 4
    assert kept.count() == 3


def test_two_streams_beside_a_batch_load(spark, folder):
    """Micro-batches of two streams and a batch chain stage at the same time; none removes what another reads."""
    streams, targets = [], []
    for name in ("x", "y"):
        source = f"{folder}/in_{name}"
        for n in range(3):
            frame(spark, [(fk, n * 10 + 1, f"{name}{n}") for fk in range(5)]).write.mode("append").parquet(source)
        read = spark.readStream.schema(frame(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(source)
        target = SatelliteStore(spark, f"{folder}/{name}", TEMPORAL, buckets=1)
        targets.append(target)
        streams.append(load_stream(read, target, TEMPORAL, checkpoint=f"{folder}/progress_{name}"))
    staged = stage(frame(spark, [(fk, 1, "b") for fk in range(50)]), "batch")
    while any(s.isActive for s in streams):
        assert staged.count() == 50
        load_into(ParquetTable(spark, f"{folder}/batch_{uuid.uuid4().hex}"), pairs(spark, ["a", "b"]), HUB)
    for query, target in zip(streams, targets):
        query.awaitTermination()
        assert target.read().count() == 15
    assert staged.count() == 50


def test_targets_must_fit_the_specification(spark, folder):
    plain = SatSpec(table="s", fk="fk", from_date="at", attributes=["value"])
    with pytest.raises(ValueError, match="no to-date"):
        SatelliteStore(spark, folder, plain)
    with pytest.raises(ValueError, match="SatelliteStore"):
        load_into(ParquetTable(spark, f"{folder}/s"), frame(spark, [(1, 1, "A")]), TEMPORAL)
    target = ParquetTable(spark, f"{folder}/plain")
    loaded = load_into(target, frame(spark, [(1, 1, "A"), (1, 2, "B")]), plain)
    assert loaded.metrics == {"inserted": 2, "updated": 0}


def test_chain_reads_keys_of_earlier_steps(spark):
    df = spark.createDataFrame(
        [("c1", "o1", at(1), "A"), ("c1", "o2", at(2), "A"), ("c2", "o3", at(1), "B")],
        "customer string, order string, at timestamp_ntz, status string",
    )
    specs = [
        HubSpec(table="hc", tech_key="customer_id", keys="customer"),
        HubSpec(table="ho", tech_key="order_id", keys="order"),
        LinkSpec(table="l", tech_key="link_id", keys=["customer_id", "order_id"]),
        SatSpec(table="s", fk="link_id", from_date="at", attributes="status"),
    ]
    for cut in (True, False):
        chain = load_chain(df, specs, {}, cut=cut)
        assert chain.output.columns == [*df.columns, "customer_id", "order_id", "link_id"]
        counts = {name: load.inserts.count() for name, load in chain.loads.items()}
        assert counts == {"hc": 2, "ho": 3, "l": 3, "s": 3}
    again = load_chain(df, specs, {"hc": chain.loads["hc"].inserts})
    assert again.loads["hc"].inserts.count() == 0
    with pytest.raises(ValueError, match="twice"):
        load_chain(df, [specs[0], specs[0]], {})


def test_chain_stages_once_and_takes_options(spark, monkeypatch):
    df = spark.createDataFrame([("c1", "o1"), ("c1", "o2"), ("", "o3")], "customer string, order string")
    specs = [
        HubSpec(table="hc", tech_key="customer_id", keys="customer", key_method=SEQUENCE),
        HubSpec(table="ho", tech_key="order_id", keys="order"),
        LinkSpec(table="l", tech_key="link_id", keys=["customer_id", "order_id"]),
    ]
    staged = []
    monkeypatch.setattr("vaultwright.plans.chain.stage", lambda rows, name: staged.append(name) or stage(rows, name))
    load_chain(df.filter("customer <> ''"), specs, {}).output.count()
    assert len(staged) == 1
    chain = load_chain(df, specs, {}, options={"hc": {"on_invalid": "reject", "sequence_start": 50}})
    assert {r.customer_id for r in chain.output.collect()} == {50}
    assert chain.output.count() == 2 and chain.loads["hc"].rejects.count() == 1


def test_chain_that_writes(spark, folder):
    df = spark.createDataFrame([("c1", "o1"), ("c1", "o2")], "customer string, order string")
    specs = [
        HubSpec(table="hc", tech_key="customer_id", keys="customer", key_method=SEQUENCE),
        HubSpec(table="ho", tech_key="order_id", keys="order"),
        LinkSpec(table="l", tech_key="link_id", keys=["customer_id", "order_id"]),
    ]
    targets = {s.table: ParquetTable(spark, f"{folder}/{s.table}") for s in specs}
    options = {"hc": {"sequence": Sequence(spark, f"{folder}/sequence")}}
    for n, inserted in ((1, [1, 2, 2]), (2, [0, 0, 0])):
        chain = load_chain_into(df, specs, targets, options=options)
        assert [m["inserted"] for m in chain.metrics.values()] == inserted
        assert chain.output.count() == 2


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert all(shared_folder(spark) in f for f in staged.inputFiles())


# -- streams -------------------------------------------------------------------


def write_files(spark, folder, batches, schema):
    """One file per batch, read one per micro-batch in this order."""
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_stream_of_several_batches(spark, folder):
    schema = "k string, n int"
    batches = [[("a", 1), ("b", 2)], [("b", 3), ("c", 4)], [("a", 5), ("d", 6)]]
    stream = write_files(spark, folder, batches, schema)
    target = ParquetTable(spark, f"{folder}/hub")
    seen = ParquetTable(spark, f"{folder}/seen")
    query = load_stream(
        stream, target, HUB, checkpoint=f"{folder}/c", then=lambda df, n: seen.append(df)
    )
    query.awaitTermination()
    hub = {r.k: r.id for r in target.read().collect()}
    assert set(hub) == set("abcd") and sorted(hub.values()) == [1, 2, 3, 4]
    assert {(r.n, r.id) for r in seen.read().collect()} == {
        (n, hub[k]) for batch in batches for k, n in batch
    }


def test_late_records_in_a_stream_with_to_dates(spark, folder):
    schema = "fk bigint, at timestamp_ntz, value string"
    batches = [[(1, at(50), "C")], [(1, at(10), "A"), (2, at(1), "A")], [(1, at(30), "B")]]
    stream = write_files(spark, folder, batches, schema)
    store = SatelliteStore(spark, f"{folder}/sat", TEMPORAL, buckets=2)
    load_stream(stream, store, TEMPORAL, checkpoint=f"{folder}/c").awaitTermination()
    assert contents(store.read()) == {
        (1, at(10), "A", at(30)),
        (1, at(30), "B", at(50)),
        (1, at(50), "C", MAX),
        (2, at(1), "A", MAX),
    }


# -- quality -------------------------------------------------------------------


def test_quality_reports(spark):
    hub = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, id bigint")
    assert [tuple(r) for r in quality.duplicate_keys(hub, HUB).collect()] == [("a", 2)]
    batch = pairs(spark, ["a", "z", "z"])
    assert [tuple(r) for r in quality.unresolved_keys(batch, hub, HUB).collect()] == [("z", 2)]
    child = spark.createDataFrame([(1,), (9,), (9,)], "fk bigint")
    assert [tuple(r) for r in quality.orphans(child, "fk", hub, "id").collect()] == [(9, 2)]
    sat = frame(spark, [(1, 1, "A"), (1, 1, "B"), (1, 2, "B")])
    assert [r.n_rows for r in quality.duplicate_records(sat, TEMPORAL).collect()] == [2]
    static = SatSpec(table="s", fk="fk", attributes=["value"])
    assert [tuple(r) for r in quality.duplicate_records(sat, static).collect()] == [(1, 3)]
    rows = spark.createDataFrame(
        [(None, datetime(2020, 1, 1), "A"), (1, None, "A"), (1, datetime(2020, 1, 1), "")],
        "fk bigint, at timestamp_ntz, value string",
    )
    reasons = {r.reason for r in quality.invalid_rows(rows, TEMPORAL).collect()}
    assert reasons == {"fk is NULL", "at is NULL"}
    keys = HubSpec(table="h", tech_key="id", keys=["value", "fk"])
    assert {r.reason for r in quality.invalid_rows(rows, keys).collect()} == {
        "fk is NULL",
        "value is empty",
    }
