"""Lookups of batches too large to broadcast, numbers in key order, and chains on streams."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.test_satellite import at, frame
from vaultwright.operators import load_hub, load_satellite
from vaultwright.operators.skew import maybe_wanted
from vaultwright.plans import into, load_into
from vaultwright.sources import CatalogTable, ParquetTable, SatelliteStore
from vaultwright.spec import AUTO_INCREMENT, BY_KEY, SEQUENCE, HubSpec, LinkSpec, SatSpec
from vaultwright.streaming import load_chain_stream

HUB = HubSpec(table="hub", tech_key="id", keys=["k"])
PLAIN = SatSpec(table="s", fk="fk", from_date="at", attributes="value")


@pytest.fixture
def folder(tmp_path):
    return f"file:{tmp_path}"


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def bucketed(spark, folder, key, buckets):
    name = f"t_{uuid.uuid4().hex}"
    return CatalogTable(spark, name, (key,), buckets, f"{folder}/{name}")


def exchanges_above_scan(df, table):
    """Exchanges on the way from the scan of a table to the root of the plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    lines = lines[: next((i for i, line in enumerate(lines) if "Initial Plan" in line), len(lines))]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    at_ = next(i for i, line in enumerate(lines) if table in line and "Scan" in line)
    found, level = [], depth(lines[at_])
    for line in reversed(lines[:at_]):
        if depth(line) < level:
            level = depth(line)
            if "Exchange" in line:
                found.append(line.strip())
    assert "Bucketed: true" in lines[at_]
    return found


@pytest.mark.parametrize("buckets", [3, 16])
def test_hub_lookup_leaves_buckets_in_place(spark, folder, no_auto_broadcast, buckets):
    target = bucketed(spark, folder, "k", buckets)
    load_into(target, spark.range(0, 60, 2).withColumnRenamed("id", "k"), HUB)
    batch = spark.range(40).withColumnRenamed("id", "k")
    assert target.key_buckets(HUB) == buckets
    load = load_hub(batch, target.read(), HUB, broadcast_bytes=0, stored_buckets=buckets)
    assert exchanges_above_scan(load.known, target.name) == []
    assert load.known.count() == 20 and load.inserts.count() == 20
    output = load_into(target, batch, HUB, broadcast_bytes=0).output
    ids = {r.k: r.id for r in target.read().collect()}
    assert len(ids) == 50 and sorted(ids.values()) == list(range(1, 51))
    assert {(r.k, r.id) for r in output.collect()} == {(k, ids[k]) for k in range(40)}


def test_satellite_load_leaves_buckets_in_place(spark, folder, no_auto_broadcast):
    target = bucketed(spark, folder, "fk", 3)
    stored = frame(spark, [(fk, n, f"v{n % 3}") for fk in range(30) for n in range(1, 4)])
    load_into(target, stored, PLAIN, broadcast_bytes=0)
    batch = frame(spark, [(fk, n, f"v{n % 2}") for fk in range(20, 40) for n in range(2, 7)])
    options = {"broadcast_bytes": 0, "hot_rows": None}
    moved = load_satellite(batch, target.read(), PLAIN, **options).inserts
    in_place = load_satellite(batch, target.read(), PLAIN, stored_buckets=3, **options).inserts
    assert exchanges_above_scan(in_place, target.name) == []
    assert sorted(map(tuple, in_place.collect())) == sorted(map(tuple, moved.collect())) != []
    hot = load_satellite(batch, target.read(), PLAIN, stored_buckets=3, broadcast_bytes=0, hot_rows=2).inserts
    assert sorted(map(tuple, hot.collect())) == sorted(map(tuple, moved.collect()))
    # Bucketed by something else, so nothing is known about where the rows are.
    assert CatalogTable(spark, "x", ("at",), 3).key_buckets(PLAIN) is None
    assert CatalogTable(spark, "x").key_buckets(PLAIN) is None


def test_bitmap_keeps_wanted_keys_and_few_others(spark):
    stored = spark.range(100_000).select(F.col("id").alias("k"), F.concat(F.lit("x"), "id").alias("name"))
    for step, at_most in ((1000, 9_000), (100, 9_000)):
        wanted = stored.filter(F.col("k") % step == 0).select("k", "name")
        n = wanted.count()
        for keys in (["k"], ["k", "name"]):
            passed = maybe_wanted(stored, wanted, keys, n)
            assert passed.columns == stored.columns
            assert passed.join(wanted, ["k", "name"], "left_semi").count() == n
            assert n <= passed.count() < at_most
    # No wanted key, and more of them than bits would help.
    assert maybe_wanted(stored, stored.limit(0), ["k"], 0).count() == 0
    assert maybe_wanted(stored, stored, ["k"], 100_000, bitmap_bytes=1 << 10).count() == 100_000


def test_shuffled_rows_follow_the_batch(spark, no_auto_broadcast):
    """Above the broadcast limit a load still meets only what may be of its keys in the shuffle."""
    hub = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("id")).repartition(4)
    batch = spark.range(49_990, 50_010).withColumnRenamed("id", "k")
    load = load_hub(batch, hub, HUB, broadcast_bytes=0)
    assert "Filter (cast(getbit" in load.known._jdf.queryExecution().toString() or "getbit" in (
        load.known._jdf.queryExecution().optimizedPlan().toString()
    )
    assert {r["__tech_key"] for r in load.known.collect()} == set(range(49_991, 50_001))
    assert load.inserts.count() == 10


def test_numbers_in_key_order(spark):
    spec = HubSpec(table="h", tech_key="id", keys=["a", "b"], key_order=BY_KEY)
    rows = [(f"k{(n * 7919) % 300:03d}", n % 3) for n in range(2000)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(7)
    first = load_hub(df, None, spec).inserts
    expected = {key: i for i, key in enumerate(sorted(set(rows)), 1)}
    assert {(r.a, r.b): r.id for r in first.collect()} == expected
    more = spark.createDataFrame([("a", 1), ("z", 9), ("k000", 0), ("a", 0)], "a string, b int")
    second = load_hub(more, first, spec).inserts
    n = len(expected)
    assert {(r.a, r.b): r.id for r in second.collect()} == {("a", 0): n + 1, ("a", 1): n + 2, ("z", 9): n + 3}
    numbered = HubSpec(table="h", tech_key="id", keys="a", key_order=BY_KEY, key_method=SEQUENCE, sequence_start=10)
    assert {r.a: r.id for r in load_hub(more, None, numbered).inserts.collect()} == {"a": 10, "k000": 11, "z": 12}
    assert load_hub(more.limit(0), None, spec).inserts.count() == 0
    for bad in ({"key_order": "up"}, {"key_order": BY_KEY, "key_method": AUTO_INCREMENT}):
        with pytest.raises(ValueError):
            HubSpec(table="h", tech_key="id", keys="a", **bad)


LEFT = HubSpec(table="left", tech_key="left_id", keys="a")
RIGHT = HubSpec(table="right", tech_key="right_id", keys="b")
LINK = LinkSpec(table="link", tech_key="link_id", keys=["left_id", "right_id"])
STATE = SatSpec(table="state", fk={"link_id": "link"}, from_date="at", attributes="value", to_date_col="until")


def test_chain_on_a_stream_goes_on_after_a_crash(spark, folder, monkeypatch):
    """The second micro-batch stops between link and satellite; the restarted query ends with whole tables."""
    source = f"{folder}/in"
    for n in range(3):
        rows = [(f"a{i % 4}", f"b{(i + n) % 3}", at(n * 10 + 1), f"v{n}") for i in range(6)]
        df = spark.createDataFrame(rows, "a string, b string, at timestamp_ntz, value string")
        df.coalesce(1).write.mode("append").parquet(source)
    specs = [LEFT, RIGHT, LINK, STATE]
    targets = {s.table: ParquetTable(spark, f"{folder}/{s.table}") for s in specs[:-1]}
    targets["state"] = SatelliteStore(spark, f"{folder}/state", STATE, buckets=2)
    seen = []

    def start():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        return load_chain_stream(
            stream, specs, targets, checkpoint=f"{folder}/progress",
            then=lambda chain, batch: seen.append((batch, chain.metrics["state"]["inserted"])),
        )

    whole = into._satellite_into

    def fails_at_the_second(*args):
        if seen:
            raise RuntimeError("lost")
        return whole(*args)

    monkeypatch.setattr(into, "_satellite_into", fails_at_the_second)
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    monkeypatch.undo()
    links = targets["link"].read()
    assert targets["state"].version() == 1 and links.count() > targets["state"].read().count()
    before = {(r.left_id, r.right_id): r.link_id for r in links.collect()}
    start().awaitTermination()
    assert [batch for batch, _ in seen] == [0, 1, 2]
    found = {(r.left_id, r.right_id): r.link_id for r in targets["link"].read().collect()}
    assert before.items() <= found.items() and len(set(found.values())) == len(found) == 12
    state = targets["state"].read()
    names = (
        state.join(targets["link"].read(), F.col("link") == F.col("link_id"))
        .join(targets["left"].read(), "left_id")
        .join(targets["right"].read(), "right_id")
    )
    expected = {(f"a{i % 4}", f"b{(i + n) % 3}", at(n * 10 + 1), f"v{n}") for n in range(3) for i in range(6)}
    assert {(r.a, r.b, r["at"], r.value) for r in names.collect()} == expected
    assert state.count() == len(expected)
    # A repeated batch has the name of the load before it and changes nothing.
    assert load_into(targets["state"], state, TEMPORAL_LINK, load_id="again").metrics["inserted"] == 0


TEMPORAL_LINK = SatSpec(table="state", fk="link", from_date="at", attributes="value", to_date_col="until")
