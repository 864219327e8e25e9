import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.operators import attach_keys, load_hub, load_link, load_satellite
from vaultwright.operators.numbering import BUCKETS
from vaultwright.spec import AUTO_INCREMENT, SEQUENCE, HubSpec, LinkSpec, SatSpec

HUB = HubSpec(table="hub", tech_key="id", keys=["k"])

# Every way a lookup can be joined: broadcast, shuffled, and shuffled with hot keys.
JOINS = [
    {},
    {"broadcast_bytes": 0},
    {"broadcast_bytes": 0, "hot_rows": 3},
    {"broadcast_bytes": 0, "hot_rows": None},
]


def stream(spark, keys, schema="k string, n int"):
    return spark.createDataFrame([(k, n) for n, k in enumerate(keys)], schema)


def stored(spark, pairs, schema="k string, id bigint"):
    return spark.createDataFrame(pairs, schema)


@pytest.mark.parametrize("options", JOINS, ids=str)
def test_initial_and_incremental_load(spark, options):
    rng = random.Random(5)
    keys = [rng.choice("abcdefghij") for _ in range(40)] + ["hot"] * 30
    first = load_hub(stream(spark, keys), None, HUB, **options)
    inserted = {r.k: r.id for r in first.inserts.collect()}
    assert sorted(inserted.values()) == list(range(1, len(set(keys)) + 1))
    out = first.output
    assert out.columns == ["k", "n", "id"]
    assert sorted((r.n, r.k, r.id) for r in out.collect()) == [
        (n, k, inserted[k]) for n, k in enumerate(keys)
    ]

    more = keys + ["x", "x", "y", "hot2"] + ["hot2"] * 10
    table = stored(spark, [(k, i) for k, i in inserted.items()])
    second = load_hub(stream(spark, more), table, HUB, **options)
    added = {r.k: r.id for r in second.inserts.collect()}
    assert set(added) == {"x", "y", "hot2"}
    assert sorted(added.values()) == [len(inserted) + i for i in (1, 2, 3)]
    everything = {**inserted, **added}
    assert sorted((r.n, r.id) for r in second.output.collect()) == [
        (n, everything[k]) for n, k in enumerate(more)
    ]
    known_only = attach_keys(stream(spark, more), table, HUB, **options)
    assert known_only.count() == len(keys)

    after = table.unionByName(second.inserts)
    assert load_hub(stream(spark, more), after, HUB, **options).inserts.count() == 0


def test_numbers_do_not_depend_on_the_plan(spark):
    keys = [f"key-{n % 700}" for n in range(2000)]
    one = load_hub(stream(spark, keys).repartition(7), None, HUB)
    two = load_hub(stream(spark, keys[::-1]).repartition(3), None, HUB, broadcast_bytes=0)
    expected = {tuple(r) for r in one.inserts.collect()}
    assert {tuple(r) for r in two.inserts.collect()} == expected
    assert {(r.k, r.id) for r in two.output.collect()} == expected
    assert {i for _, i in expected} == set(range(1, 701))


def test_sequence_and_auto_increment(spark):
    df = stream(spark, [f"key-{n}" for n in range(500)])
    sequence = HubSpec(
        table="h", tech_key="id", keys="k", key_method=SEQUENCE, sequence_start=1000,
        sequence_increment=5,
    )
    ids = {r.id for r in load_hub(df, None, sequence).inserts.collect()}
    assert ids == set(range(1000, 1000 + 5 * 500, 5))
    later = {r.id for r in load_hub(df, None, sequence, sequence_start=7).inserts.collect()}
    assert min(later) == 7

    auto = HubSpec(table="h", tech_key="id", keys="k", key_method=AUTO_INCREMENT)
    table = stored(spark, [("old", 90)])
    ids = [r.id for r in load_hub(df, table, auto).inserts.collect()]
    assert len(set(ids)) == 500 and min(ids) > 90
    assert max(ids) <= 90 + 4 * BUCKETS


def test_first_row_gives_the_other_attributes(spark):
    spec = HubSpec(table="h", tech_key="id", keys="k", others={"n": "first_n", "v": "v"})
    rows = [("a", 3, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 9, None)]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    table = spark.createDataFrame([("b", 1, "old", 4)], "k string, first_n int, v string, id bigint")

    def inserted(**options):
        load = load_hub(df, table, spec, **options)
        assert load.inserts.columns == ["k", "first_n", "v", "id"]
        return [tuple(r) for r in load.inserts.collect()]

    assert inserted() == [("a", 1, "y", 5)]
    assert inserted(order_by="v") == [("a", 3, "x", 5)]
    assert inserted(order_by=[-F.col("n")]) == [("a", 3, "x", 5)]


def test_duplicates_in_the_hub_do_not_multiply(spark):
    table = stored(spark, [("a", 5), ("a", 2), ("b", 3)])
    out = load_hub(stream(spark, ["a", "a", "b", "c"]), table, HUB).output
    assert sorted((r.k, r.id) for r in out.collect()) == [("a", 2), ("a", 2), ("b", 3), ("c", 6)]


def test_blank_keys(spark):
    spec = HubSpec(table="h", tech_key="id", keys=["k", "n"])
    rows = [("a", 1), ("", 1), (None, 1), ("a", None), (" ", 1)]
    df = spark.createDataFrame(rows, "k string, n int")
    with pytest.raises(Exception, match="h: key field (k|n) is NULL or empty"):
        load_hub(df, None, spec).inserts.collect()
    load = load_hub(df, None, spec, on_invalid="reject")
    assert {r.k for r in load.output.collect()} == {"a", " "}
    assert load.rejects.count() == 3
    with pytest.raises(ValueError):
        load_hub(df, None, spec, on_invalid="ignore")


def test_composite_key_equality(spark):
    """All parts count, a trailing space matters, types follow the table."""
    spec = HubSpec(table="h", tech_key="id", keys=["a", "b", "c"])
    day = datetime(2020, 1, 1)
    rows = [("x", 1, day), ("x ", 1, day), ("x", 2, day), ("x", 1, day)]
    df = spark.createDataFrame(rows, "a string, b int, c timestamp_ntz")
    assert load_hub(df, None, spec).inserts.count() == 3
    table = spark.createDataFrame(
        [("x", 1, date(2020, 1, 1), 1)], "a string, b bigint, c date, id bigint"
    )
    load = load_hub(df, table, spec)
    assert load.inserts.count() == 2
    assert load.inserts.schema["b"].dataType == T.LongType()
    assert load.inserts.schema["c"].dataType == T.DateType()


def test_binary_input_is_decoded(spark):
    df = stream(spark, ["zoë", "bob"]).withColumn("k", F.encode("k", "UTF-8"))
    spec = HubSpec(table="h", tech_key="id", keys="k", types={"k": "string"})
    load = load_hub(df, None, spec)
    assert {r.k for r in load.inserts.collect()} == {"zoë", "bob"}
    assert load.output.schema["k"].dataType == T.StringType()
    known = load_hub(df, stored(spark, [("bob", 7)]), HUB)
    assert [r.k for r in known.inserts.collect()] == ["zoë"]
    as_is = load_hub(df, None, HUB)
    assert as_is.inserts.schema["k"].dataType == T.BinaryType()


def test_audit_columns_and_variables(spark):
    spec = HubSpec(
        schema="${layer}", table="hub_${name}", tech_key="id", keys="k",
        load_dts_col="dts", rec_src_col="src", rec_src="${layer}/${unknown}",
        variables={"layer": "raw", "name": "x"},
    )
    assert spec.qualified_table == "raw.hub_x"
    stamp = datetime(2024, 1, 2, 3)
    load = load_hub(stream(spark, ["a"]), None, spec, load_ts=stamp)
    assert load.inserts.columns == ["k", "dts", "src", "id"]
    assert tuple(load.inserts.collect()[0]) == ("a", stamp, "raw/${unknown}", 1)


def test_odd_column_names(spark):
    df = stream(spark, ["a", "b"]).toDF("my.key", "and `this`")
    spec = HubSpec(
        table="h", tech_key="h.id", keys={"my.key": "business key"}, others={"and `this`": "o.o"}
    )
    load = load_hub(df, None, spec)
    assert load.inserts.columns == ["business key", "o.o", "h.id"]
    assert load.output.columns == ["my.key", "and `this`", "h.id"]
    assert load.output.count() == 2


def test_link_over_two_hubs(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "x"), ("a", "x")]
    df = spark.createDataFrame(rows, "left string, right string")
    left = HubSpec(table="hl", tech_key="left_id", keys="left")
    right = HubSpec(table="hr", tech_key="right_id", keys="right")
    link = LinkSpec(table="l", tech_key="link_id", keys=["left_id", "right_id"])
    keyed = load_hub(load_hub(df, None, left).output, None, right).output
    load = load_link(keyed, None, link)
    assert sorted(r.link_id for r in load.inserts.collect()) == [1, 2, 3]
    assert load.output.columns == ["left", "right", "left_id", "right_id", "link_id"]
    sat = SatSpec(table="s", fk="link_id", attributes=["left", "right"])
    assert load_satellite(load.output, None, sat).inserts.count() == 3


def test_specs_are_checked(spark):
    df = stream(spark, ["a"])
    for bad in (
        {"keys": []},
        {"tech_key": ""},
        {"key_method": "uuid"},
        {"table": ""},
        {"others": ["k"]},
        {"keys": ["k", "k"]},
        {"load_dts_col": "k"},
        {"key_method": SEQUENCE, "sequence_increment": 0},
    ):
        with pytest.raises(ValueError):
            HubSpec(**{"table": "h", "tech_key": "id", "keys": "k", **bad})
    with pytest.raises(ValueError):
        LinkSpec(table="l", tech_key="id", keys=["k"])
    with pytest.raises(ValueError, match="not found in the input"):
        load_hub(df.drop("k"), None, HUB)
    with pytest.raises(ValueError, match="not found in the target"):
        load_hub(df, df, HUB)
    with pytest.raises(ValueError, match="already has a column"):
        load_hub(df.withColumn("id", F.lit(1)), None, HUB)
    link = LinkSpec(table="l", tech_key="id", keys=["k", "n"])
    with pytest.raises(ValueError):
        load_hub(df, None, link)
    with pytest.raises(ValueError):
        load_link(df, None, HUB)
