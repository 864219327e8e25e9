import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import timeline_model
from vaultwright.operators import idempotent_view, load_satellite, satellite, validity_view
from vaultwright.spec import SatSpec
from vaultwright.staging import stage

EPOCH = datetime(2020, 1, 1)
MAX = datetime(4000, 1, 1)
SCHEMA = "fk bigint, at timestamp_ntz, value string, pos int"
TEMPORAL = SatSpec(table="sat", fk="fk", from_date="at", attributes=["value"], to_date_col="until")


def at(n):
    return EPOCH + timedelta(milliseconds=n)


def frame(spark, records):
    rows = [(fk, at(n), value, pos) for pos, (fk, n, value) in enumerate(records)]
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, stored, batch, spec=TEMPORAL, **options):
    table = frame(spark, stored).drop("pos").withColumn("until", F.lit(MAX).cast("timestamp_ntz"))
    load = load_satellite(
        frame(spark, batch), table if stored else None, spec, order_by=["pos"], **options
    )

    def number(moment):
        return "max" if moment == MAX else round((moment - EPOCH) / timedelta(milliseconds=1))

    inserts = {(r.fk, number(r.at), r.value, number(r.until)) for r in load.inserts.collect()}
    closings = {(r.fk, number(r.at), number(r.until)) for r in load.closings.collect()}
    return inserts, closings


# (name, stored, batch, inserts, closings), all for parent 1
HAND_CASES = [
    ("leading run", [], [(1, "A"), (2, "A"), (3, "B")], [(2, "A", 3), (3, "B", "max")], []),
    ("later run", [], [(1, "B"), (2, "A"), (3, "A")], [(1, "B", 2), (2, "A", "max")], []),
    ("earlier, same value", [(5, "A")], [(3, "A")], [], []),
    ("earlier, other value", [(5, "A")], [(3, "B")], [(3, "B", 5)], []),
    ("equal to the next only", [(1, "A"), (5, "B")], [(3, "B")], [(3, "B", 5)], [(1, 3)]),
    ("repeat of latest", [(1, "A")], [(4, "A")], [], []),
    ("change after latest", [(1, "A")], [(4, "B")], [(4, "B", "max")], [(1, 4)]),
    ("same identity, other value", [(1, "A")], [(1, "B")], [], []),
    ("duplicate in batch", [], [(1, "A"), (1, "B")], [(1, "A", "max")], []),
    ("empty after NULL", [(1, None)], [(2, "")], [], []),
    ("NULL first", [], [(1, None)], [(1, None, "max")], []),
]


@pytest.mark.parametrize("options", [{}, {"hot_rows": 0, "slice_millis": 2}], ids=["cold", "hot"])
def test_hand_cases(spark, options):
    """All hand cases at once, one parent each."""
    stored, batch, inserts, closings = [], [], set(), set()
    for fk, (_, before, new, expected, closed) in enumerate(HAND_CASES):
        stored += [(fk, *r) for r in before]
        batch += [(fk, *r) for r in new]
        inserts |= {(fk, *r) for r in expected}
        closings |= {(fk, *r) for r in closed}
    assert run(spark, stored, batch, **options) == (inserts, closings)


def random_records(rng, parents, per_parent, span):
    values = ["A", "B", None, ""]
    return [
        (fk, rng.randrange(span), rng.choice(values))
        for fk in range(parents)
        for _ in range(rng.randrange(per_parent + 1))
    ]


def random_stored(rng, parents, per_parent, span):
    seen = {}
    for fk, n, value in random_records(rng, parents, per_parent, span):
        seen.setdefault((fk, n), value)
    return [(fk, n, value) for (fk, n), value in seen.items()]


OPTIONS = [
    {},
    {"hot_rows": None},
    {"lookback": "from_date"},
    {"broadcast_bytes": 0},
    {"hot_rows": 5, "slice_millis": 3},
    {"hot_rows": 0, "slice_millis": 1, "lookback": "from_date"},
]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
@pytest.mark.parametrize("idempotent", [True, False])
def test_against_model(spark, options, idempotent):
    rng = random.Random(7)
    stored = random_stored(rng, 400, 6, 25)
    batch = random_records(rng, 440, 8, 25)
    spec = SatSpec(
        table="sat",
        fk="fk",
        from_date="at",
        attributes=["value"],
        to_date_col="until",
        idempotent=idempotent,
    )
    assert run(spark, stored, batch, spec, **options) == timeline_model.load(
        stored, batch, idempotent
    )


def test_first_run_earliest(spark):
    spec = SatSpec(
        table="sat",
        fk="fk",
        from_date="at",
        attributes=["value"],
        to_date_col="until",
        first_run="earliest",
    )
    batch = [(1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (2, 1, "A"), (2, 2, "A")]
    stored = [(2, 9, "A"), (1, 30, "C")]
    for options in ({}, {"hot_rows": 0, "slice_millis": 1}):
        inserts, closings = run(spark, stored, batch, spec, **options)
        assert inserts == {(1, 1, "A", 3), (1, 3, "B", 30)}
        assert closings == set()


def test_identity_is_the_millisecond(spark):
    rows = [
        (1, EPOCH + timedelta(microseconds=100), "A"),
        (1, EPOCH + timedelta(microseconds=900), "B"),
        (1, EPOCH + timedelta(milliseconds=1), "C"),
    ]
    df = spark.createDataFrame(rows, "fk bigint, at timestamp_ntz, value string")
    inserts = load_satellite(df, None, TEMPORAL).inserts.collect()
    assert {(r.at, r.value) for r in inserts} == {(rows[0][1], "A"), (rows[2][1], "C")}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_identity_of_local_times_ignores_the_session_zone(spark, zone):
    # 02:30 does not exist in New York on this day; it must not meet 03:30.
    rows = [(1, datetime(2020, 3, 8, 2, 30), "A"), (1, datetime(2020, 3, 8, 3, 30), "B")]
    rows.append((1, datetime(1960, 1, 1, 23, 59, 59, 999_999), "C"))
    df = spark.createDataFrame(rows, "fk bigint, at timestamp_ntz, value string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert load_satellite(df, None, TEMPORAL).inserts.count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates_as_from_date(spark):
    rows = [(1, date(2020, 1, 1), "A"), (1, date(2020, 1, 2), "B"), (1, date(2020, 1, 2), "C")]
    df = spark.createDataFrame(rows, "fk bigint, at date, value string")
    inserts = load_satellite(df, None, TEMPORAL).inserts
    assert inserts.schema["until"].dataType == T.DateType()
    assert {tuple(r) for r in inserts.collect()} == {
        (1, date(2020, 1, 1), "A", date(2020, 1, 2)),
        (1, date(2020, 1, 2), "B", date(4000, 1, 1)),
    }


def test_timestamp_attributes_compare_by_millisecond(spark):
    def row(n, micros):
        return (1, at(n), EPOCH + timedelta(microseconds=micros))

    schema = "fk bigint, at timestamp, value timestamp"
    stored = spark.createDataFrame([row(1, 100)], schema)
    spec = SatSpec(table="sat", fk="fk", from_date="at", attributes=["value"])
    batch = spark.createDataFrame([row(2, 900), row(3, 1900)], schema)
    inserts = load_satellite(batch, stored, spec).inserts.collect()
    assert [r.at for r in inserts] == [at(3)]


def test_static_first_wins_and_stored_wins(spark):
    spec = SatSpec(table="sat", fk="fk", attributes=["value"], meta=["pos"])
    batch = frame(spark, [(1, 0, "B"), (1, 0, "A"), (2, 0, ""), (3, 0, "X")])
    stored = spark.createDataFrame([(3, "old", 0)], "fk bigint, value string, pos int")
    load = load_satellite(batch, stored, spec, order_by="pos")
    assert {tuple(r) for r in load.inserts.collect()} == {(1, "B", 0), (2, None, 2)}
    assert load.closings is None
    assert load.output.collect() == batch.collect()
    default_order = load_satellite(batch, None, spec).inserts.filter("fk = 1").collect()
    assert default_order[0].value == "A"


def test_meta_attributes_are_stored_but_not_compared(spark):
    spec = SatSpec(table="sat", fk="fk", from_date="at", attributes=["value"], meta=["note"])
    schema = "fk bigint, at timestamp_ntz, value string, note string"
    stored = spark.createDataFrame([(1, at(1), "A", "x")], schema)
    batch = spark.createDataFrame([(1, at(2), "A", "y"), (1, at(3), "B", "")], schema)
    inserts = load_satellite(batch, stored, spec).inserts.collect()
    assert [(r.value, r.note) for r in inserts] == [("B", "")]


def test_audit_columns_and_column_order(spark):
    spec = SatSpec(
        table="sat_${env}",
        fk={"fk": "hub_id"},
        from_date={"at": "valid_from"},
        attributes={"value": "v"},
        meta={"pos": "p"},
        to_date_col="valid_to",
        load_dts_col="load_dts",
        rec_src_col="rec_src",
        rec_src="${env}-feed",
        variables={"env": "test"},
    )
    assert spec.table == "sat_test"
    stamp = datetime(2024, 5, 6)
    inserts = load_satellite(frame(spark, [(1, 1, "A")]), None, spec, load_ts=stamp).inserts
    assert inserts.columns == ["hub_id", "valid_from", "v", "p", "valid_to", "load_dts", "rec_src"]
    row = inserts.collect()[0]
    assert (row.load_dts, row.rec_src, row.valid_to) == (stamp, "test-feed", MAX)


def test_to_date_switch(spark):
    batch = frame(spark, [(1, 1, "A")])
    for unused in (None, "", "n.a."):
        spec = SatSpec(
            table="s", fk="fk", from_date="at", attributes=["value"], to_date_col=unused
        )
        load = load_satellite(batch, None, spec)
        assert load.closings is None and load.inserts.columns == ["fk", "at", "value"]


def test_replay_of_the_batch_inserts_nothing(spark):
    rng = random.Random(11)
    stored = random_stored(rng, 100, 5, 25)
    batch = random_records(rng, 110, 6, 25)
    inserts, _ = run(spark, stored, batch)
    after = stored + [(fk, n, value) for fk, n, value, _ in inserts]
    assert run(spark, after, batch) == (set(), set())


@pytest.mark.parametrize("options", [{}, {"hot_rows": 2, "slice_millis": 4}], ids=["cold", "hot"])
def test_virtual_and_materialized_to_dates_agree(spark, options):
    rng = random.Random(3)
    table = {}
    for _ in range(3):
        stored = [(fk, n, value) for (fk, n), (value, _) in table.items()]
        inserts, closings = run(spark, stored, random_records(rng, 60, 5, 25), **options)
        for fk, n, value, until in inserts:
            table[fk, n] = (value, until)
        for fk, n, until in closings:
            table[fk, n] = (table[fk, n][0], until)
    plain = frame(spark, [(fk, n, value) for (fk, n), (value, _) in table.items()]).drop("pos")
    view = validity_view(plain, TEMPORAL, **options)
    expected = {
        (fk, at(n), value, MAX if until == "max" else at(until))
        for (fk, n), (value, until) in table.items()
    }
    assert {tuple(r) for r in view.collect()} == expected


@pytest.mark.parametrize("options", [{}, {"hot_rows": 2, "slice_millis": 4}], ids=["cold", "hot"])
def test_lookback_by_to_date(spark, options):
    """Same result as without, on a table whose to-dates are complete."""
    rng = random.Random(29)
    stored = frame(spark, random_stored(rng, 80, 6, 40)).drop("pos")
    table = validity_view(stored, TEMPORAL)
    late = [(fk, n + 15, v) for fk, n, v in random_records(rng, 90, 5, 30)]
    batch = frame(spark, late)

    def changes(**more):
        load = load_satellite(batch, table, TEMPORAL, order_by="pos", **more)
        return {tuple(r) for r in load.inserts.collect()}, {tuple(r) for r in load.closings.collect()}

    expected = changes()
    assert changes(lookback="to_date", **options) == expected
    assert expected[1]
    with pytest.raises(ValueError, match="lookback"):
        changes(lookback=True)
    plain = SatSpec(table="s", fk="fk", from_date="at", attributes=["value"])
    with pytest.raises(ValueError, match="no to-date"):
        load_satellite(batch, None, plain, lookback="to_date")


def test_invalid_rows(spark):
    rows = [(None, at(1), "A"), (1, None, "A"), (2, at(1), "A")]
    df = spark.createDataFrame(rows, "fk bigint, at timestamp_ntz, value string")
    with pytest.raises(Exception, match="sat: (fk|at) is NULL"):
        load_satellite(df, None, TEMPORAL).inserts.collect()
    load = load_satellite(df, None, TEMPORAL, on_invalid="reject")
    assert load.inserts.count() == 1
    assert load.rejects.count() == 2


def test_wrong_types_and_specs(spark):
    df = frame(spark, [(1, 1, "A")])
    with pytest.raises(ValueError, match="not integral"):
        load_satellite(df.withColumn("fk", F.lit("1")), None, TEMPORAL)
    with pytest.raises(ValueError, match="not a date"):
        load_satellite(df.withColumn("at", F.lit(1)), None, TEMPORAL)
    with pytest.raises(ValueError, match="not found in the input"):
        load_satellite(df.drop("value"), None, TEMPORAL)
    with pytest.raises(ValueError, match="not found in the target"):
        load_satellite(df, df.drop("pos"), TEMPORAL)
    narrow = load_satellite(df.withColumn("fk", F.lit(7)), None, TEMPORAL).inserts
    assert narrow.schema["fk"].dataType == T.LongType()
    for bad in (
        {"fk": ["a", "b"]},
        {"from_date": ["a", "b"]},
        {"first_run": "x"},
        {"to_date_col": "until", "max_flag": "4000-01-01"},
        {"attributes": ["value", "at"]},
    ):
        with pytest.raises(ValueError):
            SatSpec(**{"table": "s", "fk": "fk", "from_date": "at", "attributes": ["value"], **bad})
    with pytest.warns(UserWarning, match="no attributes"):
        assert SatSpec(table="s", fk="fk", from_date="at", attributes=[]).attributes == {}


@pytest.mark.parametrize("fanout", [2, 3])
def test_slices_meet_in_small_groups(spark, monkeypatch, fanout):
    """Hot parents with many slices, far apart: the tree of summaries gives what one window gives."""
    monkeypatch.setattr(satellite, "FANOUT", fanout)
    rng = random.Random(fanout)
    moments = sorted(rng.sample(range(1, 400), 45)) + [5000, 5001, 9000]
    records = [(fk, ms, rng.choice("AB")) for fk in (1, 2) for ms in moments if rng.random() < 0.8]
    stored = load_satellite(frame(spark, records[::3]), None, TEMPORAL).inserts
    batch = frame(spark, records)
    plain = load_satellite(batch, stored, TEMPORAL, hot_rows=None, with_dropped=True)
    sliced = load_satellite(batch, stored, TEMPORAL, hot_rows=2, slice_millis=2, with_dropped=True)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(sliced.inserts) == rows(plain.inserts) != []
    assert rows(sliced.closings) == rows(plain.closings) != []
    assert rows(sliced.dropped) == rows(plain.dropped) != []
    view = lambda **options: rows(validity_view(plain.inserts.drop("until"), TEMPORAL, **options))
    assert view(hot_rows=2, slice_millis=1) == view(hot_rows=None)


def test_no_window_holds_more_summaries_than_the_fanout(spark):
    """The neighbours of 5,000 slices of one parent, found in windows of at most seven."""
    value = F.struct(F.col("id").alias("v"))
    ends = spark.range(0, 40_000, 8).select(
        F.lit(1).cast("long").alias("__fk"), F.col("id").alias("__slice"), value.alias("__head"), value.alias("__tail")
    )
    found = {r["__slice"]: (r["__before"], r["__after"]) for r in satellite._neighbours(ends, 7).collect()}
    assert len(found) == 5000
    for at_, (before, after) in found.items():
        assert (before.v if before else None) == (at_ - 8 if at_ else None)
        assert (after.v if after else None) == (at_ + 8 if at_ < 39_992 else None)
    plan = satellite._neighbours(ends, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(__fk" in plan and "__group" in plan


def test_identities_that_were_handled_stay_out(spark):
    df = frame(spark, [(1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (2, 1, "A")])
    load = load_satellite(df, None, TEMPORAL, with_dropped=True)
    assert [(r.fk, r["at"]) for r in load.dropped.collect()] == [(1, at(1))]
    again = load_satellite(df, None, TEMPORAL, handled=load.dropped)
    assert {(r.fk, r["at"]) for r in again.inserts.collect()} == {(1, at(2)), (1, at(3)), (2, at(1))}
    assert load_satellite(df, None, TEMPORAL).dropped is None


def test_view_of_all_records_does_not_depend_on_batches(spark):
    """Records in any order and cut anyhow, stored as they are, against one idempotent load of them all."""
    rng = random.Random(31)
    as_is = SatSpec(table="s", fk="fk", from_date="at", attributes="value", idempotent=False)
    records = {(rng.randrange(5), rng.randrange(60)): rng.choice("AB") for _ in range(120)}
    records = [(fk, n, value) for (fk, n), value in records.items()]
    whole = load_satellite(frame(spark, records), None, TEMPORAL).inserts
    expected = sorted(map(repr, whole.collect()))
    for n in (1, 3, 7):
        table = stage(load_satellite(frame(spark, []), None, as_is).inserts, "table")
        for i in range(n):
            batch = frame(spark, records[i::n])
            table = stage(table.unionByName(load_satellite(batch, table, as_is).inserts), "table")
        assert sorted(map(repr, idempotent_view(table, TEMPORAL).collect())) == expected
        assert sorted(map(repr, idempotent_view(table, TEMPORAL, hot_rows=2, slice_millis=4).collect())) == expected
