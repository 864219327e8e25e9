"""Satellite queries over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vaultwright.operators import load_satellite, validity_view
from vaultwright.plans.into import load_into
from vaultwright.plans.queries_keys import SQL_BLANKED, blanked_orders
from vaultwright.plans.registry import earlier, later, query, read, sql_earlier, sql_later
from vaultwright.sources import CatalogTable, ParquetTable, SatelliteStore, stage
from vaultwright.staging import new_folder
from vaultwright.spec import SatSpec

STAMP = datetime(2024, 1, 1)
MAX_SQL = "TIMESTAMP '4000-01-01 00:00:00'"


def order_status(**options) -> SatSpec:
    """Status of a customer's orders over time."""
    return SatSpec(
        table="sat_order_status",
        fk={"o_custkey": "customer"},
        from_date={"o_orderdate": "valid_from"},
        attributes={"o_orderstatus": "status"},
        **options,
    )


# Several orders of a customer on one day: the lowest order number comes first.
FIRST = ["o_orderkey"]


def sql_timeline(
    batch: str, stored: str, *, idempotent: bool = True, first_run: str = "latest"
) -> str:
    """CTEs of a temporal load.  Both inputs give fk, d (from-date) and v (attribute);
    the batch also o (order) and m (meta).  The last CTE is ``t``: p (stored), nd and
    np (start and p of the next record).
    """
    first = "NOT next_eq" if first_run == "latest" else "NOT has_prev"
    kept = f"p OR (run > 1 AND NOT prev_eq) OR (run = 1 AND NOT run_stored AND {first})"
    return f"""
    batch AS ({batch}),
    stored AS ({stored}),
    n1 AS (SELECT fk, d, v, m FROM (
             SELECT *, row_number() OVER (PARTITION BY fk, date_trunc('milliseconds', d) ORDER BY o, d, v, m) AS rn
             FROM batch) WHERE rn = 1),
    u AS (SELECT fk, d, v, NULL AS m, true AS p FROM stored WHERE fk IN (SELECT fk FROM n1)
          UNION ALL
          SELECT fk, d, v, m, false FROM n1 WHERE NOT EXISTS (
            SELECT 1 FROM stored s WHERE s.fk = n1.fk AND date_trunc('milliseconds', s.d) = date_trunc('milliseconds', n1.d))),
    a AS (SELECT *, lag(d) OVER w IS NOT NULL AS has_prev,
                 lag(d) OVER w IS NOT NULL AND lag(v) OVER w IS NOT DISTINCT FROM v AS prev_eq,
                 lead(d) OVER w IS NOT NULL AND lead(v) OVER w IS NOT DISTINCT FROM v AS next_eq
          FROM u WINDOW w AS (PARTITION BY fk ORDER BY d)),
    b AS (SELECT *, sum(CASE WHEN prev_eq THEN 0 ELSE 1 END) OVER (
            PARTITION BY fk ORDER BY d ROWS UNBOUNDED PRECEDING) AS run FROM a),
    r AS (SELECT *, bool_or(p) OVER (PARTITION BY fk, run) AS run_stored FROM b),
    k AS (SELECT * FROM r WHERE {kept if idempotent else 'true'}),
    t AS (SELECT *, lead(d) OVER w AS nd, lead(p) OVER w AS np
          FROM k WINDOW w AS (PARTITION BY fk ORDER BY d))"""


def sql_status(condition: str = "true", value: str = "o_orderstatus") -> str:
    return f"""SELECT o_custkey AS fk, o_orderdate AS d, {value} AS v, o_orderkey AS o,
                      CAST(NULL AS BIGINT) AS m FROM orders WHERE {condition}"""


def sql_stored(batch: str, **options) -> str:
    """The records that a first load of ``batch`` leaves in an empty table."""
    nothing = "SELECT fk, d, v FROM batch WHERE false"
    return f"WITH {sql_timeline(batch, nothing, **options)} SELECT fk, d, v FROM t"


EARLIER, LATER = sql_earlier("o_orderdate"), sql_later("o_orderdate")
EMPTY = sql_status("false")
STORED_EARLIER = sql_stored(sql_status(EARLIER))
SELECT_INSERTS = "SELECT fk AS customer, d AS valid_from, v AS status FROM t WHERE NOT p"
SELECT_DATED = f"""SELECT fk AS customer, d AS valid_from, v AS status,
                          coalesce(nd, {MAX_SQL}) AS valid_to FROM t WHERE NOT p"""
SELECT_CLOSINGS = """SELECT fk AS customer, d AS valid_from, nd AS valid_to
                     FROM t WHERE p AND nd IS NOT NULL AND NOT np"""


def _orders(spark, sf_dir):
    return read(spark, sf_dir, "orders")


def _loaded_earlier(spark, sf_dir, spec):
    """A satellite that holds the orders before the split, and the new batch."""
    orders = _orders(spark, sf_dir)
    first = load_satellite(earlier(orders, "o_orderdate"), None, spec, order_by=FIRST)
    return stage(first.inserts, "sat"), later(orders, "o_orderdate")


# -- static ------------------------------------------------------------------


@query("SELECT c_custkey AS customer, c_name AS name, c_mktsegment AS segment FROM customer")
def sat_static(spark, sf_dir):
    spec = SatSpec(
        table="sat_customer",
        fk={"c_custkey": "customer"},
        attributes={"c_name": "name", "c_mktsegment": "segment"},
    )
    return load_satellite(read(spark, sf_dir, "customer"), None, spec).inserts


def _first_orders(condition: str) -> str:
    return f"""SELECT o_custkey AS customer, o_orderdate AS first_order, o_orderstatus AS status
               FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                       ORDER BY o_orderdate, o_orderkey) AS n FROM orders WHERE {condition})
               WHERE n = 1"""


@query(
    f"""WITH stored AS ({_first_orders("o_orderstatus = 'F' AND " + EARLIER)})
        SELECT * FROM ({_first_orders(f"NOT (o_orderstatus = 'F' AND {EARLIER})")})
        WHERE customer NOT IN (SELECT customer FROM stored)"""
)
def sat_static_incremental(spark, sf_dir):
    spec = SatSpec(
        table="sat_first_order",
        fk={"o_custkey": "customer"},
        attributes={"o_orderdate": "first_order", "o_orderstatus": "status"},
    )
    orders = _orders(spark, sf_dir)
    loaded = (F.col("o_orderstatus") == "F") & (
        F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    )
    first = ["o_orderdate", "o_orderkey"]
    stored = load_satellite(orders.filter(loaded), None, spec, order_by=first).inserts
    stored = stage(stored, "sat_first_order")
    return load_satellite(orders.filter(~loaded), stored, spec, order_by=first).inserts


# -- temporal ----------------------------------------------------------------


@query(f"WITH {sql_timeline(sql_status(), EMPTY, idempotent=False)} {SELECT_INSERTS}")
def sat_asis(spark, sf_dir):
    spec = order_status(idempotent=False)
    return load_satellite(_orders(spark, sf_dir), None, spec, order_by=FIRST).inserts


SQL_BY_STATUS = sql_timeline(
    sql_status("o_orderstatus <> 'O'"),
    sql_stored(sql_status("o_orderstatus = 'O'"), idempotent=False),
    idempotent=False,
)


@query(f"WITH {SQL_BY_STATUS} {SELECT_INSERTS}")
def sat_asis_incremental(spark, sf_dir):
    spec = order_status(idempotent=False)
    orders = _orders(spark, sf_dir)
    stored = orders.filter("o_orderstatus = 'O'")
    stored = stage(load_satellite(stored, None, spec, order_by=FIRST).inserts, "sat")
    batch = orders.filter("o_orderstatus <> 'O'")
    return load_satellite(batch, stored, spec, order_by=FIRST).inserts


@query(f"WITH {SQL_BY_STATUS} {SELECT_DATED}")
def sat_asis_todate(spark, sf_dir):
    spec = order_status(idempotent=False, to_date_col="valid_to")
    orders = _orders(spark, sf_dir)
    stored = orders.filter("o_orderstatus = 'O'")
    stored = stage(load_satellite(stored, None, spec, order_by=FIRST).inserts, "sat")
    batch = orders.filter("o_orderstatus <> 'O'")
    return load_satellite(batch, stored, spec, order_by=FIRST).inserts


@query(f"WITH {sql_timeline(sql_status(), EMPTY)} {SELECT_INSERTS}")
def sat_idempotent_initial(spark, sf_dir):
    return load_satellite(_orders(spark, sf_dir), None, order_status(), order_by=FIRST).inserts


SQL_INCREMENTAL = sql_timeline(sql_status(LATER), STORED_EARLIER)


@query(f"WITH {SQL_INCREMENTAL} {SELECT_INSERTS}")
def sat_idempotent_incremental(spark, sf_dir):
    stored, batch = _loaded_earlier(spark, sf_dir, order_status())
    return load_satellite(batch, stored, order_status(), order_by=FIRST).inserts


@query(f"WITH {SQL_INCREMENTAL} {SELECT_INSERTS}")
def sat_lookback(spark, sf_dir):
    stored, batch = _loaded_earlier(spark, sf_dir, order_status())
    load = load_satellite(
        batch, stored, order_status(), order_by=FIRST, lookback="from_date"
    )
    return load.inserts


@query(f"WITH {SQL_INCREMENTAL} {SELECT_DATED}")
def sat_parents_shuffled(spark, sf_dir):
    """As with a parent set too large to broadcast: the stored records are semi-joined in a shuffle."""
    spec = order_status(to_date_col="valid_to")
    stored, batch = _loaded_earlier(spark, sf_dir, spec)
    return load_satellite(
        batch, stored, spec, order_by=FIRST, lookback="from_date", broadcast_bytes=0
    ).inserts


@query(
    f"""WITH {sql_timeline(sql_status('o_custkey % 10 = 3 AND ' + LATER), STORED_EARLIER)} {SELECT_INSERTS}"""
)
def sat_few_parents_shuffled(spark, sf_dir):
    """A batch with a tenth of the customers."""
    stored, batch = _loaded_earlier(spark, sf_dir, order_status())
    few = batch.filter("o_custkey % 10 = 3")
    return load_satellite(few, stored, order_status(), order_by=FIRST, broadcast_bytes=0).inserts


@query(f"WITH {SQL_INCREMENTAL} {SELECT_INSERTS} UNION ALL SELECT fk, d, v FROM stored")
def sat_colocated(spark, sf_dir):
    """A satellite bucketed by its foreign key: only the batch, taken as too large to broadcast, is shuffled."""
    folder = new_folder(spark, "sat_order_status")
    name = f"sat_order_status_{folder.rsplit('-', 1)[1]}"
    target = CatalogTable(spark, name, ("customer",), buckets=8, path=folder)
    orders = _orders(spark, sf_dir)
    for batch in (earlier(orders, "o_orderdate"), later(orders, "o_orderdate")):
        load_into(target, batch, order_status(), order_by=FIRST, broadcast_bytes=0)
    return target.read()


@query(f"WITH {SQL_INCREMENTAL} {SELECT_INSERTS}")
def sat_to_date_not_used(spark, sf_dir):
    """The to-date column named as not used."""
    spec = order_status(to_date_col="n.a.")
    stored, batch = _loaded_earlier(spark, sf_dir, spec)
    return load_satellite(batch, stored, spec, order_by=FIRST).inserts


@query(
    """SELECT o_custkey AS customer, o_orderdate AS valid_from,
              coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate),
                       TIMESTAMP '9999-12-31 00:00:00') AS valid_to
       FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)"""
)
def sat_without_attributes(spark, sf_dir):
    """An effectivity satellite: only customers and dates; another max flag; two loads into a store."""
    spec = SatSpec(
        table="sat_active",
        fk={"o_custkey": "customer"},
        from_date={"o_orderdate": "valid_from"},
        idempotent=False,
        to_date_col="valid_to",
        max_flag="31-12-9999",
    )
    orders = read(spark, sf_dir, "orders")
    store = SatelliteStore(spark, new_folder(spark, "sat_active"), spec, buckets=8)
    for part in (earlier(orders, "o_orderdate"), later(orders, "o_orderdate")):
        load_into(store, part, spec)
    return store.read()


@query(f"WITH {SQL_INCREMENTAL} {SELECT_DATED}")
def sat_lookback_todate(spark, sf_dir):
    spec = order_status(to_date_col="valid_to")
    stored, batch = _loaded_earlier(spark, sf_dir, spec)
    return load_satellite(batch, stored, spec, order_by=FIRST, lookback="to_date").inserts


SQL_EVENTS = """SELECT user_id AS fk, ts AS d, event_type AS v, event_id AS o,
                       CAST(NULL AS BIGINT) AS m FROM events"""


def user_events(**options) -> SatSpec:
    return SatSpec(
        table="sat_user_event",
        fk={"user_id": "user"},
        from_date={"ts": "valid_from"},
        attributes={"event_type": "event"},
        **options,
    )


@query(
    f"""WITH {sql_timeline(SQL_EVENTS, SQL_EVENTS + ' WHERE false')}
        SELECT fk AS "user", d AS valid_from, v AS event,
               coalesce(nd, {MAX_SQL}) AS valid_to FROM t WHERE NOT p"""
)
def sat_events(spark, sf_dir):
    spec = user_events(to_date_col="valid_to")
    events = read(spark, sf_dir, "events")
    return load_satellite(events, None, spec, order_by="event_id").inserts


@query(
    f"""WITH {sql_timeline(SQL_EVENTS, SQL_EVENTS + ' WHERE false')}
        SELECT fk AS "user", d AS valid_from, v AS event,
               coalesce(nd, {MAX_SQL}) AS valid_to FROM t WHERE NOT p"""
)
def sat_hot_parents(spark, sf_dir):
    """Every user counts as hot, and timelines are cut into days."""
    spec = user_events(to_date_col="valid_to")
    events = read(spark, sf_dir, "events")
    return load_satellite(
        events, None, spec, order_by="event_id", hot_rows=10, slice_millis=86_400_000
    ).inserts


EVEN = "date_part('year', o_orderdate) IN (1994, 1996, 1998, 2000, 2002)"
ODD = f"NOT ({EVEN})"
SQL_OUT_OF_ORDER = sql_timeline(sql_status(ODD), sql_stored(sql_status(EVEN)))


def _out_of_order(spark, sf_dir, spec, **options):
    """Even years are stored; odd years arrive before, between and after them."""
    orders = _orders(spark, sf_dir)
    even = F.year("o_orderdate") % 2 == 0
    stored = load_satellite(orders.filter(even), None, spec, order_by=FIRST).inserts
    batch = orders.filter(~even)
    return load_satellite(batch, stage(stored, "sat"), spec, order_by=FIRST, **options)


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_INSERTS}")
def sat_out_of_order(spark, sf_dir):
    return _out_of_order(spark, sf_dir, order_status()).inserts


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_DATED}")
def sat_todate_inserts(spark, sf_dir):
    return _out_of_order(spark, sf_dir, order_status(to_date_col="valid_to")).inserts


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_CLOSINGS}")
def sat_todate_closings(spark, sf_dir):
    return _out_of_order(spark, sf_dir, order_status(to_date_col="valid_to")).closings


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_CLOSINGS}")
def sat_todate_closings_hot(spark, sf_dir):
    spec = order_status(to_date_col="valid_to")
    month = 30 * 86_400_000
    return _out_of_order(spark, sf_dir, spec, hot_rows=5, slice_millis=month).closings


@query(
    f"""WITH {sql_timeline(sql_status(LATER), STORED_EARLIER)} {SELECT_CLOSINGS}"""
)
def sat_todate_closings_in_order(spark, sf_dir):
    spec = order_status(to_date_col="valid_to")
    stored, batch = _loaded_earlier(spark, sf_dir, spec)
    return load_satellite(batch, stored, spec, order_by=FIRST).closings


SELECT_TABLE = f"""
    , whole AS (SELECT fk, d, v FROM stored
                UNION ALL SELECT fk, d, v FROM t WHERE NOT p)
    SELECT fk AS customer, d AS valid_from, v AS status,
           coalesce(lead(d) OVER (PARTITION BY fk ORDER BY d), {MAX_SQL}) AS valid_to
    FROM whole"""


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_TABLE}")
def sat_todate_virtual(spark, sf_dir):
    """To-dates worked out while reading a table that stores none."""
    spec = order_status()
    orders = _orders(spark, sf_dir)
    even = F.year("o_orderdate") % 2 == 0
    stored = load_satellite(orders.filter(even), None, spec, order_by=FIRST).inserts
    stored = stage(stored, "sat")
    added = load_satellite(orders.filter(~even), stored, spec, order_by=FIRST).inserts
    return validity_view(stored.unionByName(added), order_status(to_date_col="valid_to"))


def _two_loads(spark, sf_dir) -> SatelliteStore:
    """Orders of even years, then those of odd years, which come late and close stored records."""
    spec = order_status(to_date_col="valid_to")
    store = SatelliteStore(spark, new_folder(spark, "sat_order_status"), spec, buckets=8)
    orders = _orders(spark, sf_dir)
    even = F.year("o_orderdate") % 2 == 0
    for load_id, batch in (("even", orders.filter(even)), ("odd", orders.filter(~even))):
        load_into(store, batch, spec, load_id=load_id, order_by=FIRST)
    return store


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_TABLE}")
def sat_todate_materialized(spark, sf_dir):
    """Two loads into a table that stores to-dates, the late closings merged while reading."""
    return _two_loads(spark, sf_dir).read()


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_TABLE}")
def sat_todate_compacted(spark, sf_dir):
    """The same table after its closings were folded in."""
    store = _two_loads(spark, sf_dir)
    store.compact()
    return store.read()


@query(f"WITH {SQL_OUT_OF_ORDER} {SELECT_TABLE}")
def sat_replay_any(spark, sf_dir):
    """Even years, odd years, then even years again under another name: records dropped the first time stay dropped."""
    spec = order_status(to_date_col="valid_to")
    store = SatelliteStore(spark, new_folder(spark, "sat_order_status"), spec, buckets=8, remember_dropped=True)
    orders = _orders(spark, sf_dir)
    even = F.year("o_orderdate") % 2 == 0
    for batch in (orders.filter(even), orders.filter(~even), orders.filter(even)):
        load_into(store, batch, spec, order_by=FIRST)
    return store.read()


@query(
    f"""WITH {SQL_OUT_OF_ORDER},
        added AS (SELECT fk, d FROM t WHERE NOT p),
        whole AS (SELECT fk, d, true AS old FROM stored UNION ALL SELECT fk, d, false FROM added),
        steps AS (SELECT old, lead(old) OVER (PARTITION BY fk ORDER BY d) AS next_old FROM whole)
        SELECT 'even' AS load_id, (SELECT count(*) FROM stored) AS inserted, CAST(0 AS BIGINT) AS updated,
               (SELECT count(*) FROM stored) AS rows_written
        UNION ALL
        SELECT 'odd', (SELECT count(*) FROM added), (SELECT count(*) FROM steps WHERE old AND NOT next_old),
               (SELECT count(*) FROM added) + (SELECT count(*) FROM steps WHERE old AND NOT next_old)"""
)
def sat_todate_load_sizes(spark, sf_dir):
    """What each load counted and what it wrote: a late load writes its records and closings, no more."""
    store = _two_loads(spark, sf_dir)
    written = None
    for load in store.loads():
        counted = spark.read.parquet(load.path).agg(
            F.lit(load.load_id).alias("load_id"),
            F.lit(load.inserted).cast("long").alias("inserted"),
            F.lit(load.closed).cast("long").alias("updated"),
            F.count("*").alias("rows_written"),
        )
        written = counted if written is None else written.unionAll(counted)
    return written


@query(f"WITH {sql_timeline(sql_status(), EMPTY)} {SELECT_DATED}")
def sat_first_run_latest(spark, sf_dir):
    spec = order_status(to_date_col="valid_to")
    return load_satellite(_orders(spark, sf_dir), None, spec, order_by=FIRST).inserts


@query(f"WITH {sql_timeline(sql_status(), EMPTY, first_run='earliest')} {SELECT_DATED}")
def sat_first_run_earliest(spark, sf_dir):
    spec = order_status(to_date_col="valid_to", first_run="earliest")
    return load_satellite(_orders(spark, sf_dir), None, spec, order_by=FIRST).inserts


SQL_PRIORITY = """CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                       ELSE o_orderpriority END"""


@query(f"WITH {sql_timeline(sql_status('true', SQL_PRIORITY), EMPTY)} {SELECT_INSERTS}")
def sat_empty_as_null(spark, sf_dir):
    """One priority arrives as '' and one as NULL; both are the same value."""
    priority = F.col("o_orderpriority")
    value = F.when(priority == "5-LOW", F.lit("")).when(priority != "4-NOT SPECIFIED", priority)
    orders = _orders(spark, sf_dir).withColumn("o_orderstatus", value)
    return load_satellite(orders, None, order_status(), order_by=FIRST).inserts


SQL_META = sql_status(LATER).replace("CAST(NULL AS BIGINT) AS m", "o_orderkey AS m")


@query(
    f"""WITH {sql_timeline(SQL_META, STORED_EARLIER)}
        SELECT fk AS customer, d AS valid_from, v AS status, m AS source_order,
               TIMESTAMP '2024-01-01 00:00:00' AS load_dts, 'shop' AS rec_src
        FROM t WHERE NOT p"""
)
def sat_meta_attributes(spark, sf_dir):
    stored, batch = _loaded_earlier(spark, sf_dir, order_status())
    spec = order_status(
        meta={"o_orderkey": "source_order"},
        load_dts_col="load_dts",
        rec_src_col="rec_src",
        rec_src="shop",
        types={"load_dts": "timestamp_ntz"},
    )
    missing = ("source_order", "load_dts", "rec_src")
    types = ("bigint", "timestamp_ntz", "string")
    stored = stored.withColumns({c: F.lit(None).cast(t) for c, t in zip(missing, types)})
    return load_satellite(batch, stored, spec, order_by=FIRST, load_ts=STAMP).inserts


SQL_CLOSE_EVENTS = """SELECT user_id AS fk,
        date_trunc('hour', ts) + to_microseconds(event_id % 1000) AS d,
        event_type AS v, event_id AS o, CAST(NULL AS BIGINT) AS m FROM events"""


@query(
    f"""WITH {sql_timeline(SQL_CLOSE_EVENTS, SQL_CLOSE_EVENTS + ' WHERE false', idempotent=False)}
        SELECT fk AS "user", d AS valid_from, v AS event FROM t WHERE NOT p"""
)
def sat_millisecond_identity(spark, sf_dir):
    """All events of a user and hour fall into one millisecond, so the first wins."""
    hour = F.date_trunc("HOUR", "ts").cast("timestamp_ntz")
    micros = F.make_dt_interval(secs=(F.col("event_id") % 1000).cast("decimal(18,6)") / 1_000_000)
    events = read(spark, sf_dir, "events").withColumn("ts", hour + micros)
    spec = user_events(idempotent=False)
    return load_satellite(events, None, spec, order_by="event_id").inserts


@query(f"WITH {SQL_INCREMENTAL} {SELECT_INSERTS} UNION ALL SELECT fk, d, v FROM stored")
def sat_replay(spark, sf_dir):
    """The table after the same batch was loaded twice: the second time inserts nothing."""
    spec = order_status()
    target = ParquetTable(spark, new_folder(spark, "sat"))
    stored, batch = _loaded_earlier(spark, sf_dir, spec)
    target.append(stored)
    for _ in range(2):
        load_into(target, batch, spec, order_by=FIRST)
    return target.read()


BLANKED_SAT = SatSpec(
    table="sat_p", fk={"customer": "customer"}, from_date="since", attributes=["priority"]
)


@query(f"SELECT * FROM ({SQL_BLANKED}) WHERE customer IS NULL OR since IS NULL")
def sat_rejects(spark, sf_dir):
    orders = blanked_orders(spark, sf_dir)
    return load_satellite(orders, None, BLANKED_SAT, on_invalid="reject").rejects


@query("SELECT * FROM orders")
def sat_output(spark, sf_dir):
    """A satellite load passes its input through, also when it has been written."""
    target = ParquetTable(spark, new_folder(spark, "sat"))
    return load_into(target, _orders(spark, sf_dir), order_status(), order_by=FIRST).output
