"""Chained loads, quality reports, writes and streams over the test tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from vaultwright.operators import idempotent_view, load_hub, quality
from vaultwright.plans.chain import load_chain
from vaultwright.plans.into import load_into
from vaultwright.plans.queries_history import (
    FIRST,
    MAX_SQL,
    SQL_EVENTS,
    order_status,
    sql_timeline,
    user_events,
)
from vaultwright.plans.queries_keys import (
    CUSTOMER_HUB,
    LINE_HUB,
    PRIORITY_HUB,
    SQL_BLANKED,
    blanked_orders,
)
from vaultwright.plans.registry import earlier, later, query, read, sql_earlier, sql_later, sql_rank
from vaultwright.sources import ParquetTable, SatelliteStore, stage
from vaultwright.staging import new_folder
from vaultwright.spec import HubSpec, LinkSpec, SatSpec
from vaultwright.streaming import load_chain_stream, load_stream

ORDER_HUB = HubSpec(table="hub_order", tech_key="order_id", keys={"o_orderkey": "orderkey"})
CUSTOMER_ORDER = LinkSpec(
    table="link_customer_order",
    tech_key="customer_order_id",
    keys=["customer_id", "order_id"],
)
ORDER_DETAILS = SatSpec(
    table="sat_order",
    fk={"customer_order_id": "customer_order"},
    from_date={"o_orderdate": "valid_from"},
    attributes={"o_orderstatus": "status", "o_totalprice": "total"},
)
CUSTOMER_STATUS = SatSpec(
    table="sat_customer_status",
    fk={"customer_id": "customer"},
    from_date={"o_orderdate": "valid_from"},
    attributes={"o_orderstatus": "status", "o_orderpriority": "priority"},
    to_date_col="valid_to",
)
CHAIN = [CUSTOMER_HUB, ORDER_HUB, CUSTOMER_ORDER, ORDER_DETAILS, CUSTOMER_STATUS]

SQL_CHAIN = f"""
    customers AS (SELECT o_custkey AS ck, {sql_rank('o_custkey')} AS customer_id
                  FROM (SELECT DISTINCT o_custkey FROM orders)),
    order_keys AS (SELECT o_orderkey AS ok, {sql_rank('o_orderkey')} AS order_id
                   FROM (SELECT DISTINCT o_orderkey FROM orders)),
    keyed AS (SELECT orders.*, customer_id, order_id FROM orders
              JOIN customers ON ck = o_custkey JOIN order_keys ON ok = o_orderkey),
    links AS (SELECT customer_id AS c, order_id AS o,
                     {sql_rank('customer_id', 'order_id')} AS customer_order_id
              FROM (SELECT DISTINCT customer_id, order_id FROM keyed))"""


def run_chain(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return load_chain(orders, CHAIN, {}, order_by=FIRST)


@query(
    f"""WITH {SQL_CHAIN}, {sql_timeline(
        "SELECT customer_id AS fk, o_orderdate AS d, (o_orderstatus, o_orderpriority) AS v, "
        "o_orderkey AS o, CAST(NULL AS BIGINT) AS m FROM keyed",
        "SELECT fk, d, v FROM batch WHERE false")}
    SELECT fk AS customer, d AS valid_from, v[1] AS status, v[2] AS priority,
           coalesce(nd, {MAX_SQL}) AS valid_to FROM t WHERE NOT p"""
)
def vault_chain(spark, sf_dir):
    """Two hubs, a link and two satellites in one flow; the history of each customer."""
    return run_chain(spark, sf_dir).loads["sat_customer_status"].inserts


@query(
    f"""WITH {SQL_CHAIN}
        SELECT customer_order_id AS customer_order, o_orderdate AS valid_from,
               o_orderstatus AS status, o_totalprice AS total
        FROM keyed JOIN links ON c = customer_id AND o = order_id"""
)
def vault_chain_link_satellite(spark, sf_dir):
    return run_chain(spark, sf_dir).loads["sat_order"].inserts


@query(
    f"""WITH {SQL_CHAIN}
        SELECT keyed.*, customer_order_id
        FROM keyed JOIN links ON c = customer_id AND o = order_id"""
)
def vault_chain_output(spark, sf_dir):
    return run_chain(spark, sf_dir).output


# -- writes --------------------------------------------------------------------


SQL_LOADED_HUB = f"""
    old AS (SELECT o_custkey AS custkey, {sql_rank('o_custkey')} AS customer_id
            FROM (SELECT DISTINCT o_custkey FROM orders WHERE {sql_earlier('o_orderdate')})),
    new AS (SELECT o_custkey AS custkey,
                   (SELECT max(customer_id) FROM old) + {sql_rank('o_custkey')} AS customer_id
            FROM (SELECT DISTINCT o_custkey FROM orders
                  WHERE {sql_later('o_orderdate')}
                    AND o_custkey NOT IN (SELECT custkey FROM old))),
    hub AS (SELECT * FROM old UNION ALL SELECT * FROM new)"""


def _loaded_hub(spark, sf_dir):
    """A hub table written by two loads, and the output of the second."""
    target = ParquetTable(spark, new_folder(spark, "hub_customer"))
    orders = read(spark, sf_dir, "orders")
    load_into(target, earlier(orders, "o_orderdate"), CUSTOMER_HUB, verify=True)
    second = load_into(target, later(orders, "o_orderdate"), CUSTOMER_HUB, verify=True)
    return target.read(), second.output


@query(f"WITH {SQL_LOADED_HUB} SELECT * FROM hub")
def write_hub(spark, sf_dir):
    return _loaded_hub(spark, sf_dir)[0]


@query(
    f"""WITH {SQL_LOADED_HUB}
        SELECT orders.*, customer_id FROM orders JOIN hub ON custkey = o_custkey
        WHERE {sql_later('o_orderdate')}"""
)
def write_hub_output(spark, sf_dir):
    return _loaded_hub(spark, sf_dir)[1]


@query(
    f"""WITH {SQL_LOADED_HUB}
        SELECT (SELECT count(*) FROM new) AS inserted, 0 AS updated,
               (SELECT count(*) FROM orders WHERE {sql_later('o_orderdate')}) AS rows_in,
               (SELECT count(*) FROM orders JOIN hub ON custkey = o_custkey
                WHERE {sql_later('o_orderdate')}) AS rows_out"""
)
def load_metrics(spark, sf_dir):
    """What the second load of the hub reports, and the rows that came out of it."""
    target = ParquetTable(spark, new_folder(spark, "hub_customer"))
    orders = read(spark, sf_dir, "orders")
    load_into(target, earlier(orders, "o_orderdate"), CUSTOMER_HUB)
    second = load_into(target, later(orders, "o_orderdate"), CUSTOMER_HUB)
    counted = {c: F.lit(second.metrics[m]).cast("bigint") for c, m in
               (("inserted", "inserted"), ("updated", "updated"), ("rows_in", "rows"))}
    rows_out = second.output.agg(F.count(F.lit(1)).alias("rows_out"))
    return rows_out.select(*[value.alias(c) for c, value in counted.items()], "rows_out")


@query(
    f"""WITH {SQL_LOADED_HUB}
        SELECT (SELECT count(*) FROM orders WHERE {sql_later('o_orderdate')}) AS rows_in,
               (SELECT count(*) FROM orders JOIN hub ON custkey = o_custkey
                WHERE {sql_later('o_orderdate')}) AS rows_out, true AS all_consumed,
               (SELECT count(*) FROM new) AS inserted, (SELECT count(*) FROM hub) AS stored, true AS sketch_agrees"""
)
def load_fingerprints(spark, sf_dir):
    """The second load of the hub by fingerprints: all rows came out, and the sketch of keys is near the rows stored."""
    target = ParquetTable(spark, new_folder(spark, "hub_customer"))
    orders = read(spark, sf_dir, "orders")
    load_into(target, earlier(orders, "o_orderdate"), CUSTOMER_HUB)
    batch, old = later(orders, "o_orderdate"), stage(target.read(), "before")
    second = load_into(target, batch, CUSTOMER_HUB, verify=True)
    inserts = target.read().join(old, "custkey", "left_anti")
    report = quality.load_report(batch, second.output, inserts, target.read(), CUSTOMER_HUB)
    agrees = F.abs(F.col("approx_keys") - F.col("stored")) <= 0.05 * F.col("stored") + 1
    return report.withColumn("sketch_agrees", agrees).drop("approx_keys")


# -- quality -------------------------------------------------------------------


@query(
    """SELECT l_orderkey AS orderkey, l_linenumber AS line, count(*) AS n_rows
       FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
)
def dq_hub_duplicates(spark, sf_dir):
    """Lines taken as a hub as they are: order and line number repeat."""
    lines = read(spark, sf_dir, "lineitem")
    hub = lines.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"))
    return quality.duplicate_keys(hub, LINE_HUB)


@query(
    """SELECT o_custkey AS customer, epoch_ms(o_orderdate) AS valid_from_millis,
              count(*) AS n_rows
       FROM orders GROUP BY ALL HAVING count(*) > 1"""
)
def dq_sat_duplicates(spark, sf_dir):
    """Orders taken as a satellite as they are: some customers order twice a day."""
    orders = read(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_custkey": "customer", "o_orderdate": "valid_from", "o_orderstatus": "status"}
    )
    return quality.duplicate_records(orders, order_status())


@query(
    f"""SELECT l_orderkey AS orderkey, l_linenumber AS line, count(*) AS n_rows FROM lineitem
        WHERE {sql_later('l_shipdate')} AND (l_orderkey, l_linenumber) NOT IN (
          SELECT l_orderkey, l_linenumber FROM lineitem WHERE {sql_earlier('l_shipdate')})
        GROUP BY ALL"""
)
def dq_unresolved_keys(spark, sf_dir):
    """Lines of a batch that has not been loaded."""
    lines = read(spark, sf_dir, "lineitem")
    hub = stage(load_hub(earlier(lines, "l_shipdate"), None, LINE_HUB).inserts, "hub_line")
    return quality.unresolved_keys(later(lines, "l_shipdate"), hub, LINE_HUB)


@query(
    """SELECT o_custkey, count(*) AS n_rows FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
       GROUP BY ALL"""
)
def dq_orphans(spark, sf_dir):
    """Orders of customers that a hub without one market segment does not hold."""
    parents = read(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    return quality.orphans(read(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey")


@query(
    f"""SELECT *, concat_ws('; ',
               CASE WHEN customer IS NULL THEN 'customer is NULL' END,
               CASE WHEN priority IS NULL THEN 'priority is NULL'
                    WHEN priority = '' THEN 'priority is empty' END) AS reason
        FROM ({SQL_BLANKED})
        WHERE customer IS NULL OR priority IS NULL OR priority = ''"""
)
def dq_invalid_keys(spark, sf_dir):
    return quality.invalid_rows(blanked_orders(spark, sf_dir), PRIORITY_HUB)


# -- streams -------------------------------------------------------------------


USER_HUB = HubSpec(table="hub_user", tech_key="user_key", keys={"user_id": "user"})


def _stream_into(spark, sf_dir, name, spec, **options):
    schema = read(spark, sf_dir, "events").schema
    # A pattern, since a plain path of a stream must be a folder.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.[p]arquet")
    target = ParquetTable(spark, new_folder(spark, name))
    checkpoint = new_folder(spark, f"{name}-progress")
    load_stream(events, target, spec, checkpoint=checkpoint, **options).awaitTermination()
    return target.read()


@query(
    f"""SELECT user_id AS "user", {sql_rank('user_id')} AS user_key
        FROM (SELECT DISTINCT user_id FROM events)"""
)
def stream_hub(spark, sf_dir):
    return _stream_into(spark, sf_dir, "hub_user", USER_HUB)


def _in_batches(spark, table, parts):
    """A stream of ``parts`` (conditions on the rows), one micro-batch each, in that order."""
    files = new_folder(spark, "stream")
    # Each part is written and read by several tasks; a trigger takes up all files of a part.
    least = min(table.agg(*[F.count_if(F.expr(part)) for part in parts]).first())
    n_files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), least))
    for n, part in enumerate(parts, 1):
        table.filter(part).repartition(n_files).write.mode("append").parquet(files)
        written = len(spark.read.schema(table.schema).parquet(files).inputFiles())
        if written != n * n_files:
            raise RuntimeError(f"{written} files, {n * n_files} are expected")
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", n_files).parquet(files)


def _stream_in_batches(spark, sf_dir, target, spec, parts, **options):
    stream = _in_batches(spark, read(spark, sf_dir, "events"), parts)
    checkpoint = new_folder(spark, "progress")
    load_stream(stream, target, spec, checkpoint=checkpoint, **options).awaitTermination()
    return target.read()


# The users of even events come first; those of odd events follow.
EVEN, ODD = "event_id % 2 = 0 AND user_id % 3 > 0", "NOT (event_id % 2 = 0 AND user_id % 3 > 0)"


@query(
    f"""WITH old AS (SELECT DISTINCT user_id AS k FROM events WHERE {EVEN}),
        new AS (SELECT DISTINCT user_id AS k FROM events WHERE user_id NOT IN (SELECT k FROM old))
        SELECT k AS "user", {sql_rank('k')} AS user_key FROM old
        UNION ALL SELECT k, (SELECT count(*) FROM old) + {sql_rank('k')} FROM new"""
)
def stream_hub_batches(spark, sf_dir):
    target = ParquetTable(spark, new_folder(spark, "hub_user"))
    return _stream_in_batches(spark, sf_dir, target, USER_HUB, [EVEN, ODD])


@query(
    f"""SELECT user_id AS "user", ts AS valid_from, event_type AS event,
               coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), {MAX_SQL}) AS valid_to
        FROM events"""
)
def stream_sat_late(spark, sf_dir):
    """Three micro-batches into a store; the last holds records between the stored ones."""
    spec = user_events(idempotent=False, to_date_col="valid_to")
    store = SatelliteStore(spark, new_folder(spark, "sat_user"), spec, buckets=4)
    parts = [f"event_id % 3 = {n}" for n in (0, 2, 1)]
    return _stream_in_batches(spark, sf_dir, store, spec, parts, order_by="event_id")


CUTS = (1, 3, 7)


@query(
    f"""WITH {sql_timeline(SQL_EVENTS, SQL_EVENTS + ' WHERE false')},
        cuts(n_batches) AS (VALUES {', '.join(f'({n})' for n in CUTS)})
        SELECT n_batches, fk AS "user", d AS valid_from, v AS event, coalesce(nd, {MAX_SQL}) AS valid_to
        FROM t, cuts WHERE NOT p"""
)
def stream_sat_uncut(spark, sf_dir):
    """The idempotent history of users, loaded as one, three and seven micro-batches: always the same."""
    as_is, spec = user_events(idempotent=False), user_events(to_date_col="valid_to")
    first, last = read(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    found = None
    for n in CUTS:
        bounds = [first + (last + 1 - first) * i // n for i in range(n + 1)]
        parts = [f"event_id >= {a} AND event_id < {b}" for a, b in zip(bounds, bounds[1:])]
        target = ParquetTable(spark, new_folder(spark, "sat_user"))
        table = _stream_in_batches(spark, sf_dir, target, as_is, parts, order_by="event_id")
        view = idempotent_view(table, spec).select(F.lit(n).alias("n_batches"), "*")
        found = view if found is None else found.unionByName(view)
    return found


@query(
    f"""WITH {sql_timeline(SQL_EVENTS, SQL_EVENTS + ' WHERE false', idempotent=False)}
        SELECT fk AS "user", d AS valid_from, v AS event FROM t WHERE NOT p"""
)
def stream_sat(spark, sf_dir):
    spec = user_events(idempotent=False)
    return _stream_into(spark, sf_dir, "sat_user", spec, order_by="event_id")


STREAM_PARTS = [f"o_orderkey % 3 = {n}" for n in range(3)]
STATUS_AS_IS = replace(CUSTOMER_STATUS, idempotent=False)


@query(
    f"""WITH first AS (SELECT o_custkey AS c, o_orderdate AS d, arg_min(o_orderstatus, (o_orderkey % 3, o_orderkey)) AS status
                      FROM orders GROUP BY ALL),
        dated AS (SELECT *, coalesce(lead(d) OVER (PARTITION BY c ORDER BY d), {MAX_SQL}) AS valid_to FROM first)
        SELECT o_custkey AS custkey, o_orderkey AS orderkey, o_orderdate AS valid_from, o_orderstatus AS status,
               o_totalprice AS total, dated.status AS customer_status, valid_to
        FROM orders JOIN dated ON c = o_custkey AND d = o_orderdate"""
)
def stream_chain(spark, sf_dir):
    """Two hubs, a link and two satellites fed by one stream of three micro-batches, put together again."""
    orders = read(spark, sf_dir, "orders")
    specs = [CUSTOMER_HUB, ORDER_HUB, CUSTOMER_ORDER, ORDER_DETAILS, STATUS_AS_IS]
    targets = {spec.table: ParquetTable(spark, new_folder(spark, spec.table)) for spec in specs[:-1]}
    store = SatelliteStore(spark, new_folder(spark, STATUS_AS_IS.table), STATUS_AS_IS, buckets=8)
    load_chain_stream(
        _in_batches(spark, orders, STREAM_PARTS),
        specs,
        {**targets, STATUS_AS_IS.table: store},
        checkpoint=new_folder(spark, "progress"),
        options={STATUS_AS_IS.table: {"order_by": FIRST}},
    ).awaitTermination()
    customers, order_keys, links, details = (targets[spec.table].read() for spec in specs[:-1])
    status = store.read().withColumnsRenamed({"customer": "customer_id", "status": "customer_status"})
    return (
        details.join(links, F.col("customer_order") == F.col("customer_order_id"))
        .join(customers, "customer_id")
        .join(order_keys, "order_id")
        .join(status.drop("priority"), ["customer_id", "valid_from"])
        .select("custkey", "orderkey", "valid_from", "status", "total", "customer_status", "valid_to")
    )
