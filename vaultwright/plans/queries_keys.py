"""Hub, link and technical key queries over the test tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from vaultwright.operators import load_hub, load_link
from vaultwright.plans.into import load_into
from vaultwright.plans.registry import (
    earlier,
    later,
    query,
    read,
    sql_digest,
    sql_earlier,
    sql_later,
    sql_rank,
)
from vaultwright.sources import CatalogTable, ParquetTable, Sequence, stage
from vaultwright.staging import new_folder
from vaultwright.spec import AUTO_INCREMENT, BY_KEY, SEQUENCE, HubSpec, LinkSpec

STAMP = datetime(2024, 1, 1)

CUSTOMER_HUB = HubSpec(
    table="hub_customer", tech_key="customer_id", keys={"o_custkey": "custkey"}
)
PART_HUB = HubSpec(table="hub_part", tech_key="part_id", keys={"l_partkey": "partkey"})
SUPPLIER_HUB = HubSpec(table="hub_supplier", tech_key="supplier_id", keys={"l_suppkey": "suppkey"})
PART_SUPPLIER = LinkSpec(
    table="link_part_supplier",
    tech_key="part_supplier_id",
    keys=["part_id", "supplier_id"],
)
LINE_HUB = HubSpec(
    table="hub_line", tech_key="line_id", keys={"l_orderkey": "orderkey", "l_linenumber": "line"}
)


@query(
    f"""SELECT o_custkey AS custkey, {sql_rank('o_custkey')} AS customer_id
        FROM (SELECT DISTINCT o_custkey FROM orders)"""
)
def hub_initial(spark, sf_dir):
    return load_hub(read(spark, sf_dir, "orders"), None, CUSTOMER_HUB).inserts


# Orders with a line shipped before the split are in the hub already.
SQL_LINE_ORDERS = f"""
    old AS (SELECT l_orderkey AS k, {sql_rank('l_orderkey')} AS id
            FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE {sql_earlier('l_shipdate')})),
    new AS (SELECT l_orderkey AS k,
                   (SELECT coalesce(max(id), 0) FROM old) + {sql_rank('l_orderkey')} AS id
            FROM (SELECT DISTINCT l_orderkey FROM lineitem
                  WHERE {sql_later('l_shipdate')} AND l_orderkey NOT IN (SELECT k FROM old)))"""

SQL_ORDER_CUSTOMERS = f"""
    old AS (SELECT o_custkey AS k, {sql_rank('o_custkey')} AS id
            FROM (SELECT DISTINCT o_custkey FROM orders
                  WHERE o_orderstatus = 'F' AND {sql_earlier('o_orderdate')})),
    new AS (SELECT o_custkey AS k,
                   (SELECT coalesce(max(id), 0) FROM old) + {sql_rank('o_custkey')} AS id
            FROM (SELECT DISTINCT o_custkey FROM orders
                  WHERE NOT (o_orderstatus = 'F' AND {sql_earlier('o_orderdate')})
                    AND o_custkey NOT IN (SELECT k FROM old)))"""


def _split_orders(spark, sf_dir):
    """Finished orders before the split are loaded; all others are the new batch."""
    orders = read(spark, sf_dir, "orders")
    loaded = (F.col("o_orderstatus") == "F") & (
        F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    )
    return orders.filter(loaded), orders.filter(~loaded)


def _customer_hub(spark, sf_dir):
    loaded, batch = _split_orders(spark, sf_dir)
    return stage(load_hub(loaded, None, CUSTOMER_HUB).inserts, "hub_customer"), batch


@query(f"WITH {SQL_ORDER_CUSTOMERS} SELECT k AS custkey, id AS customer_id FROM new")
def hub_incremental(spark, sf_dir):
    hub, batch = _customer_hub(spark, sf_dir)
    return load_hub(batch, hub, CUSTOMER_HUB).inserts


@query(
    f"""WITH {SQL_ORDER_CUSTOMERS}, hub AS (SELECT * FROM old UNION ALL SELECT * FROM new)
        SELECT orders.*, hub.id AS customer_id FROM orders JOIN hub ON k = o_custkey
        WHERE NOT (o_orderstatus = 'F' AND {sql_earlier('o_orderdate')})"""
)
def hub_output_keys(spark, sf_dir):
    hub, batch = _customer_hub(spark, sf_dir)
    return load_hub(batch, hub, CUSTOMER_HUB).output


@query(
    f"""WITH {SQL_ORDER_CUSTOMERS}, hub AS (SELECT * FROM old UNION ALL SELECT * FROM new)
        SELECT orders.*, hub.id AS customer_id FROM orders JOIN hub ON k = o_custkey
        WHERE NOT (o_orderstatus = 'F' AND {sql_earlier('o_orderdate')})"""
)
def hub_colocated(spark, sf_dir):
    """Two loads into a hub bucketed by its key: the batch, taken as too large to broadcast, goes to the buckets."""
    folder = new_folder(spark, "hub_customer")
    name = f"hub_customer_{folder.rsplit('-', 1)[1]}"
    target = CatalogTable(spark, name, ("custkey",), buckets=8, path=folder)
    loaded, batch = _split_orders(spark, sf_dir)
    load_into(target, loaded, CUSTOMER_HUB)
    return load_into(target, batch, CUSTOMER_HUB, broadcast_bytes=0).output


@query(
    f"""WITH {SQL_ORDER_CUSTOMERS}, hub AS (SELECT * FROM old UNION ALL SELECT * FROM new)
        SELECT orders.*, hub.id AS customer_id FROM orders JOIN hub ON k = o_custkey
        WHERE NOT (o_orderstatus = 'F' AND {sql_earlier('o_orderdate')})"""
)
def hub_bitmap_lookup(spark, sf_dir):
    """Keys taken as too many to broadcast: their hashed bitmap filters the hub before it is shuffled."""
    hub, batch = _customer_hub(spark, sf_dir)
    return load_hub(batch, hub, CUSTOMER_HUB, broadcast_bytes=0).output


@query(
    f"""SELECT lineitem.*, supplier_id FROM lineitem JOIN (
          SELECT l_suppkey AS k, {sql_rank('l_suppkey')} AS supplier_id
          FROM (SELECT DISTINCT l_suppkey FROM lineitem)) ON k = l_suppkey"""
)
def hub_hot_keys(spark, sf_dir):
    """Shuffled lookup in which every key counts as hot."""
    lines = read(spark, sf_dir, "lineitem")
    return load_hub(lines, None, SUPPLIER_HUB, broadcast_bytes=0, hot_rows=100).output


@query(
    f"""SELECT c_name AS name, {sql_rank('c_name')} AS customer_id
        FROM (SELECT DISTINCT c_name FROM customer)"""
)
def hub_string_key(spark, sf_dir):
    spec = HubSpec(table="hub_customer", tech_key="customer_id", keys={"c_name": "name"})
    return load_hub(read(spark, sf_dir, "customer"), None, spec).inserts


@query(
    f"""SELECT url, {sql_rank('url')} AS page_key
        FROM (SELECT DISTINCT url FROM pages)"""
)
def hub_url_key(spark, sf_dir):
    spec = HubSpec(table="hub_page", tech_key="page_key", keys="url")
    return load_hub(read(spark, sf_dir, "pages"), None, spec).inserts


@query(
    f"""SELECT l_orderkey AS orderkey, l_linenumber AS line,
               {sql_rank('l_orderkey', 'l_linenumber')} AS line_id
        FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"""
)
def hub_composite_key(spark, sf_dir):
    return load_hub(read(spark, sf_dir, "lineitem"), None, LINE_HUB).inserts


@query(
    f"""SELECT l_orderkey AS orderkey, l_linenumber AS line, l_shipdate AS shipped,
               l_returnflag AS returnflag,
               {sql_rank('l_orderkey', 'l_linenumber')} AS line_id
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_returnflag) AS n FROM lineitem)
        WHERE n = 1"""
)
def hub_other_attributes(spark, sf_dir):
    spec = HubSpec(
        table="hub_line",
        tech_key="line_id",
        keys={"l_orderkey": "orderkey", "l_linenumber": "line"},
        others={"l_shipdate": "shipped", "l_returnflag": "returnflag"},
    )
    first = ["l_shipdate", "l_partkey", "l_suppkey"]
    return load_hub(read(spark, sf_dir, "lineitem"), None, spec, order_by=first).inserts


@query(
    f"""SELECT c_custkey AS custkey, TIMESTAMP '2024-01-01 00:00:00' AS load_dts,
               'crm' AS rec_src, {sql_rank('c_custkey')} AS customer_id
        FROM (SELECT DISTINCT c_custkey FROM customer)"""
)
def hub_audit_columns(spark, sf_dir):
    spec = HubSpec(
        table="hub_customer",
        tech_key="customer_id",
        keys={"c_custkey": "custkey"},
        load_dts_col="load_dts",
        rec_src_col="rec_src",
        rec_src="crm",
        types={"load_dts": "timestamp_ntz"},
    )
    return load_hub(read(spark, sf_dir, "customer"), None, spec, load_ts=STAMP).inserts


@query(
    f"""SELECT c_custkey AS custkey, 'crm/eu/${{zone}}' AS rec_src,
               {sql_rank('c_custkey')} AS customer_id
        FROM (SELECT DISTINCT c_custkey FROM customer)"""
)
def hub_variables(spark, sf_dir):
    spec = HubSpec(
        schema="${layer}",
        table="hub_customer",
        tech_key="customer_id",
        keys={"c_custkey": "custkey"},
        rec_src_col="rec_src",
        rec_src="${system}/${region}/${zone}",
        variables={"layer": "raw", "system": "crm", "region": "eu"},
    )
    return load_hub(read(spark, sf_dir, "customer"), None, spec).inserts


@query(
    f"""SELECT c_custkey, c_name, name_id FROM customer JOIN (
          SELECT c_name AS k, {sql_rank('c_name')} AS name_id
          FROM (SELECT DISTINCT c_name FROM customer)) ON k = c_name"""
)
def hub_binary_key(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(
        "c_custkey", F.encode("c_name", "UTF-8").alias("c_name")
    )
    spec = HubSpec(
        table="hub_name", tech_key="name_id", keys={"c_name": "name"}, types={"name": "string"}
    )
    return load_hub(customers, None, spec).output


SQL_BLANKED = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderpriority = '5-LOW' THEN ''
                WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS since
    FROM orders"""


def blanked_orders(spark, sf_dir):
    """Orders with some keys and dates made empty or NULL."""
    priority = F.col("o_orderpriority")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(priority == "5-LOW", F.lit(""))
        .when(priority != "4-NOT SPECIFIED", priority)
        .alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer"),
        F.when(priority != "1-URGENT", F.col("o_orderdate")).alias("since"),
    )


PRIORITY_HUB = HubSpec(table="hub_p", tech_key="p_id", keys=["customer", "priority"])


@query(
    f"""SELECT * FROM ({SQL_BLANKED})
        WHERE customer IS NULL OR priority IS NULL OR priority = ''"""
)
def hub_rejects(spark, sf_dir):
    orders = blanked_orders(spark, sf_dir)
    return load_hub(orders, None, PRIORITY_HUB, on_invalid="reject").rejects


@query(
    f"""SELECT customer, priority, {sql_rank('customer', 'priority')} AS p_id
        FROM (SELECT DISTINCT customer, priority FROM ({SQL_BLANKED})
              WHERE customer IS NOT NULL AND priority <> '')"""
)
def hub_without_rejects(spark, sf_dir):
    orders = blanked_orders(spark, sf_dir)
    return load_hub(orders, None, PRIORITY_HUB, on_invalid="reject").inserts


@query(f"WITH {SQL_LINE_ORDERS} SELECT k AS orderkey, id AS order_id FROM new")
def key_tablemax_incremental(spark, sf_dir):
    spec = HubSpec(table="hub_order", tech_key="order_id", keys={"l_orderkey": "orderkey"})
    lines = read(spark, sf_dir, "lineitem")
    hub = stage(load_hub(earlier(lines, "l_shipdate"), None, spec).inserts, "hub_order")
    return load_hub(later(lines, "l_shipdate"), hub, spec).inserts


@query(
    f"""SELECT l_orderkey AS orderkey, l_linenumber AS line, l_partkey AS partkey,
               {sql_rank('l_orderkey', 'l_linenumber', 'l_partkey')} AS line_id
        FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)"""
)
def key_tablemax_large(spark, sf_dir):
    spec = HubSpec(
        table="hub_line",
        tech_key="line_id",
        keys={"l_orderkey": "orderkey", "l_linenumber": "line", "l_partkey": "partkey"},
    )
    return load_hub(read(spark, sf_dir, "lineitem"), None, spec).inserts


@query(
    f"""SELECT l_partkey AS partkey, 1000 + 5 * ({sql_rank('l_partkey')} - 1) AS part_id
        FROM (SELECT DISTINCT l_partkey FROM lineitem)"""
)
def key_sequence(spark, sf_dir):
    spec = HubSpec(
        table="hub_part",
        tech_key="part_id",
        keys={"l_partkey": "partkey"},
        key_method=SEQUENCE,
        sequence_start=1000,
        sequence_increment=5,
    )
    return load_hub(read(spark, sf_dir, "lineitem"), None, spec).inserts


SQL_SEQUENCE = f"""
    old AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE {sql_earlier('l_shipdate')}),
    new AS (SELECT DISTINCT l_partkey AS k FROM lineitem
            WHERE {sql_later('l_shipdate')} AND l_partkey NOT IN (SELECT k FROM old)),
    numbered AS (SELECT k, 1000 + 5 * ({sql_rank('k')} - 1) AS id FROM old
                 UNION ALL
                 SELECT k, 1000 + 5 * ((SELECT count(*) FROM old) + {sql_rank('k')} - 1) FROM new)"""


@query(f"WITH {SQL_SEQUENCE} SELECT k AS partkey, id AS part_id FROM numbered")
def key_sequence_incremental(spark, sf_dir):
    """Two loads that take their numbers from one sequence."""
    spec = HubSpec(
        table="hub_part",
        tech_key="part_id",
        keys={"l_partkey": "partkey"},
        key_method=SEQUENCE,
        sequence_increment=5,
    )
    sequence = Sequence(spark, new_folder(spark, "sequence"), start=1000, increment=5)
    target = ParquetTable(spark, new_folder(spark, "hub_part"))
    lines = read(spark, sf_dir, "lineitem")
    for batch in (earlier(lines, "l_shipdate"), later(lines, "l_shipdate")):
        load_into(target, batch, spec, sequence=sequence)
    return target.read()


@query(
    f"""WITH old AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE {sql_earlier('l_shipdate')}),
        first AS (SELECT l_orderkey AS k, min((l_partkey, l_suppkey)) AS v FROM lineitem
                  WHERE {sql_later('l_shipdate')} AND l_orderkey NOT IN (SELECT k FROM old) GROUP BY l_orderkey)
        SELECT k AS orderkey, v[1] AS partkey, v[2] AS suppkey,
               (SELECT count(*) FROM old) + {sql_rank('k')} AS order_id FROM first"""
)
def hub_other_attributes_incremental(spark, sf_dir):
    """Other attributes of keys that a first load did not have."""
    spec = HubSpec(
        table="hub_order",
        tech_key="order_id",
        keys={"l_orderkey": "orderkey"},
        others={"l_partkey": "partkey", "l_suppkey": "suppkey"},
    )
    lines = read(spark, sf_dir, "lineitem")
    stored = stage(load_hub(earlier(lines, "l_shipdate"), None, spec).inserts, "hub_order")
    return load_hub(later(lines, "l_shipdate"), stored, spec).inserts


@query(
    f"""SELECT p_partkey AS partkey,
               (row_number() OVER (PARTITION BY digest ORDER BY p_partkey) - 1) * 65536
               + CAST('0x' || digest AS BIGINT) + 1 AS part_id
        FROM (SELECT p_partkey, {sql_digest('p_partkey')} AS digest
              FROM (SELECT DISTINCT p_partkey FROM part))"""
)
def key_auto_increment(spark, sf_dir):
    spec = HubSpec(
        table="hub_part",
        tech_key="part_id",
        keys={"p_partkey": "partkey"},
        key_method=AUTO_INCREMENT,
    )
    return load_hub(read(spark, sf_dir, "part"), None, spec).inserts


SQL_LINES_IN_ORDER = f"""
    old AS (SELECT k, l, row_number() OVER (ORDER BY k, l) AS id FROM (
              SELECT DISTINCT l_orderkey AS k, l_linenumber AS l FROM lineitem WHERE {sql_earlier('l_shipdate')})),
    new AS (SELECT k, l, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY k, l) AS id FROM (
              SELECT DISTINCT l_orderkey AS k, l_linenumber AS l FROM lineitem
              WHERE {sql_later('l_shipdate')} AND (l_orderkey, l_linenumber) NOT IN (SELECT k, l FROM old)))"""


@query(
    f"""WITH {SQL_LINES_IN_ORDER}
        SELECT k AS orderkey, l AS line, id AS line_id FROM old UNION ALL SELECT k, l, id FROM new"""
)
def key_business_order(spark, sf_dir):
    """Two loads whose new keys are numbered in the order of the business keys."""
    spec = replace(LINE_HUB, key_order=BY_KEY)
    lines = read(spark, sf_dir, "lineitem")
    first = stage(load_hub(earlier(lines, "l_shipdate"), None, spec).inserts, "hub_line")
    return first.unionByName(load_hub(later(lines, "l_shipdate"), first, spec).inserts)


# -- links -------------------------------------------------------------------


SQL_KEYED_LINES = f"""
    parts AS (SELECT l_partkey AS pk, {sql_rank('l_partkey')} AS part_id
              FROM (SELECT DISTINCT l_partkey FROM lineitem)),
    suppliers AS (SELECT l_suppkey AS sk, {sql_rank('l_suppkey')} AS supplier_id
                  FROM (SELECT DISTINCT l_suppkey FROM lineitem)),
    keyed AS (SELECT lineitem.*, part_id, supplier_id FROM lineitem
              JOIN parts ON pk = l_partkey JOIN suppliers ON sk = l_suppkey)"""

SQL_LINKS = f"""
    old AS (SELECT part_id AS p, supplier_id AS s, {sql_rank('part_id', 'supplier_id')} AS id
            FROM (SELECT DISTINCT part_id, supplier_id FROM keyed
                  WHERE {sql_earlier('l_shipdate')})),
    new AS (SELECT part_id AS p, supplier_id AS s,
                   (SELECT max(id) FROM old) + {sql_rank('part_id', 'supplier_id')} AS id
            FROM (SELECT DISTINCT part_id, supplier_id FROM keyed
                  WHERE {sql_later('l_shipdate')}
                    AND (part_id, supplier_id) NOT IN (SELECT p, s FROM old)))"""


def _keyed_lines(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    with_part = load_hub(lines, None, PART_HUB).output
    return stage(load_hub(with_part, None, SUPPLIER_HUB).output, "lines")


def _links(spark, sf_dir):
    lines = _keyed_lines(spark, sf_dir)
    loaded = load_link(earlier(lines, "l_shipdate"), None, PART_SUPPLIER).inserts
    return stage(loaded, "link_part_supplier"), later(lines, "l_shipdate")


@query(
    f"""WITH {SQL_KEYED_LINES}
        SELECT part_id, supplier_id, {sql_rank('part_id', 'supplier_id')} AS part_supplier_id
        FROM (SELECT DISTINCT part_id, supplier_id FROM keyed)"""
)
def link_initial(spark, sf_dir):
    return load_link(_keyed_lines(spark, sf_dir), None, PART_SUPPLIER).inserts


@query(
    f"""WITH {SQL_KEYED_LINES}, {SQL_LINKS}
        SELECT p AS part_id, s AS supplier_id, id AS part_supplier_id FROM new"""
)
def link_incremental(spark, sf_dir):
    link, batch = _links(spark, sf_dir)
    return load_link(batch, link, PART_SUPPLIER).inserts


@query(
    f"""WITH {SQL_KEYED_LINES}, {SQL_LINKS},
             link AS (SELECT * FROM old UNION ALL SELECT * FROM new)
        SELECT keyed.*, id AS part_supplier_id
        FROM keyed JOIN link ON p = part_id AND s = supplier_id
        WHERE {sql_later('l_shipdate')}"""
)
def link_output_keys(spark, sf_dir):
    link, batch = _links(spark, sf_dir)
    return load_link(batch, link, PART_SUPPLIER).output
