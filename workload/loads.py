"""Queries over joins, loads and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import aggregate, joins
from millrace.plans import export, load
from millrace.plans.warehouse import Warehouse
from millrace.session import scratch_dir
from millrace.sources import files
from workload import (
    EVENTS_LOADED_UNTIL,
    ORDERS_LOADED_UNTIL,
    SQL_NOISY_EVENTS,
    noisy_events,
    query,
    table,
    ts_text,
)

EVENT_CASTS = {"event_id": "BIGINT", "ts": "TIMESTAMP", "value": "DOUBLE"}


def new_warehouse(spark) -> Warehouse:
    return Warehouse(spark, scratch_dir(spark, "warehouse"))


def staged_events(spark, sf) -> DataFrame:
    """The dirty batch: text key, time and value, and a column the table does not have."""
    return noisy_events(spark, sf).select(
        F.col("id_raw").alias("event_id"), F.col("ts_raw").alias("ts"), F.col("value_raw").alias("value"),
        "user_id", "event_type", F.lit("noise").alias("extra"),
    )


def loaded_events(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").filter(F.col("ts") < F.lit(EVENTS_LOADED_UNTIL).cast("timestamp_ntz"))
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value", "user_id", "event_type")


SQL_STAGED = f"""
{SQL_NOISY_EVENTS},
staged AS (SELECT TRY_CAST(id_raw AS BIGINT) AS event_id, TRY_CAST(ts_raw AS TIMESTAMP) AS ts,
                  TRY_CAST(value_raw AS DOUBLE) AS value, user_id, event_type FROM noisy),
loaded AS (SELECT event_id, ts, value, user_id, event_type FROM events WHERE ts < TIMESTAMP '{EVENTS_LOADED_UNTIL}'),
fresh AS (SELECT s.* FROM staged s WHERE s.event_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM loaded t WHERE t.event_id = s.event_id))
"""


@query("anti_join_single", f"""
SELECT event_id, event_type FROM events s
WHERE NOT EXISTS (SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '{EVENTS_LOADED_UNTIL}' AND t.event_id = s.event_id)
""")
def anti_join_single(spark, sf):
    """K1: rows with a key the table does not have."""
    e = table(spark, sf, "events")
    return joins.anti_join(e.select("event_id", "event_type"), loaded_events(spark, sf), ["event_id"])


@query("anti_join_composite", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem s WHERE NOT EXISTS (
  SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '{ORDERS_LOADED_UNTIL}'
  AND t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
""")
def anti_join_composite(spark, sf):
    """K2: composite key, with copies of a key on both sides."""
    l = table(spark, sf, "lineitem")
    seen = l.filter(F.col("l_shipdate") < F.lit(ORDERS_LOADED_UNTIL).cast("timestamp_ntz"))
    return joins.anti_join(l.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), seen, ["l_orderkey", "l_linenumber"])


@query("anti_join_cast", f"""
WITH {SQL_STAGED}
SELECT s.event_id, s.user_id, s.event_type FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM loaded t WHERE t.event_id = s.event_id)
""")
def anti_join_cast(spark, sf):
    """K3: keys compared after their cast; NULL keys match nothing."""
    rows = staged_events(spark, sf).select("event_id", "user_id", "event_type")
    return joins.anti_join_cast(rows, loaded_events(spark, sf), ["event_id"], {"event_id": "BIGINT"})


@query("not_exists", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')
""")
def not_exists(spark, sf):
    """K4: the correlated form in SQL, planned as an anti join."""
    table(spark, sf, "customer").createOrReplaceTempView("k4_customer")
    table(spark, sf, "orders").createOrReplaceTempView("k4_orders")
    return spark.sql(
        "SELECT c_custkey, c_name FROM k4_customer c WHERE NOT EXISTS "
        "(SELECT 1 FROM k4_orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')"
    )


def incremental_events(spark, sf) -> tuple[Warehouse, load.Batch]:
    wh = new_warehouse(spark)
    load.load(wh, "events", loaded_events(spark, sf))
    return wh, load.load(wh, "events", staged_events(spark, sf), "incremental", keys=["event_id"], cast_map=EVENT_CASTS)


@query("incremental_insert", f"""
WITH {SQL_STAGED}
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       CASE WHEN isnan(value) THEN NULL ELSE value END AS value, isnan(value) AS value_is_nan, user_id, event_type
FROM (SELECT * FROM loaded UNION ALL SELECT * FROM fresh)
""")
def incremental_insert(spark, sf):
    """Cast, drop NULL keys, insert unseen keys, align to the table by name."""
    wh, _ = incremental_events(spark, sf)
    return wh.table("events").select(
        "event_id", ts_text("ts").alias("ts"), F.when(~F.isnan("value"), F.col("value")).alias("value"),
        F.when(F.col("value").isNotNull(), F.isnan("value")).alias("value_is_nan"), "user_id", "event_type",
    )


@query("incremental_counters", f"""
WITH {SQL_STAGED}
SELECT (SELECT count(*) FROM fresh) AS inserted, (SELECT count(*) FROM staged WHERE event_id IS NULL) AS skipped_null_key,
       (SELECT count(*) FROM staged WHERE event_id IS NOT NULL) - (SELECT count(*) FROM fresh) AS skipped_dup,
       (SELECT count(*) FROM loaded) + (SELECT count(*) FROM fresh) AS table_rows, CAST(0 AS BIGINT) AS inserted_again
""")
def incremental_counters(spark, sf):
    """The counters, and a second load of the same batch that inserts nothing."""
    wh, first = incremental_events(spark, sf)
    again = load.load(wh, "events", staged_events(spark, sf), "incremental", keys=["event_id"], cast_map=EVENT_CASTS)
    n = {k: F.lit(first.counters[k]).cast("bigint") for k in ("inserted", "skipped_null_key", "skipped_dup")}
    return wh.table("events").agg(F.count("*").alias("table_rows")).select(
        *[c.alias(k) for k, c in n.items()], "table_rows", F.lit(again.rows).cast("bigint").alias("inserted_again")
    )


@query("incremental_composite", f"""
WITH seen AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{ORDERS_LOADED_UNTIL}'),
fresh AS (SELECT * FROM lineitem s WHERE NOT EXISTS (
  SELECT 1 FROM seen t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS r FROM fresh) WHERE r = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM seen
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM one
""")
def incremental_composite(spark, sf):
    """L5 with a composite key and one row per key within the batch."""
    wh, l = new_warehouse(spark), table(spark, sf, "lineitem")
    load.load(wh, "lines", l.filter(F.col("l_shipdate") < F.lit(ORDERS_LOADED_UNTIL).cast("timestamp_ntz")))
    load.load(
        wh, "lines", l, "incremental", keys=["l_orderkey", "l_linenumber"], dedupe_batch=True,
        order_by=["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
    )
    return wh.table("lines").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("load_replace", "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_totalprice >= 100000 GROUP BY 1")
def load_replace(spark, sf):
    """L1: the second load replaces the first."""
    wh, o = new_warehouse(spark), table(spark, sf, "orders")
    load.load(wh, "orders", o)
    load.load(wh, "orders", wh.table("orders").filter("o_totalprice >= 100000"))
    return wh.table("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("load_append", "SELECT o_orderstatus, 2 * count(*) AS n, CAST(2 * sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def load_append(spark, sf):
    """Created by the first load, aligned by name in the second."""
    wh, o = new_warehouse(spark), table(spark, sf, "orders")
    load.load(wh, "orders", o, "append")
    load.load(wh, "orders", o.select(F.lit("x").alias("extra"), *reversed(o.columns)), "append")
    return wh.table("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("load_dispatch", """
SELECT step, rows, table_rows FROM (
  SELECT 1 AS step, count(*) AS rows, count(*) AS table_rows FROM orders
  UNION ALL SELECT 2, 0, count(*) FROM orders
  UNION ALL SELECT 3, count(*), 2 * count(*) FROM orders
  UNION ALL SELECT 4, count(*), 2 * count(*) FROM orders
  UNION ALL SELECT 5, 0, 2 * count(*) FROM orders)
""")
def load_dispatch(spark, sf):
    """L4: replace, empty replace (table untouched), append, upsert, increment."""
    wh, o = new_warehouse(spark), table(spark, sf, "orders")
    steps = []
    for step, (df, mode) in enumerate(
        [(o, "replace"), (o.filter("false"), "replace"), (o, "append"), (o, "upsert"), (o, "incremental")], start=1
    ):
        b = load.load(wh, "orders", df, mode, **({"keys": ["o_orderkey"]} if mode in ("upsert", "incremental") else {}))
        n = wh.table("orders").agg(F.count("*").alias("table_rows"))
        rows = b.counters.get("inserted", b.counters.get("rows_batch", b.rows))
        steps.append(n.select(F.lit(step).alias("step"), F.lit(rows).cast("bigint").alias("rows"), "table_rows"))
    return aggregate.union_all(*steps)


@query("upsert_by_key", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
UNION ALL SELECT -1 - c_custkey, c_name, NULL, c_acctbal, NULL FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT NULL, c_name, NULL, c_acctbal, NULL FROM customer WHERE c_mktsegment = 'FURNITURE'
""")
def upsert_by_key(spark, sf):
    """L3, K5: matches updated in the given columns, new keys and NULL keys inserted."""
    wh, c = new_warehouse(spark), table(spark, sf, "customer")
    load.load(wh, "customer", c)
    seg = F.col("c_mktsegment")
    changes = aggregate.union_all(
        c.filter(seg == "BUILDING").select("c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 100).alias("c_acctbal")),
        c.filter(seg == "MACHINERY").select((-1 - F.col("c_custkey")).alias("c_custkey"), "c_name", "c_acctbal"),
        c.filter(seg == "FURNITURE").select(F.lit(None).cast("bigint").alias("c_custkey"), "c_name", "c_acctbal"),
    )
    load.load(wh, "customer", changes, "upsert", keys=["c_custkey"])
    return wh.table("customer")


@query("export_sql_partitioned", f"""
WITH {SQL_STAGED}
SELECT CAST(year(ts) AS INTEGER) AS year, lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS month, day(ts) AS day,
       count(*) AS filas, CAST(sum(event_id) AS BIGINT) AS ids
FROM (SELECT * FROM loaded UNION ALL SELECT * FROM fresh) GROUP BY 1, 2, 3
""")
def export_sql_partitioned(spark, sf):
    """The flagship flow: increment, export of a query by computed columns, counts read back."""
    wh, _ = incremental_events(spark, sf)
    sql = "SELECT *, year(ts) AS year, lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS month FROM events"
    path = export.export_query(wh, sql, f"{scratch_dir(spark, 'export')}/events", ["year", "month"])
    back = files.read_parquet_tree(spark, path, "year int, month string")
    return back.groupBy("year", "month", F.day("ts").cast("bigint").alias("day")).agg(
        F.count("*").alias("filas"), F.sum("event_id").alias("ids")
    )


@query("export_all_reconcile", """
WITH n AS (SELECT 'events' AS table_name, count(*) AS c FROM events UNION ALL SELECT 'orders', count(*) FROM orders
           UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
SELECT table_name, c AS table_rows, c AS export_rows, CAST(0 AS BIGINT) AS difference FROM n
UNION ALL SELECT 'TOTAL', CAST(sum(c) AS BIGINT), CAST(sum(c) AS BIGINT), CAST(0 AS BIGINT) FROM n
""")
def export_all_reconcile(spark, sf):
    """Every configured export, rows compared with the tables."""
    wh, root = new_warehouse(spark), scratch_dir(spark, "export")
    sources = []
    for name, time in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        load.load(wh, name, table(spark, sf, name))
        block = {"dir": f"{root}/{name}", "overwrite": True, "partition_by": ["year"],
                 "export_sql": f"SELECT *, year({time}) AS year FROM {name}"}
        sources.append({"name": f"{name}_source", "type": "parquet", "table": name, "export_parquet": block})
    done = export.export_all(wh, {"groups": {"daily": sources[:2], "weekly": sources[2:]}})
    return aggregate.reconcile(
        {name: wh.table(name) for name in done},
        {name: files.read_parquet_tree(spark, path, "year int") for name, path in done.items()},
    )


@query("duplicate_probe", """
SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_extendedprice) AS min_val, max(l_extendedprice) AS max_val
FROM lineitem GROUP BY 1, 2
""")
def duplicate_probe(spark, sf):
    """A5: copies per key and the range of a value within them."""
    return aggregate.duplicate_probe(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_extendedprice")


@query("concat_by_name", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, CAST(NULL AS DOUBLE) AS price FROM customer
UNION ALL SELECT p_partkey, p_name, NULL, p_retailprice FROM part
""")
def concat_by_name(spark, sf):
    """Frames united by name, missing columns NULL."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    p = table(spark, sf, "part").select(F.col("p_retailprice").alias("price"), F.col("p_name").alias("name"), F.col("p_partkey").alias("key"))
    return aggregate.concat_by_name(c, p)
