"""Queries over quality rules, runs and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.plans import export, ledger, runner
from millrace.plans.warehouse import Warehouse
from millrace.session import scratch_dir
from workload import AS_OF, SQL_NOISY_EVENTS, noisy_events, query, table
from workload.loads import new_warehouse

EVENT_RULES = {
    "schema": {"id_raw": "int", "ts_raw": "datetime", "value_raw": "float", "absent": "int"},
    "checks": [
        {"not_null": ["id_raw", "ts_raw"]},
        {"not_null": ["event_type"]},
        {"unique": ["id_raw"]},
        {"unique": ["event_id"]},
        {"range": {"column": "value_raw", "min": 0, "max": 400, "inclusive": True}},
        {"range": {"column": "user_id", "min": 0}},
        {"range": {"column": "absent", "max": 1}},
    ],
    "on_fail": "block",
}
DQ = {
    "rules": {
        "events": EVENT_RULES,
        "orders": {"checks": [{"not_null": ["o_orderkey"]}, {"unique": ["o_orderkey"]},
                              {"range": {"column": "o_totalprice", "min": 0, "max": 10_000_000}}]},
        "lineitem": {"checks": [{"unique": ["l_orderkey", "l_linenumber"]}, {"range": {"column": "l_discount", "min": 0, "max": 0.05}}]},
    }
}

SQL_EVENT_REPORT = f"""
{SQL_NOISY_EVENTS},
typed AS (SELECT TRY_CAST(id_raw AS BIGINT) AS id_raw, TRY_CAST(ts_raw AS TIMESTAMP) AS ts_raw,
  CASE WHEN isnan(TRY_CAST(value_raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(value_raw AS DOUBLE) END AS value_raw,
  event_id, user_id, event_type FROM noisy),
report AS (
  SELECT 'not_null(id_raw,ts_raw)' AS rule, count(*) FILTER (WHERE id_raw IS NULL OR ts_raw IS NULL) AS bad_rows, count(*) AS total_rows FROM typed
  UNION ALL SELECT 'not_null(event_type)', count(*) FILTER (WHERE event_type IS NULL), count(*) FROM typed
  UNION ALL SELECT 'unique(id_raw)', (SELECT count(*) FROM typed) - (SELECT count(*) FROM (SELECT DISTINCT id_raw FROM typed)), count(*) FROM typed
  UNION ALL SELECT 'unique(event_id)', (SELECT count(*) FROM typed) - (SELECT count(*) FROM (SELECT DISTINCT event_id FROM typed)), count(*) FROM typed
  UNION ALL SELECT 'range(value_raw,0,400)', count(*) FILTER (WHERE value_raw < 0 OR value_raw > 400), count(*) FROM typed
  UNION ALL SELECT 'range(user_id,0,)', count(*) FILTER (WHERE user_id < 0), count(*) FROM typed
  UNION ALL SELECT 'range(absent,,1)', 0, count(*) FROM typed)
"""


def _report(df, name, checks=None):
    block = {**EVENT_RULES, "checks": [c for c in EVENT_RULES["checks"] if checks is None or checks in c]}
    return quality.report(df, name, quality.rules_for({"rules": {name: block}}, name))


@query("dq_report", f"WITH {SQL_EVENT_REPORT} SELECT 'events' AS table_name, rule, bad_rows, total_rows, bad_rows = 0 AS passed FROM report")
def dq_report(spark, sf):
    """Q1-Q4, Q6: every rule with its bad rows; one scan for all row rules."""
    return _report(noisy_events(spark, sf), "events")


for _kind in ("not_null", "unique", "range"):

    def _one_kind(spark, sf, kind=_kind):
        return _report(noisy_events(spark, sf), "events", kind).select("rule", "bad_rows", "passed")

    _one_kind.__doc__ = f"The {_kind} rules alone."
    query(f"dq_{_kind}", f"WITH {SQL_EVENT_REPORT} SELECT rule, bad_rows, bad_rows = 0 AS passed FROM report WHERE rule LIKE '{_kind}(%'")(_one_kind)


@query("dq_verdict", f"""
WITH {SQL_EVENT_REPORT}
SELECT 'events' AS table_name, count(*) FILTER (WHERE bad_rows > 0) AS violations, count(*) FILTER (WHERE bad_rows > 0) = 0 AS passed,
       'block' AS on_fail FROM report
""")
def dq_verdict(spark, sf):
    """Q5: failed rules, not rows."""
    return quality.verdict_frame(_report(noisy_events(spark, sf), "events"), "events", "block")


def run_daily(spark, sf):
    """A group of three sources: dirty events (block), clean orders, lineitem that fails (warn)."""
    root, wh = scratch_dir(spark, "run"), new_warehouse(spark)
    noisy_events(spark, sf).write.parquet(f"{root}/events")
    lines = export.export_csv(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), f"{root}/lineitem")
    config = {
        "defaults": {"mode": "replace"},
        "groups": {"daily": [
            {"name": "events_src", "type": "parquet", "table": "events", "params": {"path": f"{root}/events"}},
            {"name": "orders_src", "type": "parquet", "table": "orders", "mode": "incremental",
             "params": {"path": f"{sf}/orders.parquet"}, "incremental": {"key": ["o_orderkey"], "cast_map": {"o_totalprice": "DOUBLE"}}},
            {"name": "lineitem_src", "type": "csv_local_simple", "table": "lineitem", "mode": "append",
             "params": {"path": f"{lines}/*.csv", "dtype": {"l_orderkey": "int", "l_linenumber": "int", "l_discount": "float"}}},
        ]},
    }
    return wh, config


def _group_metrics(wh: Warehouse):
    return ledger.metrics(wh).select(
        "source_name", "table_name", "rows_loaded", "rows_table", "dq_pass", F.col("dq_violations").cast("bigint").alias("dq_violations")
    )


@query("group_run_metrics", f"""
WITH {SQL_EVENT_REPORT},
o AS (SELECT count(*) AS n,
  CAST(count(*) <> count(o_orderkey) AS INTEGER) + CAST(count(*) <> count(DISTINCT o_orderkey) AS INTEGER)
  + CAST(count(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice > 10000000) > 0 AS INTEGER) AS failed FROM orders),
l AS (SELECT count(*) AS n, CAST((SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) < count(*) AS INTEGER)
  + CAST(count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.05) > 0 AS INTEGER) AS failed FROM lineitem)
SELECT 'events_src' AS source_name, 'events' AS table_name, CAST(0 AS BIGINT) AS rows_loaded, CAST(0 AS BIGINT) AS rows_table,
       count(*) = 0 AS dq_pass, count(*) AS dq_violations FROM report WHERE bad_rows > 0
UNION ALL SELECT 'orders_src', 'orders', n, n, failed = 0, CAST(failed AS BIGINT) FROM o
UNION ALL SELECT 'lineitem_src', 'lineitem', n, n, failed = 0, CAST(failed AS BIGINT) FROM l
""")
def group_run_metrics(spark, sf):
    """A blocked batch is not published, a warned one is, each has a metrics row."""
    wh, config = run_daily(spark, sf)
    runner.run_group(spark, wh, config, DQ, "daily", as_of=AS_OF)
    return _group_metrics(wh)


@query("dq_gate", f"""
WITH {SQL_EVENT_REPORT}
SELECT CASE WHEN count(*) > 0 THEN 'fail' ELSE 'ok' END AS status, CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 3 END AS BIGINT) AS sources_recorded,
       count(*) AS violations, CASE WHEN count(*) > 0 THEN 'events_src' ELSE 'orders_src' END AS last_source
FROM report WHERE bad_rows > 0
""")
def dq_gate(spark, sf):
    """Q7: under fail-fast the failing source is recorded and ends the group."""
    wh, config = run_daily(spark, sf)
    result = runner.run_group(spark, wh, config, DQ, "daily", fail_fast=True, as_of=AS_OF)
    return ledger.metrics(wh).agg(
        F.count("*").alias("sources_recorded"), F.sum("dq_violations").alias("violations"), F.max("source_name").alias("last_source")
    ).select(F.lit(result.status).alias("status"), "sources_recorded", "violations", "last_source")


@query("run_health", """
SELECT source_name, ok, rows, "table" FROM (
SELECT 'broken' AS source_name, 'false' AS ok, NULL AS rows, NULL AS "table"
UNION ALL SELECT 'customers', 'true', CAST(count(*) AS VARCHAR), 'customer' FROM customer
UNION ALL SELECT 'nations', 'true', CAST(count(*) AS VARCHAR), 'nation' FROM nation)
""")
def run_health(spark, sf):
    """Independent sources; the broken one is recorded and the others go on."""
    wh = new_warehouse(spark)
    sources = [
        {"type": "parquet", "target_table": "customer", "name": "customers", "path": f"{sf}/customer.parquet"},
        {"type": "parquet", "target_table": "broken", "path": f"{sf}/no_such_file.parquet"},
        {"type": "parquet", "target_table": "nation", "name": "nations", "path": f"{sf}/nation.parquet",
         "load_mode": "upsert", "key_columns": ["n_nationkey"]},
    ]
    runner.run_sources(wh, sources, as_of=AS_OF)
    health = ledger.source_health(ledger.metrics(wh))
    return health.select(
        "source_name", *[F.get_json_object("health", f"$.{k}").alias(k) for k in ("ok", "rows", "table")]
    )


def event_ledger(spark, sf):
    """Metrics rows made from all events: one load per event, some without a load time."""
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("run"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_id"),
        F.col("event_type").alias("source_name"),
        F.concat(F.lit("table_"), "user_id").alias("table_name"),
        F.col("event_id").alias("rows_loaded"),
        F.col("value").alias("duration_s"),
        (F.col("event_id") % 3 != 0).alias("dq_pass"),
        (F.col("event_id") % 3).cast("int").alias("dq_violations"),
        F.when(F.col("event_id") % 10 != 9, F.col("ts")).alias("loaded_at"),
    )


def event_runs(spark, sf):
    m = event_ledger(spark, sf)
    return m.select(
        "run_id", F.col("loaded_at").alias("started_at"), F.col("loaded_at").alias("finished_at"),
        F.col("source_name").alias("group_name"), F.when(F.col("dq_pass"), "ok").otherwise("fail").alias("status"),
        F.lit(None).cast("string").alias("error"), F.lit(1).alias("sources_count"), F.col("rows_loaded").alias("rows_total"), "duration_s",
    )


SQL_LEDGER = """
metrics AS (SELECT 'run' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id, event_type AS source_name,
  'table_' || CAST(user_id AS VARCHAR) AS table_name, event_id AS rows_loaded, value AS duration_s, event_id % 3 <> 0 AS dq_pass,
  CAST(event_id % 3 AS INTEGER) AS dq_violations, CASE WHEN event_id % 10 <> 9 THEN ts END AS loaded_at FROM events),
runs AS (SELECT run_id, loaded_at AS started_at, loaded_at AS finished_at, source_name AS group_name,
  CASE WHEN dq_pass THEN 'ok' ELSE 'fail' END AS status, rows_loaded AS rows_total, duration_s FROM metrics)
"""


def _text_times(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in df.columns if c.endswith("_at")})


@query("recent_runs", f"""
WITH {SQL_LEDGER} SELECT run_id, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS finished_at,
  group_name, status, rows_total, duration_s FROM runs ORDER BY runs.started_at DESC NULLS LAST, run_id DESC LIMIT 20
""")
def recent_runs(spark, sf):
    """The latest runs."""
    return _text_times(ledger.recent_runs(event_runs(spark, sf), 20))


@query("recent_metrics", f"""
WITH {SQL_LEDGER} SELECT run_id, source_name, table_name, rows_loaded, dq_pass, dq_violations, duration_s,
  strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at FROM metrics ORDER BY metrics.loaded_at DESC NULLS LAST, run_id DESC LIMIT 100
""")
def recent_metrics(spark, sf):
    """The latest metrics, unknown load times last."""
    return _text_times(ledger.recent_metrics(event_ledger(spark, sf), 100, by_load_time=True))


@query("last_load_per_table", f"""
WITH {SQL_LEDGER} SELECT table_name, source_name, rows_loaded, dq_pass, dq_violations, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at
FROM metrics QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY metrics.loaded_at DESC NULLS LAST, run_id DESC) = 1
""")
def last_load_per_table(spark, sf):
    """R8, W1."""
    return _text_times(ledger.last_loads(event_ledger(spark, sf)))


@query("last_run", f"""
WITH {SQL_LEDGER} SELECT run_id, status, rows_total, strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS finished_at
FROM runs ORDER BY started_at DESC NULLS LAST, run_id DESC LIMIT 1
""")
def last_run(spark, sf):
    """R9."""
    return _text_times(ledger.last_run(event_runs(spark, sf)))


@query("run_health_records", f"""
WITH {SQL_LEDGER} SELECT run_id, '{{"run_id":"' || run_id || '","group":"' || group_name || '","status":"' || status
  || '","error":null,"sources":1,"rows_total":' || CAST(rows_total AS VARCHAR) || ',"at":'
  || CASE WHEN finished_at IS NULL THEN 'null' ELSE '"' || strftime(finished_at, '%Y-%m-%d') || '"' END || '}}' AS health FROM runs
""")
def run_health_records(spark, sf):
    """One JSON text per run (durations left out, times cut to the day)."""
    runs = event_runs(spark, sf).withColumn("finished_at", F.date_format("finished_at", "yyyy-MM-dd"))
    return ledger.run_health(runs).withColumn("health", F.regexp_replace("health", r'"duration_s":[^,]*,', ""))


@query("incremental_audit", f"""
WITH {SQL_EVENT_REPORT}
SELECT 'events' AS table_name, rule, bad_rows, total_rows, bad_rows = 0 AS passed FROM report
""")
def incremental_audit(spark, sf):
    """A table in three increments, each audited by reading what is new; the last report is of all rows."""
    root, wh = scratch_dir(spark, "run"), new_warehouse(spark)
    e = noisy_events(spark, sf)
    dq = {"rules": {"events": {**EVENT_RULES, "on_fail": "warn"}}}
    for step in range(3):
        e.filter(F.pmod("event_id", F.lit(3)) == step).write.parquet(f"{root}/{step}")
        source = {"name": "events_src", "type": "parquet", "table": "events", "mode": "append", "params": {"path": f"{root}/{step}"}}
        last = runner.run_sources(wh, [source], dq)
    return wh.table(ledger.DQ_REPORT).filter(F.col("run_id") == last.run_id).select("table_name", "rule", "bad_rows", "total_rows", "passed")
