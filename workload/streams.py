"""Queries over the streaming forms (G1-G3); each must equal its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.plans import ledger, load
from millrace.session import scratch_dir
from millrace.streaming import ingest
from workload import SQL_NOISY_EVENTS, noisy_events, query, table, ts_text
from workload.loads import EVENT_CASTS, SQL_STAGED, loaded_events, new_warehouse, staged_events
from workload.quality import EVENT_RULES

TRIGGERS = 4  # micro-batches the landed files are read in


def landed_files(spark) -> int:
    """As many files as the session has shuffle partitions, so that they grow with the cluster."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TRIGGERS)


def landed_stream(spark, path, schema):
    return ingest.file_stream(spark, path, schema, max_files=landed_files(spark) // TRIGGERS)


@query("stream_incremental", f"""
WITH {SQL_STAGED}
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(ts) AS times
FROM (SELECT * FROM loaded UNION ALL SELECT * FROM fresh) GROUP BY 1
""")
def stream_incremental(spark, sf):
    """G1: landed files in several micro-batches, each an insert-only increment."""
    root, wh = scratch_dir(spark, "stream"), new_warehouse(spark)
    load.load(wh, "events", loaded_events(spark, sf))
    staged = staged_events(spark, sf)
    # The key decides the file, so no key is split over micro-batches with another order of arrival.
    staged.repartition(landed_files(spark), "event_id").write.parquet(f"{root}/landed")
    stream = landed_stream(spark, f"{root}/landed", staged.schema)
    run = ingest.ingest_incremental(stream, wh, "events", ["event_id"], f"{root}/checkpoint", EVENT_CASTS)
    run.awaitTermination()
    return wh.table("events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.count("ts").alias("times")
    )


@query("stream_dedupe", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value FROM events")
def stream_dedupe(spark, sf):
    """Every event twice, one of each kept; the watermark delay covers the whole month."""
    root, wh = scratch_dir(spark, "stream"), new_warehouse(spark)
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    e.unionByName(e).repartition(landed_files(spark), "event_id").write.parquet(f"{root}/landed")
    stream = landed_stream(spark, f"{root}/landed", e.schema)
    once = ingest.dedupe_stream(stream, ["event_id"], "ts", "60 days")
    ingest.append_stream(once, wh, "events", f"{root}/checkpoint").awaitTermination()
    return wh.table("events").select("event_id", ts_text("ts").alias("ts"), "event_type", "value")


@query("stream_dq", f"""
WITH {SQL_NOISY_EVENTS},
typed AS (SELECT TRY_CAST(id_raw AS BIGINT) AS id_raw, TRY_CAST(ts_raw AS TIMESTAMP) AS ts_raw,
  CASE WHEN isnan(TRY_CAST(value_raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(value_raw AS DOUBLE) END AS value_raw FROM noisy)
SELECT 'not_null(id_raw,ts_raw)' AS rule, count(*) FILTER (WHERE id_raw IS NULL OR ts_raw IS NULL) AS bad_rows, count(*) AS total_rows FROM typed
UNION ALL SELECT 'range(value_raw,0,400)', count(*) FILTER (WHERE value_raw < 0 OR value_raw > 400), count(*) FROM typed
""")
def stream_dq(spark, sf):
    """Rule counts per micro-batch, added up over the metrics table."""
    root, wh = scratch_dir(spark, "stream"), new_warehouse(spark)
    e = noisy_events(spark, sf)
    e.repartition(landed_files(spark), "event_id").write.parquet(f"{root}/landed")
    checks = [c for c in EVENT_RULES["checks"] if c.get("not_null") == ["id_raw", "ts_raw"] or c.get("range", {}).get("column") == "value_raw"]
    rules = quality.rules_for({"rules": {"events": {**EVENT_RULES, "checks": checks}}}, "events")
    stream = landed_stream(spark, f"{root}/landed", e.schema)
    ingest.quality_stream(stream, wh, "events", rules, "dq_stream", f"{root}/checkpoint").awaitTermination()
    return wh.table("dq_stream").groupBy("rule").agg(
        F.sum("bad_rows").alias("bad_rows"), F.sum("total_rows").alias("total_rows")
    )


@query("stream_dedupe_best", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value + 2 AS value FROM events
WHERE ts < (SELECT max(ts) FROM events)
""")
def stream_dedupe_best(spark, sf):
    """Every event three times, with another value each; the greatest value stays.

    The watermark passes all events but the last, which stays in the state.
    """
    root, wh = scratch_dir(spark, "stream"), new_warehouse(spark)
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    three = e.withColumn("value", F.explode(F.array(*[F.col("value") + n for n in range(3)])))
    three.repartition(landed_files(spark)).write.parquet(f"{root}/landed")

    def run():
        stream = ingest.file_stream(spark, f"{root}/landed", e.schema)
        best = ingest.dedupe_best(stream, ["event_id"], "ts", "1 microsecond", ["value desc"])
        ingest.append_stream(best, wh, "events", f"{root}/checkpoint").awaitTermination()

    run()
    return wh.table("events").select("event_id", ts_text("ts").alias("ts"), "event_type", "value")


RUN_STEPS = 4
STREAM_DQ = {"rules": {"events": {"checks": [{"not_null": ["event_id"]}, {"unique": ["event_id"]}, {"range": {"column": "value", "min": 0}}], "on_fail": "block"}}}


@query("stream_run_metrics", """
WITH n AS (SELECT event_id % 4 AS step, count(*) AS n, count(*) FILTER (WHERE event_id % 4 = 2 AND event_id % 5 = 0 AND value > 0) AS bad FROM events GROUP BY 1),
r AS (SELECT step, CASE WHEN bad = 0 THEN n ELSE 0 END AS rows_loaded, bad = 0 AS dq_pass, CASE WHEN bad = 0 THEN 0 ELSE 1 END AS violations FROM n)
SELECT step::BIGINT AS step, rows_loaded, CAST(sum(rows_loaded) OVER (ORDER BY step) AS BIGINT) AS rows_table, dq_pass, CAST(violations AS BIGINT) AS dq_violations FROM r
""")
def stream_run_metrics(spark, sf):
    """A periodic run, four times over files that land in between: audited, blocked or published, one metrics row each."""
    root, wh = scratch_dir(spark, "stream"), new_warehouse(spark)
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    source = {
        "name": "events", "type": "parquet", "table": "events", "mode": "incremental", "incremental": {"key": ["event_id"]},
        "params": {"path": f"{root}/landed", "schema": "event_id bigint, event_type string, value double"},
        "export_parquet": {"dir": f"{root}/export", "partition_by": ["event_type"], "touched_only": True},
    }
    i = F.col("event_id")
    for step in range(RUN_STEPS):
        # The third batch has values out of range; the last repeats the first, which is skipped.
        part = e.filter((i % RUN_STEPS).isin(*([0, step] if step == 3 else [step])))
        if step == 2:
            part = part.withColumn("value", F.when(i % 5 == 0, -F.col("value")).otherwise(F.col("value")))
        part.write.mode("append").parquet(f"{root}/landed")
        ingest.stream_sources(wh, [source], f"{root}/checkpoint", None, STREAM_DQ)["events"].awaitTermination()
    number = F.substring_index("run_id", "_", -1).cast("bigint")
    return ledger.metrics(wh).select(
        number.alias("step"), "rows_loaded", "rows_table", "dq_pass", F.col("dq_violations").cast("bigint").alias("dq_violations"))


@query("stream_two_sources", "SELECT event_id, event_type, value FROM events")
def stream_two_sources(spark, sf):
    """G1: two halves of the events by two streams into one table; each loads all of its rows."""
    root, wh = scratch_dir(spark, "stream"), new_warehouse(spark)
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    for half in (0, 1):
        e.filter(F.col("event_id") % 2 == half).repartition(TRIGGERS).write.parquet(f"{root}/{half}")
        stream = ingest.file_stream(spark, f"{root}/{half}", e.schema, max_files=2)
        ingest.append_stream(stream, wh, "events", f"{root}/checkpoint{half}").awaitTermination()
    return wh.table("events")
