"""The run ledger (R5), health records (R6) and the queries over it."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.aggregate import last_per_group
from millrace.plans.warehouse import Warehouse

RUNS = "etl_runs"
METRICS = "etl_metrics"
STATE = "etl_state"
DQ_REPORT = "etl_dq_report"

RUNS_SCHEMA = (
    "run_id string, started_at timestamp, finished_at timestamp, group_name string, status string, "
    "error string, sources_count int, rows_total bigint, duration_s double"
)
METRICS_SCHEMA = (
    "run_id string, source_name string, table_name string, rows_loaded bigint, duration_s double, "
    "dq_pass boolean, dq_violations int, loaded_at timestamp, rows_table bigint, mode string, "
    "ok boolean, error string, since_field string, since_value string"
)
DQ_REPORT_SCHEMA = (
    "run_id string, table_name string, rule string, bad_rows bigint, total_rows bigint, passed boolean"
)
STATE_SCHEMA = "source_name string, since_value string, updated_at timestamp"


def new_run_id(now: datetime) -> str:
    """Second resolution plus a random part, so that two quick runs differ."""
    return f"{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


# Sources side by side, and streams, append to the same ledger tables.
_LOCK = threading.Lock()


def append_rows(wh: Warehouse, table: str, rows: Sequence[tuple], schema: str, tag: str | None = None) -> None:
    """A few driver-side records (one per source or run) to a ledger table; those of a ``tag`` once."""
    if rows:
        fields = T.StructType.fromDDL(schema).fields
        records = [
            F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
        ]
        frame = wh.spark.range(1, numPartitions=1).select(F.inline(F.array(*records)))
        with _LOCK:
            if tag is None or not wh.has_batch(table, tag):
                wh.publish(wh.write(table, frame, tag=tag))


# A ledger table of more batches than this is written anew as one.
MOST_BATCHES = 200


def tidy(wh: Warehouse) -> None:
    """Keep what streams add, a small batch per micro-batch, from slowing down every look at the ledger."""
    for table in (METRICS, RUNS, DQ_REPORT):
        with _LOCK:
            if len(wh.batches(table)) > MOST_BATCHES:
                wh.compact(table)


def _or_empty(wh: Warehouse, table: str, schema: str) -> DataFrame:
    return wh.table(table) if wh.exists(table) else wh.spark.createDataFrame([], schema)


def runs(wh: Warehouse) -> DataFrame:
    return _or_empty(wh, RUNS, RUNS_SCHEMA)


def metrics(wh: Warehouse) -> DataFrame:
    return _or_empty(wh, METRICS, METRICS_SCHEMA)


def since_values(wh: Warehouse) -> DataFrame:
    """The last stored high-water mark of each source."""
    return last_per_group(_or_empty(wh, STATE, STATE_SCHEMA), ["source_name"], [F.col("updated_at").desc_nulls_last()])


def stored_since(wh: Warehouse, source_name: str) -> str | None:
    row = since_values(wh).filter(F.col("source_name") == source_name).select("since_value").first()
    return row["since_value"] if row else None


def recent_runs(runs_df: DataFrame, n: int = 10) -> DataFrame:
    """R7."""
    return (
        runs_df.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id").desc_nulls_last())
        .limit(n)
        .select("run_id", "started_at", "finished_at", "group_name", "status", "rows_total", "duration_s")
    )


def recent_metrics(metrics_df: DataFrame, n: int = 10, by_load_time: bool = False) -> DataFrame:
    """``3 * n`` rows by run, or ``n`` rows by load time with unknown times last."""
    tie = [F.col("source_name").asc_nulls_last(), F.col("table_name").asc_nulls_last()]
    if by_load_time:
        order, limit = [F.col("loaded_at").desc_nulls_last(), F.col("run_id").desc_nulls_last(), *tie], n
    else:
        order, limit = [F.col("run_id").desc_nulls_last(), *tie], 3 * n
    names = ["run_id", "source_name", "table_name", "rows_loaded", "dq_pass", "dq_violations", "duration_s"]
    return metrics_df.orderBy(*order).limit(limit).select(*names, *(["loaded_at"] if by_load_time else []))


def last_loads(metrics_df: DataFrame) -> DataFrame:
    """The latest load of each table, by table name."""
    order = [F.col("loaded_at").desc_nulls_last(), F.col("run_id").desc_nulls_last()]
    return (
        last_per_group(metrics_df, ["table_name"], order)
        .select("table_name", "source_name", "rows_loaded", "dq_pass", "dq_violations", "loaded_at")
        .orderBy("table_name")
    )


def last_run(runs_df: DataFrame) -> DataFrame:
    """Id, status, rows and end of the latest run."""
    return (
        runs_df.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id").desc_nulls_last())
        .limit(1)
        .select("run_id", "status", F.coalesce("rows_total", F.lit(0)).cast("bigint").alias("rows_total"), "finished_at")
    )


def run_health(runs_df: DataFrame) -> DataFrame:
    """One JSON text per run."""
    record = F.struct(
        "run_id",
        F.col("group_name").alias("group"),
        "status",
        "error",
        F.col("sources_count").alias("sources"),
        "rows_total",
        "duration_s",
        F.col("finished_at").alias("at"),
    )
    return runs_df.select("run_id", F.to_json(record, {"ignoreNullFields": "false"}).alias("health"))


def source_health(metrics_df: DataFrame) -> DataFrame:
    """One JSON text per source of a run: what was loaded, or the error."""
    loaded = F.struct(
        "ok",
        F.col("rows_loaded").alias("rows"),
        F.col("table_name").alias("table"),
        "mode",
        "since_field",
        "since_value",
        F.round("duration_s", 3).alias("t_sec"),
    )
    failed = F.struct("ok", "error", F.round("duration_s", 3).alias("t_sec"))
    options = {"ignoreNullFields": "false"}
    return metrics_df.select(
        "run_id",
        "source_name",
        F.when(F.col("ok"), F.to_json(loaded, options)).otherwise(F.to_json(failed, options)).alias("health"),
    )
