"""The registered queries: each one is a Spark callable and, beside it, the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Every query that depends on "now" uses this moment.
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
# What the incremental queries take as already loaded: rows before these moments.
EVENTS_LOADED_UNTIL = "2024-01-16 00:00:00"
ORDERS_LOADED_UNTIL = "1998-01-01 00:00:00"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its SQL if there is one."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts_text(c: Column | str) -> Column:
    """Microsecond timestamp text, as ``strftime(ts, '%Y-%m-%d %H:%M:%S.%f')`` writes it."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


SQL_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def noisy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as dirty text: missing and invalid keys and times, NaN and bad values."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        F.when(i % 97 == 0, None).when(i % 89 == 0, F.lit("INVALID")).otherwise(i.cast("string")).alias("id_raw"),
        F.when(i % 83 == 0, None).when(i % 79 == 0, F.lit("INVALID")).otherwise(ts_text("ts")).alias("ts_raw"),
        F.when(i % 73 == 0, None).when(i % 71 == 0, F.lit("NaN")).when(i % 67 == 0, F.lit("BAD"))
        .when(i % 61 == 0, F.lit("47.5")).when(i % 59 == 0, F.lit("1e3")).when(i % 53 == 0, F.lit(" 12 "))
        .otherwise(F.col("value").cast("string")).alias("value_raw"),
        "event_id", "ts", "user_id", "event_type", "value",
    )


SQL_NOISY_EVENTS = f"""
noisy AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'INVALID'
         ELSE CAST(event_id AS VARCHAR) END AS id_raw,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN 'INVALID'
         ELSE strftime(ts, {SQL_TS}) END AS ts_raw,
    CASE WHEN event_id % 73 = 0 THEN NULL WHEN event_id % 71 = 0 THEN 'NaN' WHEN event_id % 67 = 0 THEN 'BAD'
         WHEN event_id % 61 = 0 THEN '47.5' WHEN event_id % 59 = 0 THEN '1e3' WHEN event_id % 53 = 0 THEN ' 12 '
         ELSE CAST(value AS VARCHAR) END AS value_raw,
    event_id, ts, user_id, event_type, value
  FROM events)
"""


def load_all() -> None:
    """Import every module that registers queries."""
    from workload import analytics, loads, quality, rows, scans, shapes, streams  # noqa: F401
