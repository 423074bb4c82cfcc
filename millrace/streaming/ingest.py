"""Streaming ingest (G1), dedupe (G2) and quality counts.

The checkpoint takes the place of a stored high-water mark. Every micro-batch is written under a
name made from the id of its query, as the checkpoint holds it, and the batch id. So a batch that is
run again after a failure is recognised and not loaded twice, while other queries into the same
table, and a query with a new checkpoint, load theirs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from millrace.functions.casts import col
from millrace.operators import quality
from millrace.operators.project import postprocess, transform
from millrace.plans.load import prepare_append, prepare_incremental
from millrace.plans.runner import run_micro_batch
from millrace.plans.spec import SourceSpec
from millrace.plans.warehouse import Warehouse
from millrace.sources import storage


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """New files of a directory; the schema is declared, as streams do not infer one."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _tag(warehouse: Warehouse, checkpoint: str, batch_id: int) -> str:
    """A name for a micro-batch: the query's id from its checkpoint, and the batch id."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    lines = storage.head_lines(warehouse.spark, [path], 1)[path]
    return f"{json.loads(lines[0])['id'].replace('-', '')}_{batch_id}"


def _start(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], every_minutes: int | None
) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    if every_minutes:
        return writer.trigger(processingTime=f"{every_minutes} minutes").start()
    return writer.trigger(availableNow=True).start()


def ingest_incremental(
    stream: DataFrame,
    warehouse: Warehouse,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    cast_map: Mapping[str, str] | None = None,
    dedupe_batch: bool = False,
    order_by: Sequence[str] | None = None,
    every_minutes: int | None = None,
) -> StreamingQuery:
    """G1: each micro-batch is an insert-only increment. Without a period: what is there, then end."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        tag = _tag(warehouse, checkpoint, batch_id)
        if not warehouse.has_batch(table, tag):
            warehouse.publish(
                prepare_incremental(warehouse, table, batch, keys, cast_map, dedupe_batch, order_by, tag=tag)
            )

    return _start(stream, checkpoint, handle, every_minutes)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], time_column: str, delay: str) -> DataFrame:
    """One row per key among rows at most ``delay`` apart; state is bounded by the watermark.

    A watermark starts at the epoch, so Spark takes event times up to 1970-01-01 for late.
    """
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(list(keys))


def dedupe_best(stream: DataFrame, keys: Sequence[str], time_column: str, delay: str, order_by: Sequence[str]) -> DataFrame:
    """P11 in a stream: of the rows of a key, no two neighbours of which are ``delay`` or more apart, the first in ``order_by``.

    The best row so far of each key is held in the state, and leaves it, as the one row of its key,
    once the watermark has passed ``delay`` after the key's last row. So the state holds the keys of
    about two delays, and a row that comes later than that is dropped. Rows with a NULL time are no
    part of a stream with event times; NULL keys are one key. ``order_by`` has terms as ``dedupe``
    takes them (``"v desc"``); further ties go by the other columns, so the outcome does not
    depend on the order of arrival.
    """
    names = stream.columns
    parts = [order_term(term) for term in order_by]
    others = [c for c in names if isinstance(stream.schema[c].dataType, _ORDERED)]
    order = F.struct(
        *[rank_of(stream, name, down).alias(f"o{i}") for i, (name, down) in enumerate(parts)],
        *[col(c).alias(f"t{i}") for i, c in enumerate(others)],
    )
    rows = stream.filter(col(time_column).isNotNull()).select(
        F.struct(*[col(c) for c in names]).alias("_row"), order.alias("_order"),
        col(time_column).alias("_time"), *[col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
    )
    held = rows.withWatermark("_time", delay).groupBy(*[f"_k{i}" for i in range(len(keys))], F.session_window("_time", delay))
    return held.agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")


# Types that can be compared, and so can break ties.
_ORDERED = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def order_term(term: str) -> tuple[str, bool]:
    """A column and whether it is descending, from ``name``, ``name asc`` or ``name desc``."""
    name, _, way = term.strip().rpartition(" ")
    if name and way.lower() in ("asc", "desc"):
        return name.strip().strip("`"), way.lower() == "desc"
    return term.strip().strip("`"), False


def rank_of(df: DataFrame, name: str, down: bool) -> Column:
    """A value whose least is the row that comes first; NULLs last, as ``dedupe`` has them."""
    c, dtype = col(name), df.schema[name].dataType
    missing = c.isNull().cast("int").alias("missing")
    if not down:
        return F.struct(missing, c.alias("value"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.struct(missing, (-F.unix_micros(c.cast("timestamp"))).alias("value"))
    if isinstance(dtype, T.DateType):
        return F.struct(missing, (-F.unix_date(c)).alias("value"))
    if isinstance(dtype, T.NumericType):
        return F.struct(missing, (-c.cast("decimal(38,18)" if isinstance(dtype, T.DecimalType) else "double" if isinstance(dtype, (T.FloatType, T.DoubleType)) else "decimal(20,0)")).alias("value"))
    raise ValueError(f"order_by {name} desc: a stream orders numbers, dates and times in descending order only")


def run_stream(
    stream: DataFrame, warehouse: Warehouse, source: SourceSpec, dq: Mapping | None, checkpoint: str, every_minutes: int | None = None
) -> StreamingQuery:
    """Each micro-batch is a run: written, audited, published or blocked, exported, with its metrics row."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_micro_batch(warehouse, source, batch, dq, _tag(warehouse, checkpoint, batch_id))

    return _start(stream, checkpoint, handle, every_minutes)


def append_stream(
    stream: DataFrame, warehouse: Warehouse, table: str, checkpoint: str, every_minutes: int | None = None
) -> StreamingQuery:
    """Append each micro-batch once, aligned to the table by name."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        tag = _tag(warehouse, checkpoint, batch_id)
        if not warehouse.has_batch(table, tag):
            warehouse.publish(prepare_append(warehouse, table, batch, tag=tag))

    return _start(stream, checkpoint, handle, every_minutes)


def quality_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    table: str,
    rules: quality.TableRules,
    metrics_table: str,
    checkpoint: str,
    every_minutes: int | None = None,
) -> StreamingQuery:
    """Rule counts of each micro-batch, appended to a metrics table."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        tag = _tag(warehouse, checkpoint, batch_id)
        if not warehouse.has_batch(metrics_table, tag):
            counts = quality.report(batch, table, rules)
            stamped = counts.select(F.lit(batch_id).cast("bigint").alias("batch_id"), *counts.columns)
            warehouse.publish(warehouse.write(metrics_table, stamped.coalesce(1), tag=tag))

    return _start(stream, checkpoint, handle, every_minutes)


# How the file sources of a spec are read as streams.
_STREAM_FORMATS = {
    "parquet": ("parquet", {}),
    # A file whose header differs from the schema is an error.
    "csv": ("csv", {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}),
    "csv_local": ("csv", {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}),
    "json": ("json", {}),
}


def stream_sources(
    warehouse: Warehouse, sources: Sequence[Mapping], checkpoint_root: str, default_minutes: int | None = 60,
    dq: Mapping | None = None,
) -> dict[str, StreamingQuery]:
    """The periodic form of a run: one query per file source, each with its own ``every_minutes``.

    Sources need ``params.schema`` and the mode ``append`` or ``incremental``; ``dedupe_on`` needs
    ``params.watermark: {column: …, delay: …}``, which bounds its state, and keeps the first row by
    ``params.order_by`` or any one. Each micro-batch is a run with audit, metrics and export. The
    checkpoint of each source keeps what has been read. ``default_minutes=None`` takes what is there and
    ends, whatever periods the sources name. Tables have one writer, so each source needs its own.
    """
    sources = list(sources)
    targets = [SourceSpec.from_dict(s).table for s in sources]
    doubled = sorted({t for t in targets if targets.count(t) > 1})
    if doubled:
        raise ValueError(f"several streams into one table: {doubled}")
    started = {}
    for spec in map(SourceSpec.from_dict, sources):
        if spec.type not in _STREAM_FORMATS or not spec.params.get("schema"):
            raise ValueError(f"source {spec.name}: a stream needs a file source with params.schema")
        if spec.mode not in ("append", "incremental"):
            raise ValueError(f"source {spec.name}: mode {spec.mode} does not stream")
        file_format, options = _STREAM_FORMATS[spec.type]
        if spec.params.get("sep"):
            options = {**options, "sep": spec.params["sep"]}
        files = file_stream(warehouse.spark, spec.params["path"], spec.params["schema"], file_format, **options)
        rows = postprocess(_streamed(files, spec), spec.post)
        where = f"{checkpoint_root.rstrip('/')}/{spec.name}"
        minutes = None if default_minutes is None else spec.every_minutes or default_minutes
        started[spec.name] = run_stream(rows, warehouse, spec, dq, where, minutes)
    return started


def _streamed(files: DataFrame, spec: SourceSpec) -> DataFrame:
    """The transform chain; its last step, the dedupe, with bounded state."""
    rows = transform(files, {k: v for k, v in spec.params.items() if k != "dedupe_on"})
    keys = spec.params.get("dedupe_on")
    if not keys:
        return rows
    mark = spec.params.get("watermark") or {}
    if not (mark.get("column") and mark.get("delay")):
        raise ValueError(f"source {spec.name}: dedupe_on in a stream needs params.watermark with column and delay")
    if spec.params.get("order_by"):
        return dedupe_best(rows, keys, mark["column"], mark["delay"], spec.params["order_by"])
    return dedupe_stream(rows, keys, mark["column"], mark["delay"])
