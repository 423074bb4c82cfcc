"""Loads (L1-L6): replace, append, upsert, insert-only increment.

Each ``prepare_*`` writes a batch and leaves publishing to the caller (who may audit it first);
``load`` does both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import cast_columns, col
from millrace.operators import joins
from millrace.operators.joins import anti_join, key_bytes, merge_rows, range_of_keys, within_range
from millrace.operators.project import dedupe
from millrace.plans.warehouse import Batch, Metrics, Warehouse

MODES = ("replace", "append", "upsert", "incremental")


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The destination's columns, by name, in its order and types; extras are dropped."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"batch lacks destination column(s): {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_converted(col(f.name), types[f.name], f.dataType).alias(f.name) for f in schema.fields])


def _converted(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """An insert's implicit conversion: fractions round, what does not convert is an error."""
    if source == target:
        return c
    if isinstance(target, T.IntegralType) and isinstance(source, (T.FloatType, T.DoubleType)):
        c = F.rint(c)
    return c.cast(target)


def _need_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"missing key column(s): {missing}")
    return list(keys)


def _any_null(keys: Sequence[str]):
    condition = col(keys[0]).isNull()
    for key in keys[1:]:
        condition = condition | col(key).isNull()
    return condition


def prepare_replace(
    wh: Warehouse, name: str, df: DataFrame, tag: str | None = None, metrics: Metrics | None = None
) -> Batch:
    """L1."""
    return wh.write(name, df, replace=True, tag=tag, metrics=metrics)


def prepare_append(
    wh: Warehouse, name: str, df: DataFrame, tag: str | None = None, metrics: Metrics | None = None
) -> Batch:
    """L2: aligned to the table by name; the table is created if absent."""
    if wh.exists(name):
        df = align(df, wh.table(name).schema)
    return wh.write(name, df, tag=tag, metrics=metrics)


def _batch_stats(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(_any_null(keys)).alias("null_key"),
        key_bytes(df, keys).alias("key_bytes"),
        *range_of_keys(df, keys),
    ]


@contextmanager
def _held(wh: Warehouse, name: str, df: DataFrame, keys: Sequence[str], stage: bool):
    """A batch that is read several times, and its statistics.

    Staged, the source is evaluated once and every pass sees the same rows, whatever happens to
    the source meanwhile; the statistics are observed on the way. Unstaged, they are one more
    scan of the key columns.
    """
    if not stage:
        yield df, df.agg(*_batch_stats(df, keys)).first().asDict()
        return
    batch = wh.stage(name, df, lambda d: _batch_stats(d, keys))
    try:
        yield wh.read_batch(batch), batch.counters
    finally:
        wh.discard(batch)


def prepare_upsert(
    wh: Warehouse,
    name: str,
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    tag: str | None = None,
    metrics: Metrics | None = None,
    stage: bool = True,
) -> Batch:
    """L3: update on a key match, else insert; NULL keys never match.

    Without keys it is a replace. Several rows for one key are an error unless ``order_by`` says
    which one counts (the first in that order), in the first load too. Only the files of the
    table that hold a key of the batch are written anew.
    """
    if not keys:
        return prepare_replace(wh, name, df, tag, metrics)
    keys = _need_keys(df, keys)
    if order_by:
        df = dedupe(df.filter(~_any_null(keys)), keys, order_by).unionByName(df.filter(_any_null(keys)))
    if not wh.exists(name):
        if order_by:
            batch = wh.write(name, df, replace=True, tag=tag, metrics=metrics)
        else:
            with _held(wh, name, df, keys, stage) as (first, _):
                _need_unique(first, keys, name)
                batch = wh.write(name, first, replace=True, tag=tag, metrics=metrics)
        batch.counters["rows_batch"] = batch.rows
        return batch
    table = wh.table(name)
    types = {f.name: f.dataType for f in table.schema.fields}
    df = align(df, T.StructType([T.StructField(c, types[c]) for c in df.columns if c in types]))
    with _held(wh, name, df, keys, stage) as (changes, stats):
        if not order_by:
            _need_unique(changes, keys, name)
        touched = _touched(wh, name, changes, keys, stats)
        if not touched:  # no key of the batch is known
            batch = wh.write(name, _filled(changes, table.schema), tag=tag, metrics=metrics)
        elif set(changes.columns) <= set(keys):  # nothing to update
            new = anti_join(changes, wh.entries(name, touched), keys, stats["key_bytes"])
            batch = wh.write(name, _filled(new, table.schema), tag=tag, metrics=metrics)
        else:
            merged = merge_rows(wh.entries(name, touched), changes, keys, stats["key_bytes"])
            batch = wh.write(name, merged, replace=touched, tag=tag, metrics=metrics)
    batch.counters["rows_batch"] = stats["total"]
    return batch


def _filled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of the table, NULL where the batch lacks one."""
    return df.select(
        *[
            (col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _touched(wh: Warehouse, name: str, changes: DataFrame, keys: Sequence[str], stats: Mapping) -> list[str]:
    """The table's files (``batch/file``, or ``batch`` for all that it has left) that hold a key of the changes: a scan of the key columns in their range.

    Keys of many bytes are not broadcast but exchanged; the files found are the same.
    """
    wanted = changes.select(*[col(k) for k in keys]).dropna("any", subset=list(keys))
    if stats["key_bytes"] <= joins.BROADCAST_KEY_BYTES:
        wanted = F.broadcast(wanted)
    table = within_range(wh.table(name), keys, stats)
    held = table.select(*[col(k) for k in keys], F.col("_metadata.file_path").alias("_file")).join(
        wanted, list(keys), "left_semi"
    )
    # One row per file comes back, of files that the driver has listed.
    parts = F.split("_file", "/")
    found = held.select(F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)).alias("entry")).distinct().collect()
    files: dict[str, set[str]] = {}
    for row in found:
        batch, _, file = unquote(row["entry"]).partition("/")
        files.setdefault(batch, set()).add(file)
    return sorted(e for batch, some in files.items() for e in wh.entry_names(name, batch, some))


def _need_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    copies = df.filter(~_any_null(keys)).groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    doubled = copies.agg(F.count_if(F.col("n") > 1).alias("doubled")).first()["doubled"]
    if doubled:
        raise ValueError(f"{doubled} key(s) occur more than once in the batch for {name}; give order_by")


def prepare_incremental(
    wh: Warehouse,
    name: str,
    staged: DataFrame,
    keys: Sequence[str],
    cast_map: Mapping[str, str] | None = None,
    dedupe_batch: bool = False,
    order_by: Sequence[str] | None = None,
    tag: str | None = None,
    metrics: Metrics | None = None,
    stage: bool = True,
) -> Batch:
    """Insert rows with a key the table has not seen; never update.

    Rows whose key is NULL after the cast are skipped. Rows of one batch that share an unseen
    key are all inserted unless ``dedupe_batch`` is set. ``counters`` has ``inserted``,
    ``skipped_null_key`` and ``skipped_dup``; the three add up to the batch.

    The batch's statistics give the range of its keys, which prunes the table scan, and their
    size, which decides how they are compared. A first load is a single pass.
    """
    if not keys:
        raise ValueError(f"incremental load of {name} needs key columns")
    casted = cast_columns(staged, cast_map)
    keys = _need_keys(casted, keys)
    if not wh.exists(name) and not dedupe_batch:
        seen = Observation()
        fresh = casted.observe(seen, *_batch_stats(casted, keys)).filter(~_any_null(keys))
        batch = wh.write(name, fresh, tag=tag, metrics=metrics)
        return _counted(batch, dict(seen.get))
    with _held(wh, name, casted, keys, stage) as (rows, stats):
        fresh = rows.filter(~_any_null(keys))
        if wh.exists(name):
            table = wh.table(name)
            same_types = all(table.schema[k].dataType == rows.schema[k].dataType for k in keys)
            fresh = align(fresh, table.schema)
            candidates = within_range(table, keys, stats) if same_types else table
            # A large batch past the end of a table, as series are loaded, needs no exchange at all.
            apart = stats["key_bytes"] > joins.BROADCAST_KEY_BYTES and candidates.isEmpty()
            if not apart:
                fresh = anti_join(fresh, candidates, keys, stats["key_bytes"])
        if dedupe_batch:
            fresh = dedupe(fresh, keys, order_by)
        return _counted(wh.write(name, fresh, tag=tag, metrics=metrics), stats)


def _counted(batch: Batch, stats: Mapping) -> Batch:
    batch.counters.update(
        inserted=batch.rows,
        skipped_null_key=stats["null_key"],
        skipped_dup=max(stats["total"] - stats["null_key"] - batch.rows, 0),
        rows_batch=stats["total"],
    )
    return batch


def prepare(
    wh: Warehouse,
    name: str,
    df: DataFrame,
    mode: str = "replace",
    keys: Sequence[str] = (),
    cast_map: Mapping[str, str] | None = None,
    order_by: Sequence[str] | None = None,
    dedupe_batch: bool = False,
    tag: str | None = None,
    metrics: Metrics | None = None,
    stage: bool = True,
) -> Batch:
    """L4: dispatch on the mode. ``stage=False`` spares a batch that is stable and cheap to read
    again, such as a Parquet scan, from being materialised first.
    """
    if mode == "replace":
        return prepare_replace(wh, name, df, tag, metrics)
    if mode == "append":
        return prepare_append(wh, name, df, tag, metrics)
    if mode == "upsert":
        return prepare_upsert(wh, name, df, keys, order_by, tag, metrics, stage)
    if mode == "incremental":
        return prepare_incremental(wh, name, df, keys, cast_map, dedupe_batch, order_by, tag, metrics, stage)
    raise ValueError(f"unknown load mode {mode!r}; use one of {MODES}")


def finish(wh: Warehouse, batch: Batch) -> Batch:
    """Publish, except that an empty batch leaves an existing table as it is."""
    if batch.rows == 0 and wh.exists(batch.table):
        wh.discard(batch)
        return batch
    return wh.publish(batch)


def load(wh: Warehouse, name: str, df: DataFrame, mode: str = "replace", **options) -> Batch:
    """Write and publish in one go."""
    return finish(wh, prepare(wh, name, df, mode, **options))
