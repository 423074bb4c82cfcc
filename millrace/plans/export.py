"""Exports (L7-L10) and reading them back."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from millrace.functions.casts import col
from millrace.plans.warehouse import Batch, Warehouse
from millrace.sources import storage


# Sources side by side share the session's views; a query is bound to them when it is made.
_VIEWS = threading.Lock()


def export_frame(
    df: DataFrame, directory: str, partition_by: Sequence[str] = (), overwrite: bool = True, clustered: bool = False
) -> str:
    """A Hive-partitioned Parquet directory.

    The rebalance hint brings the rows of a partition together, so that it gets few files, and
    lets AQE split a partition that is too large for one task. Rows that already lie together
    (``clustered``, e.g. a table loaded in time order and exported by month) need no exchange. An
    earlier export is switched for the new one once that is written; a job that fails leaves it.
    """
    spark = df.sparkSession
    if not overwrite or not storage.exists(spark, directory):
        _writer(df, partition_by, clustered).mode("overwrite" if overwrite else "errorifexists").parquet(directory)
        return directory
    aside = f"{directory.rstrip('/')}.new-{uuid.uuid4().hex[:12]}"
    try:
        _writer(df, partition_by, clustered).parquet(aside)
        storage.switch(spark, aside, directory)
    finally:
        storage.delete_tree(spark, aside)
    return directory


def _writer(df: DataFrame, partition_by: Sequence[str], clustered: bool) -> DataFrameWriter:
    out = df.hint("rebalance", *partition_by) if partition_by and not clustered else df
    return out.write.partitionBy(*partition_by) if partition_by else out.write


def export_touched(df: DataFrame, changed: DataFrame, directory: str, partition_by: Sequence[str], clustered: bool = False) -> str:
    """Of an export, only the partitions that hold rows of ``changed`` are written anew.

    ``df`` is the whole export, lazily; ``changed`` what the same query gives for the rows that came
    or went. A partition's rows must depend on table rows of that partition alone. Partitions appear
    when the job commits, so one that fails leaves the old ones; a partition without rows goes.
    """
    spark = df.sparkSession
    names = list(partition_by)
    touched = changed.select(*[col(c).alias(f"_touched_{c}") for c in names]).distinct()
    same = reduce(lambda a, b: a & b, [col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in names])
    # One row a partition, which the driver would list anyway.
    wanted = [tuple(r) for r in touched.collect()]
    if not wanted:
        return directory
    rows = df.join(F.broadcast(spark.createDataFrame(wanted, touched.schema)), same, "left_semi")
    out = rows.hint("rebalance", *names) if not clustered else rows
    out.write.partitionBy(*names).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(directory)
    left = {tuple(r) for r in rows.select(*[col(c) for c in names]).distinct().collect()}
    for gone in set(wanted) - left:
        storage.delete_tree(spark, "/".join([directory.rstrip("/"), *[storage.partition_folder(spark, n, v) for n, v in zip(names, gone)]]))
    return directory


def spark_text_types(sql: str) -> str:
    """``VARCHAR``/``TEXT`` without a length as the type of a cast, as other engines write it, is ``STRING`` here.

    Aliases, quoted names and literals stay as they are.
    """
    casts: list[bool] = []

    def one(found: re.Match) -> str:
        text = found[0]
        if text.endswith("("):
            casts.append(text != "(")
        elif text == ")":
            del casts[-1:]
        elif found["type"] and casts and casts[-1]:
            return "AS STRING"
        return text

    quoted = r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`(?:[^`]|``)*`"
    return re.sub(rf"(?i){quoted}|\b(?:TRY_)?CAST\s*\(|\(|\)|\bAS\s+(?P<type>VARCHAR|TEXT)\b(?!\s*\()", one, sql)


def query_frame(wh: Warehouse, sql: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A query over the warehouse tables it names; ``tables`` stand in for some of them."""
    with _VIEWS:
        for name in wh.tables():
            if re.search(rf"(?i)\b{re.escape(name)}\b", sql):
                (tables or {}).get(name, wh.table(name)).createOrReplaceTempView(name)
        return wh.spark.sql(spark_text_types(sql))


def export_query(
    wh: Warehouse, sql: str, directory: str, partition_by: Sequence[str] = (), overwrite: bool = True,
    clustered: bool = False,
) -> str:
    """The result of a query over the warehouse tables it names."""
    return export_frame(query_frame(wh, sql), directory, partition_by, overwrite, clustered)


def export_table(wh: Warehouse, table: str, options: Mapping, batch: Batch | None = None) -> str | None:
    """L7, L8 from an ``export_parquet`` block; without ``dir`` there is nothing to do.

    With ``touched_only`` and the ``batch`` that has just been published, only the partitions that it,
    or a batch it took the place of, has rows in are written anew.
    """
    directory = options.get("dir")
    if not directory:
        return None
    sql, partition_by = options.get("export_sql"), options.get("partition_by") or []
    clustered = bool(options.get("clustered"))

    def frame(rows: DataFrame | None = None) -> DataFrame:
        return query_frame(wh, sql, None if rows is None else {table: rows}) if sql else wh.table(table) if rows is None else rows

    part = batch is not None and options.get("touched_only") and partition_by and storage.exists(wh.spark, directory)
    if part and len(wh.batches(table)) > 1:  # else the batch is the whole table
        changed = wh.read_batch(batch)
        if batch.replaces:
            changed = changed.unionByName(wh.entries(table, batch.replaces))
        return export_touched(frame(), frame(changed), directory, partition_by, clustered)
    return export_frame(frame(), directory, partition_by, bool(options.get("overwrite", True)), clustered)


def export_all(wh: Warehouse, config: Mapping) -> dict[str, str]:
    """Every source of every group that has an export block; table to directory."""
    done = {}
    for sources in (config.get("groups") or {}).values():
        for source in sources:
            options = source.get("export_parquet")
            table = source.get("table", source.get("name"))
            if options and export_table(wh, table, options):
                done[table] = options["dir"]
    return done


def export_csv(df: DataFrame, directory: str) -> str:
    """A CSV snapshot with a header line in every part file; quotes within values are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(directory)
    return directory
