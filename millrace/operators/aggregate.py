"""Aggregation, last-per-group, top-k, ordering and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.casts import col
from millrace.session import scratch_dir


def count_rows(df: DataFrame, name: str = "filas") -> DataFrame:
    """A1: one row holding the row count."""
    return df.agg(F.count("*").alias(name))


def totals(df: DataFrame, key: str, measure: str | None = None) -> DataFrame:
    """A2, A3: ``key``/``total``, the sum of the measure or the row count; NULL is a group."""
    total = F.sum(col(measure)) if measure else F.count("*")
    return df.groupBy(col(key).alias("key")).agg(total.alias("total"))


def partition_counts(df: DataFrame, columns: Sequence[str], name: str = "filas") -> DataFrame:
    """A4: rows per combination of partition columns, in order."""
    return df.groupBy(*[col(c) for c in columns]).agg(F.count("*").alias(name)).orderBy(*[col(c) for c in columns])


def duplicate_probe(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A5: copies of each key and the range of a value within them."""
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.count("*").alias("n"), F.min(col(value)).alias("min_val"), F.max(col(value)).alias("max_val")
    )


def reconcile(tables: Mapping[str, DataFrame], exports: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table and of its export, their difference, and the sum over all.

    The counts of both sides are tagged, united and summed: one job for every table.
    """
    sides = []
    for column, frames in (("table_rows", tables), ("export_rows", exports)):
        for name, frame in frames.items():
            n = frame.agg(F.count("*").alias("n"))
            sides.append(n.select(
                F.lit(name).alias("table_name"),
                (F.col("n") if column == "table_rows" else F.lit(0)).cast("bigint").alias("table_rows"),
                (F.col("n") if column == "export_rows" else F.lit(0)).cast("bigint").alias("export_rows"),
            ))
    both = reduce(DataFrame.unionByName, sides)
    sums = [F.sum(c).alias(c) for c in ("table_rows", "export_rows")]
    per_table = both.groupBy("table_name").agg(*sums)
    overall = both.agg(*sums).select(F.lit("TOTAL").alias("table_name"), "table_rows", "export_rows")
    return per_table.unionByName(overall).withColumn("difference", F.col("export_rows") - F.col("table_rows"))


def last_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in the given order; each task keeps one row per group."""
    window = Window.partitionBy(*[col(g) for g in group]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def top_groups(grouped: DataFrame, k: int = 10) -> DataFrame:
    """O1: the ``k`` largest totals; NULL totals last, ties by key."""
    return grouped.orderBy(F.col("total").desc_nulls_last(), F.col("key").asc_nulls_last()).limit(k)


# Characters of a key that a group is ranked by before its text is looked up.
RANK_CHARS = 64
# Groups whose texts are fetched by a broadcast of their digests, at most.
MOST_FETCHED = 10_000


def top_long_groups(df: DataFrame, key: str, measure: str | None = None, k: int = 10) -> DataFrame:
    """A2, A3, O1 for keys of long text: what ``top_groups(totals(...))`` gives, but no text is exchanged to rank it.

    Groups are formed by a 128-bit digest and the first characters of the key, ranked by total and
    those characters with all ties, and only the keys of the groups that may be among the first ``k``
    are fetched, in a second scan. More ties than ``MOST_FETCHED`` are grouped by their whole keys.
    """
    c = col(key)
    digest = [F.xxhash64(c).alias("d1"), F.xxhash64(F.lit("second"), c).alias("d2"), F.substring(c, 1, RANK_CHARS).alias("start")]
    total = F.sum(col(measure)) if measure else F.count("*")
    grouped = df.groupBy(*digest).agg(total.alias("total"))
    ranked = grouped.withColumn("_rank", F.rank().over(Window.orderBy(F.col("total").desc_nulls_last(), F.col("start").asc_nulls_last())))
    wanted = ranked.filter(F.col("_rank") <= k).drop("_rank")
    found = wanted.limit(MOST_FETCHED + 1).collect()
    if len(found) > MOST_FETCHED:
        return top_groups(totals(df, key, measure), k)
    few = df.sparkSession.createDataFrame(found, wanted.schema)
    texts = df.select(c.alias("key"), *digest).join(
        F.broadcast(few.withColumnsRenamed({"d1": "e1", "d2": "e2", "start": "e3"})),
        (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & F.col("start").eqNullSafe(F.col("e3")))
    # Copies of a key are combined before their exchange.
    return top_groups(texts.groupBy("d1", "d2", "start", "total").agg(F.first("key").alias("key")).select("key", "total"), k)


def top_rows(df: DataFrame, column: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest value of a column."""
    return df.orderBy(col(column).desc_nulls_last(), *[col(c).asc_nulls_last() for c in tie_break]).limit(n)


def ordered(df: DataFrame, *order: Column) -> DataFrame:
    """O3: an order with explicit NULL placement, e.g. ``col("c").desc_nulls_last()``."""
    return df.orderBy(*order)


def positions(df: DataFrame, *order: Column) -> DataFrame:
    """All rows with their position (from 1) in an order, column ``position``.

    The sorted table is written once; its parts follow each other, so a row's position is its place
    in its part plus the rows of the parts before. One number per part is all that is gathered.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, 'order')}/rows"
    place = F.monotonically_increasing_id()
    part = F.shiftright(place, 33)
    df.orderBy(*order).withColumn("_part", part).withColumn("_at", place - F.shiftleft(part, 33)).write.parquet(path)
    rows = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    return rows.join(F.broadcast(parts), "_part").withColumn("position", F.col("_first") + F.col("_at") + 1).drop("_part", "_at", "_first")


def union_all(*frames: DataFrame) -> DataFrame:
    """Same columns, by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def concat_by_name(*frames: DataFrame) -> DataFrame:
    """By name, missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """U3."""
    return df.dropDuplicates(list(columns))
