"""What several operators share: cutting lineage, word boundaries, byte counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_dir

#: Characters between words: the space and \x09-\x0D.
GAP = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder shared by all executors and read it from there."""
    path = f"{scratch_dir(df.sparkSession, label)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP + "+", -1), "")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b), longs: node and root (the least node), linked nodes only.

    Alternating large and small stars; each round is written, so neither lineage nor the driver
    grows. A star centre with very many neighbours is a hot join key, which AQE splits, and least
    neighbours are combined before their exchange.
    """
    spark = links.sparkSession
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    star = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star.union(star.select(F.col("root").alias("node"), "root").distinct())


def id_remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % by, F.lit(-1))


def slices(raws: list, size: int):
    """Ranges of a list of texts that hold about ``size`` bytes each; a longer text is one alone at most."""
    first = held = 0
    for k, raw in enumerate(raws):
        held += len(raw)
        if held >= size:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(raws):
        yield first, len(raws)


def tidied(run):
    """``run`` over a task's batches; afterwards the memory it no longer needs goes back to the system.

    A worker waits for its next task, perhaps of another stage, beside an executor that needs the room.
    """

    def task(batches):
        import ctypes

        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return task


def least_ids(rows: DataFrame, n: int, total: int) -> DataFrame:
    """Of each group the ``n`` distinct ids with the least hashes, ``total`` rows at most: grp, doc_id, mark, h, n.

    ``rows`` has grp, doc_id (a long) and mark (a long; of an id that stands there several times the least
    one counts). Each task passes on no more than its own ``n`` of a group, each id once, so neither
    repeated rows nor a hot group make the sample or its exchange larger.
    """

    def least(batches):
        import pandas as pd
        import pyarrow as pa

        held = None
        for batch in batches:
            own = batch.to_pandas(types_mapper=pd.ArrowDtype)
            held = own if held is None else pd.concat([held, own])
            held = held.sort_values(["h", "doc_id", "mark"]).drop_duplicates(["grp", "doc_id"]).groupby("grp", dropna=False).head(n)
        if held is not None:
            yield pa.RecordBatch.from_pandas(held, preserve_index=False)

    slim = rows.select(F.col("grp").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), F.col("mark").cast("long").alias("mark"))
    slim = slim.withColumn("h", F.xxhash64("doc_id"))
    once = slim.mapInArrow(least, slim.schema).groupBy("grp", "doc_id", "h").agg(F.min("mark").alias("mark"))
    ranked = once.withColumn("n", F.row_number().over(Window.partitionBy("grp").orderBy("h", "doc_id"))).where(F.col("n") <= n)
    return ranked.orderBy("n", "grp").limit(total).select("grp", "doc_id", "mark", "h", "n")
