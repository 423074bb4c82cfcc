"""Packing by minimum bin slack.

Documents become token ids, cut every ``size`` ids. How the pieces are packed depends only on how
many there are of each length, at most ``size`` numbers whatever the corpus, so the plan is made from
these: the longest piece left opens a sequence, a bitset of subset sums over the remaining multiset
of lengths finds the fill closest to the capacity, its counts are traced back, and the same fill is
used as often as the lengths last. Every piece then finds its place by its rank among its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.llm.common import cut, tidied

SIZE = 1024
ID_BYTES = 4
#: For the last stage of a pipeline, in executors whose heap has grown to its limit: fewer stretches that a
#: worker remembers, and fewer bytes of texts that it works on at a time. That takes more CPU.
SPARING = {"remembered": 400_000, "at_a_time": 2_000_000}
#: Pieces of one length that are ranked by one task at a time, on average.
RANK_ROWS = 200_000
PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary"


def _piece_batches(path: str, size: int, remembered: int = tokens.REMEMBERED, at_a_time: int = tokens.SLICE_BYTES):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        enc = tokens.encoder(path, remembered)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in tokens.slices(texts, at_a_time):
                ids, counts = enc.encode(texts[a:b])
                rows = ([], [], [], [], [])
                at = 0
                raw = ids.astype("<u4").tobytes()
                for doc, n in zip(doc_ids[a:b], counts.tolist()):
                    for start in range(0, n, size):
                        length = min(size, n - start)
                        first = ID_BYTES * (at + start)
                        for col, v in zip(rows, (doc, start, length, n, raw[first : first + ID_BYTES * length])):
                            col.append(v)
                    at += n
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[0], pa.int64()), pa.array(np.array(rows[1], np.int64)), pa.array(np.array(rows[2], np.int32)),
                    pa.array(np.array(rows[3], np.int64)), pa.array(rows[4], pa.binary()),
                ], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, **memory: int) -> DataFrame:
    """Documents as ids with the end id, cut every ``size`` ids; ids are little-endian 32-bit. ``memory``: see ``SPARING``."""
    run = _piece_batches(tokenizer or tokens.default_tokenizer(), size, **memory)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), PIECES)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths with the greatest sum up to ``room``, as counts by length."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << length * take) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    fill: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            fill[length] = fill.get(length, 0) + take
            total -= length * take
    return fill


def plan(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Fills (count by length) and how often each is used, until all lengths are used up."""
    left, fills = {k: n for k, n in counts.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        fill = best_fill(left, size - longest)
        left[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        times = min(left[k] // n for k, n in fill.items())
        for k, n in fill.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        fills.append((fill, times))
    return fills


def _places(fills) -> list[tuple[int, list[tuple[int, int, int, int, int]]]]:
    """Of each length: ranks from, up to, first sequence, count in a sequence, offset there."""
    used: dict[int, int] = {}
    found: dict[int, list] = {}
    sequence = 0
    for fill, times in fills:
        offset = 0
        for length in sorted(fill, reverse=True):
            first, n = used.get(length, 0), fill[length]
            found.setdefault(length, []).append((first, first + n * times, sequence, n, offset))
            used[length] = first + n * times
            offset += n * length
        sequence += times
    return sorted(found.items())


def pack(found: DataFrame, size: int = SIZE) -> DataFrame:
    """Places of pieces: their columns but ids, ids_crc32, sequence_id and offset.

    ``found`` is a written table of ``pieces``. Sequences count from zero; a sequence that is not
    full is padded by the reader. Null texts are documents of the end id alone; null doc_ids and
    repeated rows are packed like any others, and equal pieces take places in any order, which
    gives the same table. Without documents there are no sequences.
    """
    spark = found.sparkSession
    slim = found.select("doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"))
    per_length = slim.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in per_length.collect()}  # at most ``size`` rows
    shares = 1 + sum(counts.values()) // RANK_ROWS
    slim = slim.withColumn("share", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares)))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slim.groupBy("length", "share").count().select(
        "length", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("rank0"))
    within = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = slim.withColumn("n", F.row_number().over(within)).join(offsets, ["length", "share"]).withColumn(
        "rank", F.col("rank0") + F.col("n") - 1)
    # A row per length: bounded by the size of a sequence, so it may be broadcast.
    places = spark.createDataFrame(
        _places(plan(counts, size)),
        "length int, fills array<struct<first:bigint,upto:bigint,sequence:bigint,n:int,offset:int>>")
    placed = ranked.join(F.broadcast(places), "length").withColumn(
        "f", F.element_at(F.filter("fills", lambda f: f["upto"] > F.col("rank")), 1))
    k = F.col("rank") - F.col("f.first")
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("f.sequence") + F.floor(k / F.col("f.n"))).cast("long").alias("sequence_id"),
        (F.col("f.offset") + F.pmod(k, F.col("f.n").cast("long")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, **memory: int) -> tuple[DataFrame, DataFrame]:
    """Places (see ``pack``) and the written pieces with their ids, which share doc_id, start and crc."""
    found = cut(pieces(docs, tokenizer, size, **memory), "pieces")
    return pack(found, size), found


def sequences(places: DataFrame, found: DataFrame) -> DataFrame:
    """sequence_id, length and ids of every sequence, its pieces joined by offset (at most the size)."""
    key = ["doc_id", "start", "ids_crc32"]
    ids = found.select("doc_id", "start", F.crc32("ids").alias("ids_crc32"), "ids").dropDuplicates(key)
    on = [places[c].eqNullSafe(ids[c]) for c in key]
    whole = places.join(ids, on).select("sequence_id", F.struct("offset", "ids").alias("p"), "length")
    packed = whole.groupBy("sequence_id").agg(F.sort_array(F.collect_list("p")).alias("p"), F.sum("length").alias("length"))
    return packed.select("sequence_id", "length", F.aggregate(F.transform("p", lambda x: x["ids"]), F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)).alias("ids"))
