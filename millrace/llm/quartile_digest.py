"""Document fingerprints: a digest of the quartiles of hashed byte triplets.

The first, third and fifth byte of each window of five are hashed to one of ``BUCKETS`` buckets. Each
bucket's count is written as the quarter it falls into among the counts of the text (two bits), after
a byte of checksum and one of the logarithm of the length. Two digests differ by the sum of their
buckets' steps and their lengths', and ``BOUND`` or more, what texts without relation reach, is
likeness 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import slices, text_bytes

BUCKET_BITS = 9
BUCKETS = 1 << BUCKET_BITS
TRIPLET = (0, 2, 4)
#: Steps of the length's logarithm to a doubling, and what a step beyond the first counts.
LENGTH_STEPS, LENGTH_COST, LENGTH_BOUND = 8, 4, 64
#: Buckets of two unrelated texts lie 1.25 quarters apart on average.
BOUND = BUCKETS * 5 // 4
SLICE_BYTES = 1 << 20
#: Text bytes of a stretch of neighbouring documents, and stretches at most (then they get longer).
TASK_BYTES, MAX_TASKS = 4 << 20, 100_000
#: Null ids come first: they are ordered as the least number.
NO_ID = -(1 << 63)


def digests(raws: list[bytes]):
    """A matrix of bytes, one digest a row."""
    import zlib

    import numpy as np

    n = len(raws)
    size = np.fromiter(map(len, raws), np.int64, n)
    joined = np.frombuffer(b"".join(raws), np.uint8)
    row = np.repeat(np.arange(n, dtype=np.int64), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(joined))
    width = TRIPLET[-1] + 1
    whole = np.flatnonzero(left >= width)
    code = np.zeros(len(whole), np.uint32)
    for place in TRIPLET:
        code = (code << np.uint32(8)) | joined[whole + place]
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    cell = (row[whole] << BUCKET_BITS) + (code >> np.uint32(32 - BUCKET_BITS))
    counts = np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS)
    at = [BUCKETS * k // 4 - 1 for k in (1, 2, 3)]
    borders = np.partition(counts, at, axis=1)[:, at]
    quarter = sum((counts > borders[:, k : k + 1]).astype(np.uint8) for k in range(3))
    body = np.zeros((n, BUCKETS // 4), np.uint8)
    for k in range(4):
        body |= quarter[:, k::4] << np.uint8(2 * k)
    check = np.fromiter((zlib.crc32(x) & 255 for x in raws), np.uint8, n)
    length = np.minimum(255, np.rint(LENGTH_STEPS * np.log2(1 + size))).astype(np.uint8)
    return np.concatenate([check[:, None], length[:, None], body], axis=1)


def likeness_of(a, b):
    """From 1 for equal digests down to 0, row by row."""
    import numpy as np

    x, y = a[:, 2:], b[:, 2:]
    steps = np.zeros(len(a), np.int64)
    for k in range(4):
        one, two = (x >> np.uint8(2 * k)) & np.uint8(3), (y >> np.uint8(2 * k)) & np.uint8(3)
        steps += np.maximum(one, two).astype(np.int16).sum(axis=1) - np.minimum(one, two).astype(np.int16).sum(axis=1)
    apart = np.abs(a[:, 1].astype(np.int64) - b[:, 1])
    steps += np.minimum(LENGTH_BOUND, LENGTH_COST * np.maximum(0, apart - 1)) + (a[:, 0] != b[:, 0])
    return 1 - np.minimum(steps, BOUND) / BOUND


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint (hexadecimal) of every row.

    Null texts count as empty; a text of fewer than five bytes has no triplet, only its checksum and
    length. Equal texts have equal fingerprints. Null ids and repeated rows each get their row; an empty
    table gives none; other columns are not looked at.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raws = batch.column("raw").to_pylist()
            found = [d.tobytes().hex() for a, b in slices(raws, SLICE_BYTES) for d in digests(raws[a:b])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(text).cast("long").alias("n_chars"), text.cast("binary").alias("raw"))
    return slim.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def likeness(a: Column, b: Column) -> Column:
    """The likeness of two columns of fingerprints, null where one is null."""

    @F.pandas_udf("double")
    def compare(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import numpy as np

        for x, y in pairs:
            both = (x.notna() & y.notna()).to_numpy()
            out = np.full(len(x), np.nan)  # comes out as null
            if both.any():
                read = lambda s: np.frombuffer(bytes.fromhex("".join(s[both])), np.uint8).reshape(int(both.sum()), -1)
                out[both] = likeness_of(read(x), read(y))
            yield pd.Series(out)

    return compare(a, b)


def _stretch(doc_id: Column, borders: list[float]) -> Column:
    """How many of the ascending borders lie at or below an id: a binary search."""
    import numpy as np

    if not borders:
        return F.lit(0)
    table, n = F.lit(np.array(borders)), len(borders)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    x = doc_id.cast("double")
    found = F.aggregate(steps, F.lit(0), lambda low, s: F.when((low + s <= n) & (F.get(table, low + s - 1) <= x), low + s).otherwise(low))
    return F.when(doc_id.isNull(), 0).otherwise(found)


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows dealt so that each document stands before the next one: stretch, ahead, doc_id, raw.

    The order is ascending by doc_id, nulls first, then by a hash of the text. A stretch is a range of
    ids of about ``TASK_BYTES`` of text, and ends with a copy of the first row of the next one
    (``ahead``), the last with that of the first. Only ids and hashes are looked at to find these rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    n = min(MAX_TASKS, 1 + text_bytes(rows) // TASK_BYTES)
    borders = rows.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.5 / n) if n > 1 else []
    rows = rows.select(
        _stretch(F.col("doc_id"), sorted(set(borders))).alias("stretch"), F.coalesce("doc_id", F.lit(NO_ID)).alias("place"),
        F.xxhash64("text").alias("k_text"), "doc_id", F.col("text").cast("binary").alias("raw"))
    # One row a stretch, at most MAX_TASKS in all.
    least = rows.groupBy("stretch").agg(F.min("place").alias("place"))
    first = rows.join(F.broadcast(least), ["stretch", "place"]).groupBy("stretch", "place").agg(F.min("k_text").alias("k_text"))
    heads = rows.join(F.broadcast(first), ["stretch", "place", "k_text"]).dropDuplicates(["stretch"])
    turn = Window.orderBy("stretch")
    last = F.max("stretch").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    in_turn = first.select(F.col("stretch").alias("own"), F.coalesce(F.lag("stretch").over(turn), last).alias("before"))
    heads = heads.join(F.broadcast(in_turn), heads["stretch"] == in_turn["own"]).select(
        F.col("before").alias("stretch"), F.lit(True).alias("ahead"), "place", "k_text", "doc_id", "raw")
    every = rows.select("stretch", F.lit(False).alias("ahead"), "place", "k_text", "doc_id", "raw").unionByName(heads)
    # A stretch is a task; none shares its task with another while some have none.
    dealt = every.repartitionById(n, "stretch").sortWithinPartitions("stretch", "ahead", "place", "k_text")
    return dealt.select("stretch", "ahead", "doc_id", "raw")


def half_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of an edited one, and their likeness.

    The edited text has its last half, floor(n_chars / 2) characters, replaced by the first as many (or
    all) of the next document's; after the last document comes the first. Gives doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited (likeness of the two) and near_next
    (likeness to the next document's). A document alone is its own next one. Null texts count as
    empty, null ids come first; repeated rows each get their row, in the order of ``neighbours``.
    """

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        held: list = []  # the last row so far, which the next batch goes on from

        def rows():
            nonlocal held
            for batch in batches:
                stretch, ahead, ids, raws = (c.to_pylist() for c in batch.columns)
                for a, b in slices(raws, SLICE_BYTES):
                    yield held + list(zip(stretch[a:b], ahead[a:b], ids[a:b], raws[a:b]))
                    held = [(stretch[b - 1], ahead[b - 1], ids[b - 1], raws[b - 1])]

        for part in rows():
            own = digests([r[3] for r in part])
            texts = [r[3].decode() for r in part]
            at = np.array([k for k in range(len(part) - 1) if not part[k][1]], np.int64)
            if not len(at):
                continue
            edited = []
            for k in at.tolist():
                half = len(texts[k]) // 2
                edited.append((texts[k][: len(texts[k]) - half] + texts[k + 1][:half]).encode())
            changed = digests(edited)
            yield pa.RecordBatch.from_arrays([
                pa.array([part[k][2] for k in at.tolist()], pa.int64()), pa.array([len(texts[k]) for k in at.tolist()], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array([d.tobytes().hex() for d in own[at]]),
                pa.array([d.tobytes().hex() for d in changed]), pa.array(likeness_of(own[at], changed)),
                pa.array(likeness_of(own[at], own[at + 1])),
            ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return neighbours(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
