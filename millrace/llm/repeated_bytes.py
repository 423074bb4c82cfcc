"""Repeated byte strings across documents, by suffix buckets that are refined by bucket pointers.

A byte goes when a string of ``SPAN`` bytes over it also starts in a document with a smaller id.
Nearly all strings of a corpus stand in one place only, so suffixes are not sorted everywhere:

1. Of the ``GRAM``-byte grams in every ``SPAN``-byte string the one of least hash is its anchor; equal
   strings have equal anchors. Each part of the corpus sends its distinct anchor hashes to buckets,
   which answer which of them occur in two documents (a bit each).
2. Around those anchors the parts send the distinct contexts, each with the least doc_id it has
   there, to the bucket of the anchor.
3. A bucket refines: contexts start in the buckets of their grams, which are split by the bucket
   identifiers at later offsets; the identifiers of twice the depth are used for the next split, until
   suffixes (and, leftwards, prefixes) of the anchor are told apart over the whole context. Strings
   with equal classes on both sides are equal, and the least doc_id of each is known; the bucket
   answers a bit for each string.

Messages are packed, one row for each part and bucket, and what a hundred thousand documents share is
sent once by each part. All of it is one query, in which the texts are dealt out once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_bytes

SPAN = 50
GRAM = 16
SIDE = SPAN - GRAM
WIDTH = SPAN + SIDE
#: Bytes of text in a part, and parts to a bucket.
PART_BYTES = 8 << 20
BUCKET_PARTS = 1
LEAST_BUCKETS = 16
SLICE_BYTES = 1 << 20
#: Never a byte of UTF-8.
OUTSIDE = 0xFF
LAST = (1 << 63) - 1
MESSAGE = "part int, bucket int, kind int, a binary, b binary"


def slices(raws: list[bytes]):
    first = size = 0
    for k, x in enumerate(raws):
        size += len(x) + SPAN
        if size >= SLICE_BYTES:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(raws):
        yield first, len(raws)


def lay(raws: list[bytes]):
    """Texts with ``SPAN`` outside bytes around each; where each starts."""
    import numpy as np

    gap = bytes([OUTSIDE]) * SPAN
    buffer = np.frombuffer(gap + b"".join(x + gap for x in raws), np.uint8)
    size = np.array([len(x) for x in raws], np.int64)
    return buffer, SPAN + np.cumsum(size + SPAN) - size - SPAN, size


def anchors(buffer, starts, size):
    """Anchors: position, least and greatest distance back to a string that chose it, hash, text."""
    import numpy as np

    long = size >= SPAN
    if not long.any():
        empty = np.empty(0, np.int64)
        return empty, empty, empty, np.empty(0, np.uint64), empty
    edge = np.zeros(len(buffer) + 1, np.int8)
    edge[starts[long]] += 1
    edge[starts[long] + size[long] - SPAN + 1] -= 1
    valid = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
    word = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,)).copy()
    h = word[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += word[8:]
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # The least upper half, leftmost of equals, as one number with its position.
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    n, width = SIDE + 1, 1
    while 2 * width <= n:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if n > width:
        least = np.minimum(least[: len(least) - (n - width)], least[n - width :])
    at = (least[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    end = np.concatenate((new[1:], [len(at)])) - 1
    place = at[new]
    # Chosen hashes have small upper halves; the halves change places, so that buckets are even.
    name = (h[place] << np.uint64(32)) | (h[place] >> np.uint64(32))
    return place, place - valid[end], place - valid[new], name, np.searchsorted(starts, place, "right") - 1


def _bucket(h, buckets: int):
    import numpy as np

    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(*sorted_columns):
    """Where runs of equal rows start."""
    import numpy as np

    new = np.zeros(max(0, len(sorted_columns[0]) - 1), bool)
    for c in sorted_columns:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.concatenate(([True], new))) if len(sorted_columns[0]) else np.empty(0, np.int64)


class Part:
    """The texts of a part, and what it sends."""

    def __init__(self, table, buckets: int):
        import numpy as np

        self.buckets = buckets
        self.ids = table.column("doc_id").to_pylist()
        self.order = np.array([LAST if d is None else d for d in self.ids], np.int64)
        self.raws = [x or b"" for x in table.column("raw").to_pylist()]
        self.cuts = list(slices(self.raws))
        found = [anchors(*lay(self.raws[a:b])) for a, b in self.cuts]
        self.slice_of = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        place, low, high, h, text = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(5))
        self.place, self.low, self.high, self.h = place, low, high, h.astype(np.uint64)
        base = np.array([a for a, _ in self.cuts], np.int64)
        self.doc = self.order[text + base[self.slice_of]] if len(text) else np.empty(0, np.int64)
        by = np.argsort(self.h, kind="stable")
        runs = _runs(self.h[by])
        self.distinct = self.h[by][runs]
        if len(runs):
            self.several = np.minimum.reduceat(self.doc[by], runs) != np.maximum.reduceat(self.doc[by], runs)
        else:
            self.several = np.empty(0, bool)

    def _by_bucket(self, h):
        """Bucket, first and end of each run; ``h`` is sorted, and buckets are ranges of it."""
        import numpy as np

        bucket = _bucket(h, self.buckets)
        runs = _runs(bucket)
        return zip(bucket[runs].tolist(), runs.tolist(), [*runs[1:].tolist(), len(h)])

    def hashes(self):
        import numpy as np

        for bucket, a, b in self._by_bucket(self.distinct):
            yield bucket, self.distinct[a:b].tobytes(), np.packbits(self.several[a:b]).tobytes()

    def meet(self, masks: dict[int, bytes]):
        """Keep the anchors that occur in two documents, with their contexts made distinct."""
        import numpy as np

        twice = np.zeros(len(self.distinct), bool)
        for bucket, a, b in self._by_bucket(self.distinct):
            twice[a:b] = np.unpackbits(np.frombuffer(masks[bucket], np.uint8), count=b - a).astype(bool)
        use = np.flatnonzero(twice[np.searchsorted(self.distinct, self.h)]) if len(self.h) else np.empty(0, np.int64)
        self.used = use
        context = np.empty((len(use), WIDTH + 2), np.uint8)
        for k, (a, b) in enumerate(self.cuts):
            own = np.flatnonzero(self.slice_of[use] == k)
            if len(own):
                buffer, _, _ = lay(self.raws[a:b])
                view = np.lib.stride_tricks.sliding_window_view(buffer, WIDTH)
                context[own, :WIDTH] = view[self.place[use[own]] - SIDE]
        # Bytes that no string which chose the anchor covers are blanked, so that more contexts are equal.
        at = np.arange(WIDTH)
        low, high = self.low[use][:, None], self.high[use][:, None]
        context[:, :WIDTH][(at < SIDE - high) | (at >= SIDE - low + SPAN)] = 0
        context[:, WIDTH], context[:, WIDTH + 1] = low[:, 0], high[:, 0]
        mixed = np.zeros(len(use), np.uint64)
        padded = np.zeros((len(use), -(-(WIDTH + 2) // 8) * 8), np.uint8)
        padded[:, : WIDTH + 2] = context
        for word in padded.view("<u8").T:
            mixed = (mixed ^ word) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(31)
        # By anchor hash, then by a second hash, of the context: together 128 bits.
        by = np.lexsort((mixed, self.h[use]))
        runs = _runs(self.h[use][by], mixed[by])
        self.group = np.empty(len(use), np.int64)
        self.group[by] = np.repeat(np.arange(len(runs)), np.diff(np.concatenate((runs, [len(by)]))))
        self.context = context[by[runs]]
        self.context_hash = self.h[use][by[runs]]
        self.least = np.minimum.reduceat(self.doc[use][by], runs) if len(runs) else np.empty(0, np.int64)

    def contexts(self):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for bucket, a, b in self._by_bucket(self.context_hash):
            yield bucket, pack(self.context[a:b].tobytes()), self.least[a:b].astype("<i8").tobytes()

    def spans(self, answers: dict[int, bytes]):
        """Of each text the starts and ends of its maximal removed runs."""
        import numpy as np

        bits = np.zeros(len(self.context_hash), np.uint64)
        for bucket, a, b in self._by_bucket(self.context_hash):
            bits[a:b] = np.frombuffer(answers[bucket], "<u8")
        use, group = self.used, self.group
        place, low, high, doc = self.place[use], self.low[use], self.high[use], self.doc[use]
        later = doc > self.least[group]
        for k, (a, b) in enumerate(self.cuts):
            size = np.array([len(x) for x in self.raws[a:b]], np.int64)
            starts = SPAN + np.cumsum(size + SPAN) - size - SPAN
            cover = np.zeros(int(SPAN + (size + SPAN).sum()) + 1, np.int32)
            own = self.slice_of[use] == k
            whole = own & later
            np.add.at(cover, place[whole] - high[whole], 1)
            np.add.at(cover, place[whole] - low[whole] + SPAN, -1)
            some = np.flatnonzero(own & ~later & (bits[group] != 0))
            for t in range(SIDE + 1):
                hit = some[(bits[group[some]] >> np.uint64(t)) & np.uint64(1) == 1]
                np.add.at(cover, place[hit] - t, 1)
                np.add.at(cover, place[hit] - t + SPAN, -1)
            gone = np.cumsum(cover) > 0
            change = np.diff(gone.astype(np.int8), prepend=0)
            first, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
            text = np.searchsorted(starts, first, "right") - 1
            bounds = np.searchsorted(text, np.arange(b - a + 1))
            for i in range(b - a):
                x, y = bounds[i], bounds[i + 1]
                yield (first[x:y] - starts[i]).tolist(), (end[x:y] - starts[i]).tolist()


def rank(keys):
    """Bucket identifiers in the order of the keys."""
    import numpy as np

    return np.unique(keys, return_inverse=True)[1]


def refine(rows):
    """Bucket identifiers of rows of bytes in lexicographic order, refined to their whole length."""
    import numpy as np

    n = np.uint64(max(1, len(rows)))
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    ids = [rank(column.astype(np.uint64)) for column in padded.view(">u8").T]
    while len(ids) > 1:
        deeper = [rank(a.astype(np.uint64) * n + b.astype(np.uint64)) for a, b in zip(ids[::2], ids[1::2])]
        ids = deeper + ids[len(ids) - len(ids) % 2 :]
    return ids[0]


class Classes:
    """Classes of rows of bytes that agree in their first ``depth`` bytes, for any depth."""

    def __init__(self, rows):
        import numpy as np

        self.order = np.argsort(refine(rows), kind="stable")
        ordered = rows[self.order]
        apart = ordered[1:] != ordered[:-1]
        common = np.where(apart.any(axis=1), apart.argmax(axis=1), rows.shape[1])
        self.common = np.concatenate(([0], common))
        self.size = len(rows)

    def at(self, depth: int):
        import numpy as np

        out = np.empty(self.size, np.uint64)
        new = self.common < depth
        new[:1] = False
        out[self.order] = np.cumsum(new)
        return out


def judge(context, least):
    """A number for each context: bit t if the string t before its anchor stands in a smaller document."""
    import numpy as np

    right = Classes(np.ascontiguousarray(context[:, SIDE:WIDTH]))
    left = Classes(np.ascontiguousarray(context[:, :SIDE][:, ::-1]))
    low, high = context[:, WIDTH], context[:, WIDTH + 1]
    bits, n = np.zeros(len(context), np.uint64), np.uint64(max(1, len(context)))
    for t in range(SIDE + 1):
        use = np.flatnonzero((low <= t) & (t <= high))
        if len(use) < 2:
            continue
        key = (left.at(t) * n + right.at(SPAN - t))[use]
        by = np.argsort(key, kind="stable")
        runs = _runs(key[by])
        least_of = np.repeat(np.minimum.reduceat(least[use][by], runs), np.diff(np.concatenate((runs, [len(by)]))))
        bits[use[by]] |= (least_of < least[use][by]).astype(np.uint64) << np.uint64(t)
    return bits


def _message(rows, kind: int, part: int):
    import pyarrow as pa

    rows = list(rows)
    n = len(rows)
    return pa.table({
        "part": pa.array([part] * n, pa.int32()), "bucket": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([kind] * n, pa.int32()),
        "a": pa.array([r[1] for r in rows], pa.binary()), "b": pa.array([r[2] for r in rows], pa.binary()),
    })


def _answer_hashes(table):
    """Which hashes occur in two parts, or in two documents of one."""
    import numpy as np
    import pyarrow as pa

    sent = [np.frombuffer(x, np.uint64) for x in table.column("a").to_pylist()]
    size = [len(x) for x in sent]
    several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table.column("b").to_pylist(), size)]).astype(bool)
    h = np.concatenate(sent)
    by = np.argsort(h, kind="stable")
    runs = _runs(h[by])
    n = np.diff(np.concatenate((runs, [len(by)])))
    twice = np.empty(len(h), bool)
    twice[by] = np.repeat((n > 1) | np.logical_or.reduceat(several[by], runs), n)
    ends = np.cumsum(size)
    masks = [np.packbits(twice[e - n : e]).tobytes() for e, n in zip(ends.tolist(), size)]
    return pa.table({"part": table.column("part"), "bucket": table.column("bucket"), "kind": pa.array([0] * len(masks), pa.int32()),
                     "a": pa.array(masks, pa.binary()), "b": pa.nulls(len(masks), pa.binary())})


def _answer_contexts(table):
    import numpy as np
    import pyarrow as pa

    import zstandard

    least = [np.frombuffer(x, "<i8") for x in table.column("b").to_pylist()]
    size = [len(x) for x in least]
    ends = np.cumsum(size)
    context = np.empty((ends[-1], WIDTH + 2), np.uint8)
    unpack = zstandard.ZstdDecompressor().decompress
    for x, e, n in zip(table.column("a"), ends.tolist(), size):
        context[e - n : e] = np.frombuffer(unpack(x.as_py()), np.uint8).reshape(n, WIDTH + 2)
    bits = judge(context, np.concatenate(least)).astype("<u8")
    out = [bits[e - n : e].tobytes() for e, n in zip(ends.tolist(), size)]
    return pa.table({"part": table.column("part"), "bucket": table.column("bucket"), "kind": pa.array([1] * len(out), pa.int32()),
                     "a": pa.array(out, pa.binary()), "b": pa.nulls(len(out), pa.binary())})


def _of_kind(table, kind: int) -> dict[int, bytes]:
    return {r["bucket"]: r["a"] for r in table.select(["bucket", "kind", "a"]).to_pylist() if r["kind"] == kind}


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start and length of the removed runs) and kept (the bytes left).

    Texts are UTF-8 bytes; null texts are empty. Null ids count as greater than all others. Rows with
    equal ids are one document as to order: neither makes the other lose a byte, and each has its own
    row. Texts shorter than ``SPAN`` bytes lose nothing. Other columns are not looked at.
    """
    parts = 1 + text_bytes(docs) // PART_BYTES
    buckets = max(1, min(parts, LEAST_BUCKETS), parts // BUCKET_PARTS)
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int").alias("part"),
    ).repartition(parts, "part")

    def send_hashes(table):
        return _message(Part(table, buckets).hashes(), 0, table.column("part")[0].as_py())

    def send_contexts(left, right):
        if not left.num_rows:
            return _message([], 1, 0)
        own = Part(left, buckets)
        own.meet(_of_kind(right, 0))
        return _message(own.contexts(), 1, left.column("part")[0].as_py())

    def finish(left, right):
        import numpy as np
        import pyarrow as pa

        own = Part(left, buckets)
        own.meet(_of_kind(right, 0))
        spans, kept = [], []
        for raw, (first, end) in zip(own.raws, own.spans(_of_kind(right, 1))):
            spans.append([{"start": a, "length": b - a} for a, b in zip(first, end)])
            kept.append(b"".join(raw[a:b] for a, b in zip([0, *end], [*first, len(raw)])))
        return pa.table({
            "doc_id": pa.array(own.ids, pa.int64()), "n_bytes": pa.array(np.array([len(x) for x in own.raws], np.int64)),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), "kept": pa.array(kept, pa.binary()),
        })

    masks = dealt.groupBy("part").applyInArrow(send_hashes, MESSAGE).groupBy("bucket").applyInArrow(_answer_hashes, MESSAGE)
    bits = (
        dealt.groupBy("part").cogroup(masks.groupBy("part")).applyInArrow(send_contexts, MESSAGE)
        .groupBy("bucket").applyInArrow(_answer_contexts, MESSAGE)
    )
    answers = masks.unionByName(bits)
    return dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        finish, "doc_id long, n_bytes long, spans array<struct<start:bigint,length:bigint>>, kept binary")
