"""Benchmark decontamination: windows near a benchmark item, by CGK embedding and bit sampling.

Texts and items are word sequences. A random walk (CGK) copies a window's words to three times its
length, staying on or leaving each word by a random bit of word and step, so that windows at a small
edit distance agree in most coordinates. Tables keyed by a few sampled coordinates, over several
walks, find the items a window may be near; the exact edit distance decides.

Walks drift apart with the number of edits, so a long item stands in the tables as parts of at most
``PART`` words. Of a passage within the item's budget some part is within its own, being the same
share of its words; the whole item is then compared exactly.

Which item-sized windows are embedded is settled by the q-gram lemma: a window within ``e`` edits of
an item of ``n`` words holds at least ``n - q + 1 - q e`` of its word q-grams, so others cannot pass.
"""

from __future__ import annotations

import unicodedata
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, tidied

#: A passage contaminates when its edit distance is at most this share of the item's words.
DISTANCE = 0.2
#: Shorter items are matched word for word; by themselves they are no evidence for ``decontaminate``.
MIN_WORDS = 5
GRAM = 3
#: Words of a part of a long item at most.
PART = 60
WALKS, TABLES, COORDINATES = 16, 6, 3
#: Bytes of benchmark items held by a task at a time; a longer benchmark is searched block by block.
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 8 << 20
#: Candidates whose distances are worked out together.
PAIRS = 4096
#: Scripts written without spaces, by the names of their characters; each character is a word.
UNSPACED = (
    "CJK UNIFIED", "CJK COMPATIBILITY IDEOGRAPH", "IDEOGRAPHIC", "HIRAGANA", "KATAKANA", "HALFWIDTH KATAKANA", "BOPOMOFO",
    "THAI ", "LAO ", "KHMER ", "MYANMAR ", "TIBETAN ", "TAI ", "NEW TAI LUE ", "JAVANESE ", "BALINESE ", "YI ",
)


class _Classes(dict):
    """What stands for a character of a text that is not all ASCII, by its number."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = unicodedata.category(c)
        if code < 128:
            out = c
        elif kind[0] in "ZPS" or kind == "Cc" or kind == "Cf" and code not in (0xAD, 0x200C, 0x200D):
            out = " "
        else:
            out = f" {c} " if unicodedata.name(c, "").startswith(UNSPACED) else c
        self[code] = out
        return out


_CLASSES = _Classes()
#: Everything but letters, digits and bytes of other alphabets stands between words.
_CLEAN = bytes(c if c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 else 32 for c in range(256))


def words(raw: bytes | None) -> list[bytes]:
    """Runs of letters, digits and marks of any alphabet, A-Z lower-cased."""
    raw = raw or b""
    if not raw.isascii():
        raw = raw.decode("utf-8", "replace").translate(_CLASSES).encode()
    return raw.lower().translate(_CLEAN).split()


def budget(n: int) -> int:
    return int(DISTANCE * n + 1e-9)


def edit_distance(item, text) -> int:
    """Least edits (words) from ``item`` to any stretch of ``text``."""
    import numpy as np

    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, w in enumerate(item):
        new = np.empty_like(row)
        new[0] = k + 1
        new[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def edit_distances(items, texts):
    """Least edits of each item (a row of word ids) to any stretch of the text in the same row.

    Texts are of one length, filled up with ids that are in no item; that changes no distance, as
    setting an item's word against such an id costs as much as leaving the word out.
    """
    import numpy as np

    texts = np.ascontiguousarray(texts.T)
    steps = np.arange(len(texts) + 1, dtype=np.int32)[:, None]
    row = np.zeros((len(texts) + 1, texts.shape[1]), np.int32)
    for k in range(items.shape[1]):
        new = np.empty_like(row)
        new[0] = k + 1
        new[1:] = np.minimum(row[:-1] + (texts != items[:, k]), row[1:] + 1)
        row = np.minimum.accumulate(new - steps, axis=0) + steps
    return row.min(axis=0)


class Index:
    """Vocabulary, grams and LSH tables of a block of items, and the codes of short ones.

    ``items`` are parts, most of them whole: part k is that of ``wholes[owner[k]]`` from word
    ``offset[k]`` on.
    """

    def __init__(self, items: list[tuple[int, bytes]]):
        import numpy as np

        self.vocabulary: dict[bytes, int] = {}
        found = sorted((i, words(raw)) for i, raw in items)
        for _, w in found:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        coded = [(i, np.array([self.vocabulary[x] for x in w], np.int64)) for i, w in found if w]
        # Words of short items, by their number: names and, sorted by their codes, the words themselves.
        self.short = {}
        for n in range(1, MIN_WORDS):
            own = [(i, x) for i, x in coded if len(x) == n]
            if own:
                table = np.stack([x for _, x in own])
                code = self._codes(table.T)
                order = np.argsort(code, kind="stable")
                self.short[n] = code[order], table[order], [own[k][0] for k in order.tolist()]
        coded = [(i, x) for i, x in coded if len(x) >= MIN_WORDS]
        self.names = [i for i, _ in coded]
        self.wholes = [x for _, x in coded]
        self.items, owner, offset = [], [], []
        for k, x in enumerate(self.wholes):
            n = -(-len(x) // PART)
            edges = [len(x) * j // n for j in range(n + 1)]
            for a, b in zip(edges, edges[1:]):
                self.items.append(x[a:b])
                owner.append(k)
                offset.append(a)
        self.owner, self.offset = np.array(owner, np.int64), np.array(offset, np.int64)
        self.size = np.array([len(x) for x in self.items], np.int64)
        self.edits = np.array([budget(len(x)) for x in self.items], np.int64)
        self.v = np.int64(len(self.vocabulary) + 1)
        # Items too short for the lemma with the usual grams take shorter ones.
        self.grams = {}
        for q in range(GRAM, 0, -1):
            own = [k for k, x in enumerate(self.items) if self._q(k) == q]
            if own:
                key = np.concatenate([self._gram(self.items[k], q) for k in own])
                item = np.concatenate([np.full(len(self.items[k]) - q + 1, k) for k in own])
                at = np.concatenate([np.arange(len(self.items[k]) - q + 1) for k in own])
                order = np.argsort(key, kind="stable")
                self.grams[q] = key[order], item[order], at[order]
        rng = np.random.default_rng(7)
        # Coordinates as parts of the walk's length, so that each window size has its own.
        self.spots = rng.random((WALKS, TABLES, COORDINATES))
        self.seeds = rng.integers(1, 1 << 62, WALKS)
        keys, item = [], []
        for n in np.unique(self.size):
            own = np.flatnonzero(self.size == n)
            k = self.keys(np.stack([self.items[o] for o in own]))
            keys.append(k.ravel())
            item.append(np.repeat(own, k.shape[1]))
        self.table = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        self.table_item = np.concatenate(item) if item else np.empty(0, np.int64)
        order = np.argsort(self.table, kind="stable")
        self.table, self.table_item = self.table[order], self.table_item[order]

    @staticmethod
    def _codes(columns):
        """A hash of each row of word ids, given by columns."""
        import numpy as np

        out = np.zeros(len(columns[0]), np.uint64)
        for x in columns:
            out = (out ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return out

    def _exact(self, ids, bounds):
        """(text, name) of every short item whose words stand in a text."""
        import numpy as np

        for n, (code, table, names) in self.short.items():
            if len(ids) < n:
                continue
            columns = [ids[k : len(ids) - n + 1 + k] for k in range(n)]
            seen = self._codes(columns)
            lo, hi = np.searchsorted(code, seen, "left"), np.searchsorted(code, seen, "right")
            count = hi - lo
            hit = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            where = np.repeat(np.arange(len(seen)), count)
            same = np.ones(len(hit), bool)
            for k in range(n):
                same &= columns[k][where] == table[hit, k]
            text = np.searchsorted(bounds, where[same], "right")
            for pair in np.unique(text * len(names) + hit[same]).tolist():
                yield pair // len(names), names[pair % len(names)]

    def _q(self, k: int) -> int:
        """The longest gram of which a near window must hold one."""
        n, e = int(self.size[k]), int(self.edits[k])
        return next(q for q in range(GRAM, 0, -1) if n - q + 1 - q * e >= 1 or q == 1)

    def _gram(self, ids, q: int):
        out = ids[: len(ids) - q + 1].copy()
        for k in range(1, q):
            out = out * self.v + ids[k : len(ids) - q + 1 + k]
        return out

    def keys(self, windows):
        """Keys (windows by tables) of windows of one size."""
        import numpy as np

        m, n = windows.shape
        length = 3 * n
        # All walks go on together, a column each. They have left most windows after twice the size, so
        # that later coordinates would be blank for all.
        spots = np.sort((self.spots * 2 * n).astype(int), axis=2).reshape(WALKS, -1)
        padded = np.concatenate([windows, np.zeros((m, 1), np.int64)], axis=1).astype(np.uint64)
        rows, at = np.arange(m)[:, None], np.zeros((m, WALKS), np.int64)
        read = np.empty((m, WALKS, TABLES * COORDINATES), np.uint64)
        seeds = self.seeds.astype(np.uint64)[None, :]
        for j in range(length):
            word = padded[rows, at]
            walk, spot = np.nonzero(spots == j)
            read[:, walk, spot] = word[:, walk]
            mixed = (word * np.uint64(0x9E3779B97F4A7C15) + np.uint64((j + 1) * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)) ^ seeds
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            at = np.minimum(at + (mixed >> np.uint64(63)).astype(np.int64), n)
        table = np.arange(WALKS * TABLES, dtype=np.uint64).reshape(1, WALKS, TABLES)
        key = np.broadcast_to((table + np.uint64(n * 1000)) * np.uint64(0xD6E8FEB86659FD93), (m, WALKS, TABLES)).copy()
        for k in range(COORDINATES):
            key = (key ^ read[:, :, k::COORDINATES]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        return key.reshape(m, -1)

    def windows(self, ids, bounds):
        """(item size, first word) of windows that hold enough grams of an item of that size.

        ``ids`` are the words of several texts, a zero after each; ``bounds`` are their ends.
        """
        import numpy as np

        made = []
        for q, (key, item, place) in self.grams.items():
            if len(ids) < q:
                continue
            known = ids > 0
            full = known[: len(ids) - q + 1].copy()
            for k in range(1, q):
                full &= known[k : len(ids) - q + 1 + k]
            at = np.flatnonzero(full)
            code = ids[at]
            for k in range(1, q):
                code = code * self.v + ids[at + k]
            lo, hi = np.searchsorted(key, code, "left"), np.searchsorted(key, code, "right")
            n = hi - lo
            hit = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            where, which, inner = np.repeat(at, n), item[hit], place[hit]
            text = np.searchsorted(bounds, where, "right")
            order = np.lexsort((where, which, text))
            where, which, inner, text = where[order], which[order], inner[order], text[order]
            # Grams of a text count once at a place, though an item may hold one twice.
            new = np.concatenate(([True], (where[1:] != where[:-1]) | (which[1:] != which[:-1])))[: len(where)]
            nth = np.cumsum(new)
            need = self.size[which] - q + 1 - q * self.edits[which]
            # The place that is ``need`` places on, of the same text and item, within one window.
            firsts = np.flatnonzero(new)
            goal = nth + np.maximum(need, 1) - 2
            far = firsts[np.minimum(goal, len(firsts) - 1)] if len(firsts) else goal
            near = (goal < len(firsts)) & (which[far] == which) & (text[far] == text)
            near &= where[far] - where <= self.size[which] + self.edits[which] - q
            # All places of such a stretch may start a window on their diagonal.
            cover = np.zeros(len(where) + 1, np.int64)
            np.add.at(cover, np.flatnonzero(near), 1)
            np.add.at(cover, far[near] + 1, -1)
            use = np.cumsum(cover[:-1]) > 0
            made.append(np.stack([self.size[which[use]], where[use] - inner[use], text[use]], axis=1))
        return np.unique(np.concatenate(made), axis=0) if made else np.empty((0, 3), np.int64)

    def _verify(self, ids, first, text, item, starts, bounds):
        """Texts, items, distances and first words of the pairs within the budget; the items are of one size."""
        import numpy as np

        n, e = int(self.size[item[0]]), int(self.edits[item[0]])
        at = first[:, None] + np.arange(-e, n + e)[None, :]
        inside = (at >= starts[text][:, None]) & (at < bounds[text][:, None] - 1)
        near = np.where(inside, ids[np.clip(at, 0, len(ids) - 1)], 0)
        d = edit_distances(np.stack([self.items[k] for k in item.tolist()]), near)
        ok = d <= e
        return text[ok].tolist(), item[ok].tolist(), d[ok].tolist(), first[ok].tolist()

    def _whole(self, ids, spots, starts, bounds):
        """Texts, items and distances of long items near the places (text, item, step) their parts were met.

        A step is as long as the item's edits, so a passage is within a few of them of its step.
        """
        import numpy as np

        for text, k, step in sorted(spots):
            item = self.wholes[k]
            e = budget(len(item))
            first = step * (e + 1) - e - PART
            a, b = max(first, int(starts[text])), min(first + len(item) + 3 * e + 2 * PART + 1, int(bounds[text]) - 1)
            d = int(edit_distances(item[None, :], ids[None, a : max(a, b)])[0]) if b > a else len(item)
            if d <= e:
                yield text, k, d

    def search(self, raws: list[bytes | None]) -> list[dict[int, int]]:
        """Of each text, the items near a passage of it and their distances."""
        import numpy as np

        found: list[dict[int, int]] = [{} for _ in raws]
        if not self.vocabulary:
            return found
        parts, ends, total = [], [], 0
        get = self.vocabulary.get
        for raw in raws:
            w = words(raw)
            parts.append(np.fromiter(map(get, w, repeat(0)), np.int64, len(w)))
            parts.append(np.zeros(1, np.int64))
            total += len(w) + 1
            ends.append(total)
        ids, bounds = np.concatenate(parts), np.array(ends)
        starts = np.concatenate(([0], bounds[:-1]))
        for doc, name in self._exact(ids, bounds):
            found[doc][name] = 0
        windows = self.windows(ids, bounds)
        spots = set()
        for n in np.unique(windows[:, 0]):
            first, text = windows[windows[:, 0] == n][:, 1:].T
            for a in range(0, len(first), 4096):
                f, t = first[a : a + 4096], text[a : a + 4096]
                at = f[:, None] + np.arange(n)[None, :]
                inside = (at >= starts[t][:, None]) & (at < bounds[t][:, None] - 1)
                window = np.where(inside, ids[np.clip(at, 0, len(ids) - 1)], 0)
                key = self.keys(window)
                lo, hi = np.searchsorted(self.table, key, "left"), np.searchsorted(self.table, key, "right")
                count = (hi - lo).ravel()
                hit = np.repeat(lo.ravel() - (np.cumsum(count) - count), count) + np.arange(count.sum())
                window_of = np.repeat(np.arange(count.size) // lo.shape[1], count)
                same = self.size[self.table_item[hit]] == n
                pairs = np.unique((window_of * len(self.items) + self.table_item[hit])[same])
                for c in range(0, len(pairs), PAIRS):
                    x, i = np.divmod(pairs[c : c + PAIRS], len(self.items))
                    for doc, item, d, at in zip(*self._verify(ids, f[x], t[x], i, starts, bounds)):
                        k = int(self.owner[item])
                        if len(self.wholes[k]) > PART:
                            spots.add((doc, k, (at - int(self.offset[item])) // (budget(len(self.wholes[k])) + 1)))
                            continue
                        name = self.names[k]
                        found[doc][name] = min(d, found[doc].get(name, d))
        for doc, k, d in self._whole(ids, spots, starts, bounds):
            name = self.names[k]
            found[doc][name] = min(d, found[doc].get(name, d))
        return found


_INDEXES: dict[tuple, Index] = {}


def index_of(items) -> Index:
    """The index of a block; a worker keeps the last one for its next tasks."""
    key = tuple(items)
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(items)
    return _INDEXES[key]


def _slices(raws):
    first = size = 0
    for k, x in enumerate(raws):
        size += len(x or b"")
        if size >= SLICE_BYTES:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(raws):
        yield first, len(raws)


def blocks(benchmark: DataFrame):
    """The items (item_id, text) as lists of at most about ``BLOCK_BYTES``; null ids and texts are none."""
    real = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("raw"))
    n = 1 + (real.agg(F.sum(F.length("raw"))).first()[0] or 0) // BLOCK_BYTES
    for k in range(n):
        yield [(r.item_id, bytes(r.raw)) for r in real.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()]


def annotate(docs: DataFrame, benchmark: DataFrame, to: str = "contamination", least: int = 1) -> DataFrame:
    """``docs`` with an array of (distance, item_id), nearest first, of the items each text is near.

    A text is near an item of ``n`` words when some stretch of its words is within ``n / 5`` edits of
    it, rounded down; items under five words thus stand in it word for word. Items of fewer than
    ``least`` words are passed over. Words are runs of letters, digits and marks, A-Z lower-cased; in
    scripts written without spaces each character is a word. Null
    and empty texts are near nothing, as is everything when the benchmark is empty. Items with equal
    texts are each found; equal ids with several texts count once. Every row of ``docs`` gets its
    array, repeated rows too, and all its columns stay as they are; a column that is named ``to``
    is replaced.
    """
    names = [c for c in docs.columns if c != to]
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn(to, F.array().cast("array<struct<distance:int,item_id:bigint>>"))
    for k, items in enumerate(blocks(benchmark)):
        items = [(i, raw) for i, raw in items if len(words(raw)) >= least]
        if k:  # a stage has one Python operator, with the index of one block
            rows = cut(rows, "decontamination")
        rows = rows.mapInArrow(tidied(_search_batches(items, names.index("text"))), rows.schema)
    return rows


def _search_batches(items, column: int):
    def run(batches):
        import pyarrow as pa

        index = index_of(items)
        for batch in batches:
            raws = batch.column(column).cast(pa.binary()).to_pylist()
            hits = [h for a, b in _slices(raws) for h in index.search(raws[a:b])]
            before = batch.column(batch.num_columns - 1)
            merged = []
            for k, h in enumerate(hits):
                old = {x["item_id"]: x["distance"] for x in before[k].as_py()}
                for i, d in h.items():
                    old[i] = min(d, old.get(i, d))
                merged.append([{"distance": d, "item_id": i} for d, i in sorted((d, i) for i, d in old.items())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(merged, before.type)], schema=batch.schema)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are near no item of ``MIN_WORDS`` words or more, whole rows as they came."""
    to = "contamination"
    while to in docs.columns:
        to += "_"
    return annotate(docs, benchmark, to, MIN_WORDS).where(F.size(to) == 0).drop(to)
