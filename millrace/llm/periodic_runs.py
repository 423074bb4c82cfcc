"""Periodic runs of words: found by recursive frequency splitting and a scan of lags, then cut to one period.

Each word of a run of exponent ``LEAST_EXPONENT`` or more stands in it as many times. So a word that is
rarer than that within its segment cannot be in any such run, and splits the segment; this goes on
until each word of each segment is frequent there, or the segment is too short. The segments that
survive are scanned at every lag up to a ``LEAST_EXPONENT``-th of their length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
#: Bytes of texts that are split and scanned together.
SLICE_BYTES = 2 << 20


def survivors(word, segment):
    """Places of the words that may be in a run, and a number of each one's segment, ascending.

    ``word`` has a number for each word, ``segment`` an ascending number of the text it stands in.
    """
    import numpy as np

    at, segment = np.arange(len(word)), np.asarray(segment)
    span = int(word.max()) + 1 if len(word) else 1
    done_at, done_segment = [], []
    while len(at):
        new = np.concatenate(([True], (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)))
        starts = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        long = (np.diff(np.append(starts, len(at))) >= LEAST_LENGTH)[number]
        at, number = at[long], number[long]
        if not len(at):
            break
        # Counts within each segment.
        key = number * span + word[at]
        order = np.argsort(key, kind="stable")
        change = np.flatnonzero(np.diff(key[order], prepend=-1))
        counts = np.diff(np.append(change, len(at)))
        often = np.empty(len(at), bool)
        often[order] = np.repeat(counts >= LEAST_EXPONENT, counts)
        first = np.flatnonzero(np.diff(number, prepend=-1))
        stable = np.repeat(np.logical_and.reduceat(often, first), np.diff(np.append(first, len(at))))
        done_at.append(at[stable])
        # A segment is known by its first place.
        done_segment.append(np.repeat(at[first], np.diff(np.append(first, len(at))))[stable])
        go_on = often & ~stable
        at, segment = at[go_on], number[go_on]
    if not done_at:
        return at, at
    at, segment = np.concatenate(done_at), np.concatenate(done_segment)
    order = np.argsort(at, kind="stable")
    return at[order], segment[order]


def _first_apart(x, lag: int, at: int, stop: int, step: int) -> int:
    """From ``at`` in steps of 1 or -1, the first place that differs from the one ``lag`` on; else ``stop``."""
    import numpy as np

    width = 64
    while at != stop:
        if step > 0:
            end = min(stop, at + width)
            apart = np.flatnonzero(x[at:end] != x[at + lag : end + lag])
            if len(apart):
                return at + int(apart[0])
        else:
            end = max(stop, at - width)
            apart = np.flatnonzero(x[end + 1 : at + 1] != x[end + 1 + lag : at + 1 + lag])
            if len(apart):
                return end + 1 + int(apart[-1])
        at, width = end, 2 * width
    return stop


def scan_lags(x, sizes) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) in segments of the given sizes, longest first, in one array.

    Each segment is followed by a number that stands nowhere else. A run of period q holds three
    multiples of q in a row where the word equals the one q on; only there a hash of the next
    2 q words is compared with that of the words q on, and only then the words themselves. So a
    lag costs a q-th of the words, and runs are still found exactly. Lags that are multiples of
    the period of a run met before meet that run again, which counts once, with its least period.
    """
    import numpy as np

    if not len(sizes):
        return []
    ends = np.cumsum(np.asarray(sizes) + 1)
    power = np.full(len(x) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * power[:-1], dtype=np.uint64)))
    found: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    lengthy: list[tuple[int, int, int]] = []
    for q in range(1, int(sizes[0]) // LEAST_EXPONENT + 1):
        least = max(LEAST_LENGTH, LEAST_EXPONENT * q)
        stop = int(ends[np.searchsorted(-np.asarray(sizes), -least, "right") - 1])
        grid = x[:stop:q]
        same = grid[1:] == grid[:-1]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        if not len(hits):
            continue
        here, there = sums[hits + 2 * q + 1] - sums[hits], sums[hits + 3 * q + 1] - sums[hits + q]
        hits = hits[here * power[q] == there]
        if not len(hits):
            continue
        lengthy = [r for r in lengthy if r[1] >= LEAST_EXPONENT * q]
        for s, n, p in lengthy:
            if q % p == 0:
                hits = np.delete(hits, slice(*np.searchsorted(hits, [s, s + n - 3 * q])))
        k = 0
        while k < len(hits):
            hit = int(hits[k])
            stop_at = _first_apart(x, q, hit, stop - q, 1)
            start = _first_apart(x, q, hit, -1, -1) + 1
            length = stop_at - start + q
            if length >= least and (start, length) not in known:
                known.add((start, length))
                found.append((start, length, q))
                lengthy.append((start, length, q))
            k = max(k + 1, int(np.searchsorted(hits, stop_at, "left")))
    return found


def find_runs(words: list[list]) -> list[list[tuple[int, int, int]]]:
    """Of each text, given as its words, all runs (start, length, period) by start, then period."""
    from itertools import chain, count

    import numpy as np

    sizes = np.fromiter(map(len, words), np.int64, len(words))
    known: dict = {}
    total = int(sizes.sum())
    number = np.fromiter(map(known.setdefault, chain.from_iterable(words), count()), np.int64, total)
    text = np.repeat(np.arange(len(words)), sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    at, segment = survivors(number, text)
    if not len(at):
        return out
    first = np.flatnonzero(np.diff(segment, prepend=-1))
    length = np.diff(np.append(first, len(at)))
    order = np.argsort(-length, kind="stable")
    # Segments one after another, the longest first, each followed by a number of its own.
    begin = np.concatenate(([0], np.cumsum(length[order] + 1)))
    x = np.empty(begin[-1], np.int64)
    x[begin[1:] - 1] = total + np.arange(len(first))
    where = np.repeat(begin[:-1] - np.cumsum(length[order]) + length[order], length[order]) + np.arange(len(at))
    source = np.repeat(first[order] - np.cumsum(length[order]) + length[order], length[order]) + np.arange(len(at))
    x[where] = number[at[source]]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for s, n, q in scan_lags(x, length[order]):
        k = int(np.searchsorted(begin, s, "right")) - 1
        place = int(at[first[order[k]]]) + s - int(begin[k])
        own = int(text[place])
        out[own].append((place - int(starts[own]), n, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    import numpy as np

    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for s, n, q in runs:
        gone[s + q : s + n] = True
    return [words[k] for k in np.flatnonzero(~gone).tolist()]


def _batches(rewrite):
    def run(batches):
        import pyarrow as pa

        runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            all_ids, all_raws = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(all_raws, SLICE_BYTES):
                ids = all_ids[a:b]
                # bytes.split() cuts at the space and at \x09 to \x0D, and nowhere else.
                words = [raw.split() for raw in all_raws[a:b]]
                if rewrite:
                    words = [rewrite(d, own) for d, own in zip(ids, words)]
                runs = find_runs(words)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array([len(own) for own in words], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], runs_type),
                    pa.array([b" ".join(collapse(w, r)) for w, r in zip(words, runs)], pa.binary()).cast(pa.string()),
                ], names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of every row.

    Words are runs other than \\x20 and \\x09-\\x0D. A run is a stretch with least period q, of
    ``LEAST_LENGTH`` and ``LEAST_EXPONENT`` * q words or more, that no neighbouring word extends. The
    collapsed text has the words, one space between them, without those that a run holds after its
    first q. ``rewrite`` may change the words of a document, given its id, before all that. Null and
    empty texts have no words, no runs and an empty collapsed text. Null ids and repeated rows each
    get their row; an empty table gives none; other columns are not looked at. A text is worked on
    whole, in memory that grows with its words.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    return slim.mapInArrow(
        _batches(rewrite), "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
