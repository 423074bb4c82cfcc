"""Token ids in files, compressed by a Re-Pair grammar per shard.

A file set is Parquet; each row is a shard of whole documents in ascending order of their ids. The
most frequent pairs of symbols are replaced by nonterminals, again and again, never across the end
of a document. A shard holds its rules, the expansion length of each, and where each document's
symbols start, so one document, or a range of its ids, is decoded without the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.session import scratch_dir

#: Nonterminals are numbered from here; token ids lie below.
BASE = 1 << 16
#: Symbols lie below this bit, which marks the last one of a document while a shard is compressed.
LAST = 1 << 31
SHARD_IDS = 1 << 20
#: New rules of a round at most, and the least number of places of a pair that becomes one.
ROUND_RULES = 2048
LEAST = 32
HASH_BITS = 18
#: Text bytes that one task orders and compresses, roughly.
TASK_BYTES = 16 << 20
SHARD = (
    "part int, shard int, doc_ids array<bigint>, doc_tokens array<bigint>, symbol_starts array<bigint>, "
    "rules binary, expansions binary, symbols binary, n_ids long, n_symbols long"
)


def _slots(firsts, seconds):
    """The hash slot of each pair of symbols, and the one after all others where the first ends its document."""
    import numpy as np

    slot = firsts * np.uint32(0x9E3779B1)
    slot += (seconds & (LAST - 1)) * np.uint32(0x85EBCA77)
    slot >>= np.uint32(32 - HASH_BITS)
    slot[firsts >= LAST] = 1 << HASH_BITS
    return slot.astype(np.int32)


def compress(ids, last):
    """Rules (pairs of symbols, uint32) and the symbols left; ``last`` marks the end of documents.

    Each round takes frequent pairs no two of which can overlap: no symbol is the first of one and
    the second of another, and a symbol repeated pairs from the left. So all places are replaced at
    once. Rounds go on until no pair has ``LEAST`` places. Slots and what they hold are kept from
    round to round, and counted anew only beside what was replaced.
    """
    import numpy as np

    n_slots, rules, n_rules, every = 1 << HASH_BITS, [], 0, False
    # A pair that spans documents is none.
    symbols = ids.astype(np.uint32)
    symbols[last] |= LAST
    slot = np.append(_slots(symbols[:-1], symbols[1:]), np.int32(n_slots))[: len(symbols)]
    held = np.bincount(slot, minlength=n_slots + 1)
    while len(symbols) > 1:
        # Only pairs that share a slot with many others can be frequent; the fullest slots are looked into.
        full = held[:-1][held[:-1] >= LEAST]
        enough = LEAST if every or len(full) < 2 * ROUND_RULES else int(np.partition(full, -2 * ROUND_RULES)[-2 * ROUND_RULES])
        looked = held >= enough
        looked[n_slots] = False
        often = np.flatnonzero(looked[slot])
        own = slot[often]
        seen = symbols[often].astype(np.uint64) << np.uint64(32)
        seen |= symbols[often + 1] & (LAST - 1)
        pairs, places = np.unique(seen, return_counts=True)
        order = np.argsort(-places, kind="stable")
        firsts, seconds, slots, chosen = set(), set(), set(), []
        order = order[places[order] >= LEAST][: 4 * ROUND_RULES]
        pairs = np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        hashed = _slots(pairs[order, 0], pairs[order, 1])
        for k, (a, b), h in zip(order.tolist(), pairs[order].tolist(), hashed.tolist()):
            # Of pairs that share a slot one is taken, the others in later rounds.
            if h in slots or a in seconds or b in firsts or a == b and a in firsts:
                continue
            slots.add(h)
            firsts.add(a)
            seconds.add(b)
            chosen.append(k)
            if len(chosen) == ROUND_RULES:
                break
        if not chosen and enough > LEAST:
            every = True  # none in the fullest slots; look into all that can hold one
            continue
        if not chosen:
            break
        wanted = pairs[np.sort(chosen)]
        rule_of = np.full(n_slots + 1, len(wanted), np.intp)
        rule_of[_slots(wanted[:, 0], wanted[:, 1])] = np.arange(len(wanted))
        at = rule_of[own]
        hit = np.flatnonzero(np.append(wanted[:, 0].astype(np.uint64) << np.uint64(32) | wanted[:, 1], ~np.uint64(0))[at] == seen)
        where, rule = often[hit], at[hit]
        # Only a symbol repeated overlaps itself: of a run of places every second one counts.
        same = wanted[:, 0] == wanted[:, 1]
        if same.any():
            same = same[rule]
            new = np.concatenate(([True], ~((np.diff(where) == 1) & same[1:] & same[:-1] & (rule[1:] == rule[:-1]))))
            first = np.maximum.accumulate(np.where(new, np.arange(len(where)), 0))
            keep = ~same | ((np.arange(len(where)) - first) % 2 == 0)
            where, rule = where[keep], rule[keep]
        symbols[where] = (BASE + n_rules + rule).astype(np.uint32) | (symbols[where + 1] & LAST)
        stay = np.ones(len(symbols), bool)
        stay[where + 1] = False
        lost = slot[where + 1]
        symbols, slot = symbols[stay], slot[stay]
        # A new symbol changes its own pair and the one before it.
        where -= np.arange(len(where))
        moved = np.zeros(len(symbols), bool)
        moved[where] = True
        moved[np.maximum(where - 1, 0)] = True
        moved = np.flatnonzero(moved[:-1])
        fresh = _slots(symbols[moved], symbols[moved + 1])
        held -= np.bincount(np.concatenate((lost, slot[moved], slot[-1:])), minlength=n_slots + 1)
        held += np.bincount(np.append(fresh, np.int32(n_slots)), minlength=n_slots + 1)
        slot[moved], slot[-1] = fresh, n_slots
        rules.append(wanted)
        n_rules += len(wanted)
    return (np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)), symbols & (LAST - 1), symbols >= LAST


def expansions(rules):
    """Expansion length of each rule, in order; a rule uses earlier ones only."""
    import numpy as np

    size = [1] * len(rules)
    for k, (a, b) in enumerate(rules.tolist()):
        size[k] = (size[a - BASE] if a >= BASE else 1) + (size[b - BASE] if b >= BASE else 1)
    return np.array(size, np.int64)


def _ranges(starts, sizes):
    """The numbers of all ranges in a row."""
    import numpy as np

    ends = np.cumsum(sizes)
    numbers = np.arange(ends[-1] if len(ends) else 0)
    numbers += np.repeat(starts - (ends - sizes), sizes)
    return numbers


def spelled(rules):
    """The ids of all rules in a row, and where those of each start; a rule's places bound what it takes."""
    import numpy as np

    size = expansions(rules)
    starts = np.concatenate(([0], np.cumsum(size)))
    flat = np.empty(starts[-1], np.uint32)
    left, right = rules[:, 0].astype(np.int64), rules[:, 1].astype(np.int64)
    first = np.where(left < BASE, 1, size[np.maximum(left - BASE, 0)]) if len(rules) else size
    for symbol, to in ((left, starts[:-1]), (right, starts[:-1] + first)):
        flat[to[symbol < BASE]] = symbol[symbol < BASE]
    # A rule is spelled once those it uses are, which come in earlier rounds.
    depth = [0] * len(rules)
    for k, (a, b) in enumerate(rules.tolist()):
        if a >= BASE or b >= BASE:
            depth[k] = 1 + max(depth[x - BASE] if x >= BASE else 0 for x in (a, b))
    depth = np.array(depth, np.int64)
    for level in range(1, int(depth.max(initial=0)) + 1):
        own = depth == level
        for symbol, to in ((left, starts[:-1]), (right, starts[:-1] + first)):
            inner = np.flatnonzero(own & (symbol >= BASE))
            used = symbol[inner] - BASE
            flat[_ranges(to[inner], size[used])] = flat[_ranges(starts[used], size[used])]
    return flat, starts


def expand(symbols, rules):
    """The ids that symbols stand for."""
    import numpy as np

    flat, starts = spelled(rules)
    inner = np.flatnonzero(symbols >= BASE)
    rule = symbols[inner].astype(np.int64) - BASE
    size = np.ones(len(symbols), np.int64)
    size[inner] = starts[rule + 1] - starts[rule]
    # A plain symbol stands behind the rules' ids, a rule's symbol among them.
    first = np.arange(len(flat), len(flat) + len(symbols))
    first[inner] = starts[rule]
    return np.concatenate((flat, symbols.astype(np.uint32)))[_ranges(first, size)]


def read_range(shard: dict, document: int, start: int = 0, length: int | None = None):
    """Ids [start, start + length) of a document of a shard, decoding no more than covers them."""
    import numpy as np

    rules = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2)
    sizes = np.frombuffer(shard["expansions"], "<u4")
    symbols = np.frombuffer(shard["symbols"], "<u4")
    bounds = [*shard["symbol_starts"], len(symbols)]
    own = symbols[bounds[document] : bounds[document + 1]]
    inner = own >= BASE
    size = np.ones(len(own), np.int64)
    size[inner] = sizes[own[inner] - BASE]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    stop = total if length is None else min(total, start + length)
    if start >= stop:
        return np.empty(0, np.uint32)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    before = int(ends[a] - size[a])
    return _expand_few(own[a:b], rules)[start - before : stop - before]


def _expand_few(symbols, rules):
    """As ``expand``, level by level, without spelling rules that are not used."""
    import numpy as np

    out = symbols
    while len(out) and out.max() >= BASE:
        inner = out >= BASE
        ends = np.cumsum(1 + inner.astype(np.int64))
        wide = np.empty(ends[-1], np.uint32)
        wide[(ends - 1)[~inner]] = out[~inner]
        pair = rules[out[inner] - BASE]
        wide[(ends - 2)[inner]] = pair[:, 0]
        wide[(ends - 1)[inner]] = pair[:, 1]
        out = wide
    return out


def _shard_batches(path: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), tokens.encoder(path)
        held, docs, counts, n_shard = [], [], [], 0
        schema = pa.schema([
            ("part", pa.int32()), ("shard", pa.int32()), *[(c, pa.list_(pa.int64())) for c in ("doc_ids", "doc_tokens", "symbol_starts")],
            *[(c, pa.binary()) for c in ("rules", "expansions", "symbols")], ("n_ids", pa.int64()), ("n_symbols", pa.int64()),
        ])

        def shard():
            ids, lengths = np.concatenate(held), np.array(counts, np.int64)
            last = np.zeros(len(ids), bool)
            last[np.cumsum(lengths) - 1] = True
            rules, symbols, ends = compress(ids, last)
            starts = np.concatenate(([0], np.flatnonzero(ends)[:-1] + 1))
            row = (part, n_shard, docs, counts, starts.tolist(), rules.astype("<u4").tobytes(),
                   expansions(rules).astype("<u4").tobytes(), symbols.astype("<u4").tobytes(), len(ids), len(symbols))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in tokens.slices(texts):
                ids, lengths = enc.encode(texts[a:b])
                held.append(ids)
                docs += doc_ids[a:b]
                counts += lengths.tolist()
                if sum(map(len, held)) >= SHARD_IDS:
                    yield shard()
                    held, docs, counts, n_shard = [], [], [], n_shard + 1
        if docs:
            yield shard()

    return run


def write_ids(docs: DataFrame, path: str, n_tasks: int, tokenizer: str | None = None) -> None:
    """Write the ids of all documents in ascending order of doc_id (nulls first) as shards.

    Rows with equal ids stand side by side in the order of a hash of their texts. Null texts are
    empty: the end id alone. Of other columns nothing is read. An empty table gives a file set
    without shards.
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        n_tasks, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(_shard_batches(tokenizer or tokens.default_tokenizer()), SHARD).write.option("compression", "zstd").parquet(path)


def _decode_batches(batches):
    import zlib

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
            ids = expand(np.frombuffer(row["symbols"], "<u4"), rules).astype("<u4", copy=False)
            ends = np.cumsum(row["doc_tokens"])
            raw = ids.data.cast("B")
            sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), row["doc_tokens"])]
            n = len(sums)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                pa.array(row["doc_ids"], pa.int64()), pa.array(ends - np.array(row["doc_tokens"], np.int64), pa.int64()),
                pa.array(row["doc_tokens"], pa.int64()), pa.array(sums, pa.int64()),
            ], names=["part", "shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"])


def read_digests(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from a file set.

    start counts the ids of all documents before it: a running sum over the shards of a task, and
    one over the tasks, which are few.
    """
    n = shards.select("part", "shard", "n_ids")
    upto = lambda key, by: Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    tasks = n.groupBy("part").agg(F.sum("n_ids").alias("n"))
    tasks = tasks.select("part", F.coalesce(F.sum("n").over(upto("part", [F.lit(0)])), F.lit(0)).alias("task0"))
    first = n.select("part", "shard", F.coalesce(F.sum("n_ids").over(upto("shard", ["part"])), F.lit(0)).alias("shard0"))
    first = first.join(tasks, "part").select("part", "shard", (F.col("task0") + F.col("shard0")).alias("first"))
    slim = shards.select("part", "shard", "doc_ids", "doc_tokens", "rules", "symbols")
    decoded = slim.mapInArrow(_decode_batches, "part int, shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long")
    return decoded.join(first, ["part", "shard"]).select("doc_id", (F.col("first") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, n_tasks: int, tokenizer: str | None = None) -> DataFrame:
    """Write a file set to the shared folder and read its digests."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark, 'ids')}/shards"
    write_ids(docs, path, n_tasks, tokenizer)
    return read_digests(spark.read.schema(SHARD).parquet(path))
