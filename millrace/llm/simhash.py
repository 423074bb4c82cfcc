"""SimHash near-duplicates: fingerprints, and a self-join of their binary trie.

Pairs of trie nodes are walked down together; the bits in which their paths differ are counted, and
a pair is dropped as soon as it has more than the budget. For Spark the trie is cut into subtries:
fingerprints within ``BUDGET`` bits agree in one of ``BUDGET + 1`` blocks of bits, so with each
block in turn as the top of the trie, every link lies below one node of that depth. Subtries are
dealt out by a shuffle, and those with very many leaves are split into pairs of parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import components, cut, tidied

BITS = 64
BUDGET = 4
SHINGLE = 4
SEED = 42
#: A subtrie of more leaves is split; every pair of its parts is joined in a task of its own.
PART_LEAVES = 20_000
#: Leaves and node pairs held in memory at a time.
CHUNK_LEAVES = 100_000
FRONTIER = 1 << 19


def fingerprint(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit set where over half of the shingles' XXH64 have it; zero without words."""
    import numpy as np
    import xxhash

    words = (raw or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, 1 << 15):
        part = zip(starts[at : at + (1 << 15)].tolist(), ends[at : at + (1 << 15)].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in part], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        raw = batch.column(batch.num_columns - 1)
        found = np.fromiter((fingerprint(x.as_py()) for x in raw), np.uint64, batch.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found)], names=[*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, and fp (the 64 bits as a long) of every row."""
    slim = docs.select("doc_id", F.xxhash64("text").alias("k_text"), F.col("text").cast("binary").alias("raw"))
    return slim.mapInArrow(tidied(_fingerprint_batches), slim.drop("raw").schema.add("fp", "long"))


def _blocks() -> list[tuple[int, int]]:
    """First bit from the top and width of each block."""
    n = BUDGET + 1
    edges = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def trie_links(value, lo_a, hi_a, lo_b, hi_b, depth: int):
    """Index pairs of leaves within the budget, from node pairs given as ranges of sorted values.

    ``value`` (uint64) is sorted within each range, and a range shares its first ``depth`` bits. A
    pair of a range with itself yields each pair of its leaves once. Yields arrays, piece by piece.
    """
    import numpy as np

    ones: dict[int, np.ndarray] = {}

    def split(d, lo, hi):
        """Where the ranges turn from 0 to 1 in bit d."""
        if d not in ones:
            bit = (value >> np.uint64(BITS - 1 - d)) & np.uint64(1)
            ones[d] = np.concatenate(([0], np.cumsum(bit.astype(np.int32), dtype=np.int32)))
        return hi - (ones[d][hi] - ones[d][lo])

    stack = [(depth, lo_a, hi_a, lo_b, hi_b, np.zeros(len(lo_a), np.int8))]
    while stack:
        d, la, ha, lb, hb, err = stack.pop()
        if len(la) > FRONTIER:
            half = len(la) // 2
            stack.append((d, la[half:], ha[half:], lb[half:], hb[half:], err[half:]))
            stack.append((d, la[:half], ha[:half], lb[:half], hb[:half], err[:half]))
            continue
        leaf = (ha - la == 1) & (hb - lb == 1)
        if d == BITS:
            # All bits are used: whole ranges are equal to their prefix, so each is one value.
            leaf = np.ones(len(la), bool)
        if leaf.any():
            i, j = la[leaf], lb[leaf]
            near = (i != j) & (np.bitwise_count(value[i] ^ value[j]) <= BUDGET)
            yield i[near], j[near]
            rest = ~leaf
            la, ha, lb, hb, err = la[rest], ha[rest], lb[rest], hb[rest], err[rest]
        if not len(la):
            continue
        ma, mb = split(d, la, ha), split(d, lb, hb)
        own = la == lb
        made = []
        for a0, a1, b0, b1, cost, use in (
            (la, ma, lb, mb, 0, None), (ma, ha, mb, hb, 0, None), (la, ma, mb, hb, 1, None), (ma, ha, lb, mb, 1, ~own),
        ):
            e = err + np.int8(cost)
            ok = (a0 < a1) & (b0 < b1) & (e <= BUDGET)
            if use is not None:
                ok &= use
            # A single leaf with itself is no pair.
            ok &= ~((a0 == b0) & (a1 - a0 == 1) & (b1 - b0 == 1))
            made.append((a0[ok], a1[ok], b0[ok], b1[ok], e[ok]))
        stack.append((d + 1, *[np.concatenate([m[k] for m in made]) for k in range(5)]))


def fold(label, i, j):
    """Join the classes of i and j; ``label`` has the least index of each class."""
    import numpy as np

    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _join_subtries(batches):
    """Batches (group, side, fp, value), sorted, groups whole: links as stars (fp, least fp)."""
    import numpy as np
    import pyarrow as pa

    def links(group, side, block, fp, value):
        n = len(group)
        edge = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (side[1:] != side[:-1]))))
        lo, hi = edge, np.concatenate((edge[1:], [n]))
        # Side 0 alone joins itself; sides 1 and 2 stand in one group and join each other.
        self_ = side[lo] == 0
        left = np.flatnonzero(side[lo] == 1)
        left = left[left + 1 < len(lo)]
        left = left[(group[lo[left]] == group[lo[left + 1]]) & (side[lo[left + 1]] == 2)]
        la = np.concatenate((lo[self_], lo[left]))
        ha = np.concatenate((hi[self_], hi[left]))
        lb = np.concatenate((lo[self_], lo[left + 1]))
        hb = np.concatenate((hi[self_], hi[left + 1]))
        label = np.arange(n)
        for width in np.unique(block):
            use = (block[la] == width) & ((ha - la > 1) | (la != lb))
            for i, j in trie_links(value, la[use], ha[use], lb[use], hb[use], int(width)):
                label = fold(label, i, j)
        far = np.flatnonzero(label != np.arange(n))
        return pa.RecordBatch.from_arrays([pa.array(fp[far]), pa.array(fp[label[far]])], names=["a", "b"])

    held: list = []
    size = 0

    def arrays():
        t = pa.Table.from_batches(held)
        get = lambda c: t.column(c).to_numpy()
        return get("grp"), get("side"), get("width"), get("fp"), get("value").view(np.uint64)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK_LEAVES:
            g = pa.Table.from_batches(held)
            group = g.column("grp").to_numpy()
            # The last group may go on in the next batch.
            whole = int(np.searchsorted(group == group[-1], True)) if group[0] != group[-1] else 0
            if whole:
                tail = g.slice(whole).combine_chunks().to_batches()
                held = g.slice(0, whole).to_batches()
                yield links(*arrays())
                held = tail
                size = sum(x.num_rows for x in held)
    if size:
        yield links(*arrays())


def near_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column fp): a star for each subtrie's classes."""
    spread = []
    for first, width in _blocks():
        turned = F.shiftleft("fp", first).bitwiseOR(F.shiftrightunsigned("fp", BITS - first)) if first else F.col("fp")
        spread.append(F.struct(
            F.lit(first).alias("block"), F.lit(width).alias("width"),
            F.shiftrightunsigned(turned, BITS - width).alias("top"), turned.alias("value"),
        ))
    rows = fps.select("fp", F.explode(F.array(*spread)).alias("s")).select("fp", "s.*")
    large = rows.groupBy("block", "top").count().where(F.col("count") > PART_LEAVES).select(
        "block", "top", F.ceil(F.col("count") / PART_LEAVES).cast("int").alias("parts"))
    rows = rows.join(large, ["block", "top"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
    key = ["block", "top", "low", "high"]
    rows = rows.select(
        "block", "width", "top", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        side.cast("byte").alias("side"), "fp", "value",
    )
    # The group's number only tells neighbours apart; its order within a task is that of the sort.
    rows = rows.withColumn("grp", F.xxhash64(*key))
    dealt = rows.repartition("grp").sortWithinPartitions("grp", "side", F.col("value") < 0, "value")
    return dealt.select("grp", "side", F.col("width").cast("long"), "fp", "value").mapInArrow(tidied(_join_subtries), "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, k_text (hash of the text), fp and component_id of every row.

    Texts have A-Z lower-cased; words are runs other than \\x20 and \\x09-\\x0D. Texts of fewer than
    four words have one shingle; null texts and texts without a word have fingerprint zero, and link
    like any other. component_id is the least doc_id among all rows that links reach; null ids are
    passed over, and a component of null ids only has a null one. Repeated rows each get their row.
    Equal fingerprints are joined once, whatever their number. Other columns are not looked at.
    """
    fps = cut(fingerprints(docs), "simhash")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    stars = components(near_links(classes.select("fp")))
    named = classes.join(stars, classes["fp"] == stars["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = cut(named, "simhash-classes")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(named.join(roots, "root").select("fp", "component_id"), "fp").select("doc_id", "k_text", "fp", "component_id")


def dedupe(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of near duplicates: that of the least doc_id (null ids last).

    Of rows with the same id, the one whose text has the least hash stays, and of repeated rows one.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k_text")
    # A component without ids is named by its fingerprint class alone.
    found = near_duplicates(docs).withColumn("cls", F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))))
    stay = found.groupBy("cls").agg(F.min(order).alias("o")).select("o.doc_id", "o.k_text")
    stay = stay.select(F.col("doc_id").alias("s_id"), F.col("k_text").alias("s_text"))
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").alias("r_id"), F.xxhash64("text").alias("r_text"))
    rows = rows.join(stay, rows["r_id"].eqNullSafe(stay["s_id"]) & (rows["r_text"] == stay["s_text"]), "left_semi")
    one = Window.partitionBy("r_id", "r_text").orderBy(F.lit(0))
    return rows.withColumn("n", F.row_number().over(one)).where("n = 1").select(*[F.col(f"row.`{c}`").alias(c) for c in names])
