import random

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.queries import QUERIES
from tests.conftest import SF


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(rows):
    """rows: (doc_id, fingerprint); least id reachable of each row."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 4:
                up[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f, least.get(find(f))) for d, f in rows]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in docs])
    got = QUERIES["op3_simhash"](spark, SF).collect()
    assert sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got) == sorted(want)


@pytest.mark.parametrize("part", [20_000, 7])
def test_links_of_dense_fingerprints(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART_LEAVES", part)
    monkeypatch.setattr(simhash, "FRONTIER", 64)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {0, (1 << 64) - 1, *base}
    for b in base:
        for _ in range(25):
            x = b
            for k in rng.sample(range(64), rng.randint(1, 7)):
                x ^= 1 << k
            fps.add(x)
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    want = {f: c for _, f, c in brute_components(rows)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long")).collect()
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in links:
        up[find(r.a % (1 << 64))] = find(r.b % (1 << 64))
    for f in fps:
        for g in fps:
            assert (find(f) == find(g)) == (want[f] == want[g])


def test_odd_rows(spark):
    rows = [(None, None, "x"), (None, "", "x"), (3, " \n", "x"), (5, "one", "x"), (5, "one", "x"), (4, "ONE", "y"), (None, "lonely words stand here now", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit("clash"))
    got = sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    one = brute_fingerprint("one")
    one = one - (1 << 64) if one >> 63 else one
    assert ("5", one, "4") in got and got.count(("None", 0, "3")) == 2 and len(got) == 7
    assert sum(x[0] == "None" and x[2] == "None" for x in got) == 1
    kept = simhash.dedupe(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("3", " \n"), ("4", "ONE"), ("None", "lonely words stand here now")]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.dedupe(docs.limit(0)).count() == 0


def test_long_text(spark):
    text = "word other " * 60_000
    got = simhash.near_duplicates(spark.createDataFrame([(1, text), (2, text.upper())], "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}
