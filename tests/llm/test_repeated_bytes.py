import hashlib
import random

import numpy as np
import pytest

from millrace.llm import repeated_bytes as R
from millrace.llm.queries import QUERIES
from tests.conftest import SF


def brute(rows):
    """(doc_id, bytes) to (n_bytes, n_removed, n_spans, sha256), in the order of the rows."""
    least = {}
    for d, raw in rows:
        for i in range(len(raw) - 49):
            s = raw[i:i + 50]
            if d < least.get(s, d + 1):
                least[s] = d
    out = []
    for d, raw in rows:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if least[raw[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(raw)))
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op10_repeated_bytes"](spark, SF).collect()
    want = brute(rows)
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert sum(w[2] for w in want) > 0


@pytest.mark.parametrize("part", [4 << 20, 3000])
def test_made_up_texts(spark, monkeypatch, part):
    monkeypatch.setattr(R, "PART_BYTES", part)
    monkeypatch.setattr(R, "SLICE_BYTES", 2000)
    rng = random.Random(2)
    pool = ["".join(rng.choices("ab ", k=rng.choice([49, 50, 51, 60, 120]))) for _ in range(12)]
    pool += ["a" * 130, "é" * 40, "xyz" * 30]
    rows = []
    for d in range(120):
        bits = []
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(pool)
            a = rng.randrange(len(x))
            bits += [x if rng.random() < 0.4 else x[a:], "".join(rng.choices("abcdefgh é", k=rng.randint(0, 40)))]
        rows.append((d, "".join(bits)))
    rows += [(40, pool[0] * 2), (40, pool[0] * 2), (5, pool[1]), (None, pool[2] + "a" * 60), (7, None), (8, ""), (130, "q" * 9000 + pool[3])]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, part int, raw string")
    got = R.repeated_bytes(docs).collect()
    want = brute([(R.LAST if d is None else d, (t or "").encode()) for d, t in rows])
    mine = [(R.LAST if r.doc_id is None else r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert sorted(mine) == sorted(want)
    assert R.repeated_bytes(docs.limit(0)).count() == 0


def test_classes():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 19), np.uint8)
    rows[200:] = rows[:100]
    found = R.Classes(rows)
    for depth in (0, 1, 5, 8, 9, 16, 19):
        ids = found.at(depth)
        for _ in range(300):
            i, j = rng.integers(0, 300, 2)
            assert (ids[i] == ids[j]) == (rows[i, :depth] == rows[j, :depth]).all()
