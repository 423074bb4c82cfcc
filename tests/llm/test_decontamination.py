import random

import numpy as np
import pytest

from millrace.llm import decontamination as D
from millrace.llm.queries import QUERIES
from tests.conftest import SF, plan


def brute(docs, items):
    """Least edits of every item to any stretch of every text, where within the budget."""
    out = {}
    for d, text in docs:
        w = np.array(D.words((text or "").encode()), object)
        near = []
        for i, t in items:
            x = D.words(t.encode())
            if len(x) >= 5 and len(set(x) & set(w.tolist())) >= len(set(x)) * 0.4:
                dist = D.edit_distance(x, w)
                if dist <= len(x) // 5:
                    near.append((dist, i))
        out[d] = sorted(near)
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(docs, items)
    got = QUERIES["op2_decontamination"](spark, SF).collect()
    assert {r.doc_id: r.item_ids for r in got} == {d: [i for _, i in hits] for d, hits in want.items()}
    assert {r.doc_id: r.least_distance for r in got} == {d: hits[0][0] if hits else None for d, hits in want.items()}
    assert sum(r.contaminated for r in got) > 0


def edited(rng, x, n):
    x = list(x)
    for _ in range(n):
        at, kind = rng.randrange(len(x)), rng.randrange(3)
        if kind == 0:
            x[at] = f"new{rng.randrange(10_000)}"
        elif kind == 1:
            x.insert(at, f"new{rng.randrange(10_000)}")
        elif len(x) > 1:
            del x[at]
    return x


def test_recall_of_edited_items():
    rng = random.Random(11)
    common = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(common, k=rng.randint(5, 60))).encode()) for k in range(150)]
    index = D.Index(items)
    total = met = 0
    for k, raw in items:
        x = raw.decode().split()
        for share in (0.5, 1.0):
            near = edited(rng, x, int(share * D.budget(len(x))))
            text = rng.choices(common, k=80) + near + rng.choices(common, k=70)
            hits = index.search([" ".join(text).encode()])[0]
            want = D.edit_distance(x, np.array(text, object))
            total += 1
            met += k in hits
            assert k not in hits or hits[k] == want
    assert met >= 0.97 * total


def test_edit_distance():
    a = np.array
    assert D.edit_distance([1, 2, 3], a([9, 1, 2, 3, 9])) == 0
    assert D.edit_distance([1, 2, 3, 4], a([9, 1, 3, 4, 9])) == 1
    assert D.edit_distance([1, 2, 3, 4], a([1, 2, 8, 3, 4])) == 1
    assert D.edit_distance([1, 2], a([], dtype=int)) == 2


def test_edit_distances_of_many_pairs():
    rng = np.random.default_rng(3)
    items, texts = rng.integers(1, 5, (200, 9)), rng.integers(1, 5, (200, 13))
    want = [D.edit_distance(i, t) for i, t in zip(items, texts)]
    assert D.edit_distances(items, texts).tolist() == want
    blank = np.zeros((200, 4), int)
    assert D.edit_distances(items, np.concatenate([blank, texts, blank], axis=1)).tolist() == want
    assert D.edit_distances(items[:2], texts[:2, :0]).tolist() == [9, 9]


@pytest.mark.parametrize("block", [4 << 20, 40])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([
        (1, None, "a"), (2, "", "a"), (3, "x " * 50_000 + item.upper() + "." + " y" * 50_000, "a"), (3, item, "b"), (3, item, "b"),
        (None, "One, two; THREE four five six seven zwei nine ten", "a"), (4, "one two three four five", "a"), (5, "the", "a"),
    ], "doc_id long, text string, contamination string")
    bench = spark.createDataFrame([(7, item, 0), (8, item, 0), (9, "the", 0), (10, None, 0), (None, "x x x x x", 0), (11, "", 0)], "item_id long, text string, n int")
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, None), (2, ""), (4, "one two three four five"), (5, "the")], key=lambda r: r[0])
    hits = [r.hits for r in D.annotate(docs, bench, "hits").where("doc_id = 3").collect()]
    assert [[(h.distance, h.item_id) for h in x] for x in hits] == [[(0, 7), (0, 8)]] * 3
    # However many blocks there are, a stage has one Python operator.
    assert plan(D.annotate(docs, bench, "hits")).count("MapInArrow") == 1
    assert D.decontaminate(docs, bench.limit(0)).count() == 8 and D.decontaminate(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("n", [200, 400, 1000])
def test_recall_does_not_fall_with_length(n):
    rng = random.Random(n)
    common = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(common, k=n)).encode()) for k in range(25)]
    index = D.Index(items)
    met = 0
    for k, raw in items:
        x = raw.decode().split()
        text = rng.choices(common, k=150) + edited(rng, x, D.budget(n)) + rng.choices(common, k=90)
        hits = index.search([" ".join(text).encode()])[0]
        met += k in hits
        assert k not in hits or hits[k] == D.edit_distance(x, np.array(text, object))
    assert met >= 0.97 * len(items)


def test_short_items_and_unspaced_scripts(spark):
    items = [(1, "dark energy"), (2, "the"), (3, "北京是中国的首都"), (4, "ความรู้"), (5, "alpha—beta gamma—delta—epsilon")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "on Dark  energy, then"), (2, "dark matter energy"), (3, "他说北京是中国的首都。"), (4, "มีความรู้มาก"),
        (5, "so alpha beta gamma delta epsilon"), (6, "The end"), (7, "darkenergy other"),
    ], "doc_id long, text string")
    got = {r.doc_id: [(h.distance, h.item_id) for h in r.hits] for r in D.annotate(docs, bench, "hits").collect()}
    assert got == {1: [(0, 1)], 2: [], 3: [(0, 3)], 4: [(0, 4)], 5: [(0, 5)], 6: [(0, 2)], 7: []}
    assert sorted(r.doc_id for r in D.decontaminate(docs, bench).collect()) == [1, 2, 6, 7]
