from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language_id, quality_classifier
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_id_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, SF).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)


def test_quality_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op8_quality_classifier"](spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)


def test_presence_is_the_set_of_ngrams():
    raws = ["Ab ab\0é".encode(), b"", b"x" * 10_000, b"ab"]
    got = language_id.presence(raws)
    for raw, row in zip(raws, got):
        want = set()
        low = raw.lower()
        for n in language_id.ORDERS:
            for i in range(len(low) - n + 1):
                g = low[i:i + n]
                if 0 not in g:
                    code = (int.from_bytes(g, "big") + (n << 24)) & 0xFFFFFFFF
                    want.add((code * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - language_id.CELL_BITS)
        assert set(np.flatnonzero(row).tolist()) == want


@pytest.fixture
def odd(spark):
    rows = [(None, None, None, 1.0), (1, "", "en", 1.0), (2, "!!! 123", "fr", 1.0), (2, "the word", "en", 1.0), (3, "the " * 80_000, "en", 2.0),
            (4, "der die das", "de", 2.0), (5, "der die und", "de", 2.0), (6, "the and of", "en", 2.0), (7, "the and to", None, 2.0)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def test_odd_rows(spark, odd):
    got = language_id.predict(odd, language_id.train(odd)).collect()
    assert len(got) == 18
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (None, 1))
    assert {r.lang_pred for r in got if r.doc_id == 3} == {"en"} and {r.lang_pred for r in got if r.doc_id == 4} == {"de"}
    nothing = odd.limit(0)
    assert language_id.train(nothing) is None and language_id.predict(nothing, None).count() == 0
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 0), (3, 0, 0), (4, 1, 0), (5, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    weights = quality_classifier.train(odd, labels)
    got = quality_classifier.score(odd, weights).collect()
    assert len(got) == 18 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (None, 1)}) == 1
    assert quality_classifier.train(odd, labels.limit(0)) is None
    assert {r.score for r in quality_classifier.score(odd, None).collect()} == {0.5}
    assert quality_classifier.score(nothing, weights).count() == 0


def spark_hash(spark, ids):
    """The hash that orders the sample."""
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()
    return {r.doc_id: r.h for r in rows}


def test_scores_equal_plain_kernel_ridge(spark):
    """Kernel values from sets of n-grams, the Nyström features and the ridge written out, over the same sample."""
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    h = spark_hash(spark, [r.doc_id for r in docs])

    def cells(text):
        low, out = text.encode().lower(), set()
        for n in language_id.ORDERS:
            for g in {low[i:i + n] for i in range(len(low) - n + 1)}:
                code = (int.from_bytes(g, "big") + (n << 24)) & 0xFFFFFFFF
                out.add((code * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - language_id.CELL_BITS)
        return out

    sample, nth = [], {}
    for r in sorted((r for r in docs if r.lang and crc32(str(r.doc_id).encode()) % 4 != 2), key=lambda r: (r.lang, h[r.doc_id])):
        nth[r.lang] = nth.get(r.lang, 0) + 1
        if nth[r.lang] <= language_id.PER_LANGUAGE:
            sample.append((r.lang, nth[r.lang], cells(r.text)))
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    marks = [s for _, n, s in sample if n <= language_id.LANDMARKS]
    w = np.array([[kernel(a, b) for b in marks] for a in marks])
    c = np.array([[kernel(s, b) for b in marks] for _, _, s in sample])
    own, vectors = np.linalg.eigh(w)
    use = own > 1e-6 * own.max()
    root = vectors[:, use] / np.sqrt(own[use])
    phi, names = c @ root, sorted({lang for lang, _, _ in sample})
    y = np.array([[1.0 if lang == x else -1.0 for x in names] for lang, _, _ in sample])
    weights = root @ np.linalg.solve(phi.T @ phi + language_id.RIDGE * np.eye(phi.shape[1]), phi.T @ y)
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op4_language_id"](spark, "/root/testdata/sf0.001").collect()}
    for r in docs:
        f = np.array([kernel(cells(r.text), b) for b in marks]) @ weights
        assert got[r.doc_id][0] == names[int(f.argmax())]
        assert abs(got[r.doc_id][1] - (min(1, max(-1, f.max())) + 1) / 2) < 2e-3


def test_scores_equal_plain_ftrl(spark):
    """Dictionaries of features and one weight at a time, over the same sample in the same order."""
    C = quality_classifier
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    h = spark_hash(spark, docs)

    def features(text):
        out = {0: 1.0}
        for family, words in enumerate(((text or "").encode().lower().split(), (text or "").encode().translate(C._SHAPE).split())):
            hashes = [crc32(w) for w in words]
            ones = [(x * 0x9E3779B1 + family) & 0xFFFFFFFF for x in hashes]
            twos = [(a * 0x85EBCA77 & 0xFFFFFFFF) ^ (b * 0xC2B2AE3D + family + 2 & 0xFFFFFFFF) for a, b in zip(hashes, hashes[1:])]
            for grams in (ones, twos):
                for m in grams:
                    cell = ((m ^ m >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 32 - 18
                    out[cell] = out.get(cell, 0.0) + 1 / len(grams)
        return out

    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= C.L1:
            return 0.0
        return (np.sign(z[i]) * C.L1 - z[i]) / ((C.BETA + n[i] ** 0.5) / C.ALPHA + C.L2)

    sample = sorted((d for d in labels if crc32(str(d).encode()) % 5 and d in docs), key=h.get)
    for _ in range(C.EPOCHS):
        for d in sample:
            x = features(docs[d])
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - labels[d]) * v
                z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / C.ALPHA * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = {r.doc_id: r.score for r in QUERIES["op8_quality_classifier"](spark, "/root/testdata/sf0.001").collect()}
    for d, text in docs.items():
        assert abs(got[d] - 1 / (1 + np.exp(-sum(weight(i) * v for i, v in features(text).items())))) < 1e-3


def test_repeated_rows_count_once(spark, monkeypatch):
    """A third of all rows is one row: the samples keep their bounds, and the models stay as they were."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    one = labels.where("doc_id % 5 <> 0").select("doc_id").join(docs, "doc_id").orderBy(F.xxhash64("doc_id")).limit(1)
    copies = one.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(10_000)))).select(*docs.columns)
    more, extra = docs.unionByName(copies).repartition(7), labels.unionByName(labels.join(copies.select("doc_id"), "doc_id"))
    sizes, fit, learn = [], language_id.fit, quality_classifier.Ftrl.learn
    monkeypatch.setattr(language_id, "fit", lambda m, *a: sizes.append(len(m)) or fit(m, *a))
    monkeypatch.setattr(quality_classifier.Ftrl, "learn", lambda self, *a: sizes.append(-1) or learn(self, *a))
    few, many = language_id.train(docs), language_id.train(more)
    assert sizes[0] == sizes[1] <= docs.count() and all((a == b).all() for a, b in zip(few[:2], many[:2]))
    sizes.clear()
    plain = quality_classifier.train(docs, labels)
    once = len(sizes)
    assert (quality_classifier.train(more, extra) == plain).all() and len(sizes) == 2 * once
