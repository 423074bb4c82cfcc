import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing, repair, tokens
from millrace.llm.queries import QUERIES
from millrace.session import scratch_dir
from tests.conftest import SF

ODD = ["", None, "one\u00a0two\u2003", "\u00a0", "a\n\u00a0b\u00a0", "\u0120x \u010a", "a  b", "a   b\n\n  c", " x", "x ", "\n x \n", "<|endoftext|> hi", "it's 's 12 3.4 !! --", "\x00y", "\x00", "\t x\ty",
       "a\x1c b", "日本 語 éà", "x\r\n y", "one two " * 30_000, "a" * 5000]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(tokens.default_tokenizer())
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_tokenizer(spark, plain):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    ids, n = tokens.encoder(tokens.default_tokenizer()).encode(texts)
    want = [plain(t) for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_encoder_gives_the_tokenizer_each_stretch_once(plain):
    rng = random.Random(8)
    ends = ["a", "Z", "7", "é", "ß", "ÿ", "×", "÷", "²", "ª", "日", "Ж", "ʼ", "'s", "'", ".", "*", "\u00a0", "\u00d7x", "\0", "<|endoftext|>"]
    between = [" ", " ", " ", "\n", "\t", "", "  ", "\n ", " \n", "\x1c", "\u2003"]
    begin, marks = ["", "w", "it's", " "], ["", *tokens.MARKS, "..", ".,"]
    texts = ["".join(rng.choice(begin) + rng.choice(ends) + rng.choice(marks) + rng.choice(between[: 4 if k % 2 else None])
                     for _ in range(rng.randrange(8))) for k in range(3000)]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    ids, n = encoder.encode(texts)
    want = [plain(t) for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    # A stretch that a mark closes is known by what stands before the mark.
    encoder = tokens.Encoder(tokens.default_tokenizer())
    given, learn = [], encoder._learn
    encoder._learn = lambda names: (given.extend(names), learn(names))
    for text in ("one word, word. word", "one word! word; two, word\ntwo. 7? 7", "one word: 7"):
        ids, n = encoder.encode([text])
        assert ids.tolist() == plain(text)
    assert sorted(given) == sorted(["\0one", "word", "two", "\0two", "\0\n", "7"])


def test_op1_equals_plain_encoding(spark, plain):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want, start = [], 0
    for d, text in docs:
        ids = plain(text)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    got = QUERIES["op1_token_files"](spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want


def test_grammar_round_trip():
    rng = random.Random(1)
    for alphabet, n in ((1, 200), (2, 3000), (5, 40_000), (50_000, 500), (3, 1)):
        ids = np.array([rng.randrange(alphabet) for _ in range(n)], np.uint32)
        last = np.array([rng.random() < 0.02 for _ in range(n)])
        last[-1] = True
        rules, symbols, ends = repair.compress(ids.copy(), last.copy())
        assert (repair.expand(symbols, rules) == ids).all() and ends.sum() == last.sum()
        sizes = repair.expansions(rules)
        for k in range(len(rules)):
            assert len(repair.expand(np.array([repair.BASE + k], np.uint32), rules)) == sizes[k]
    assert len(repair.compress(np.zeros(1000, np.uint32), np.arange(1000) == 999)[1]) < 80


def test_grammar_goes_to_its_end():
    rng = random.Random(4)
    one = [rng.randrange(50_000) for _ in range(300)]
    ids = np.array(one * 3000, np.uint32)
    last = np.arange(len(ids)) % 300 == 299
    rules, symbols, ends = repair.compress(ids.copy(), last.copy())
    assert len(symbols) == 3000 and ends.all() and (repair.expand(symbols, rules) == ids).all()
    assert repair.expansions(rules).max() == 300
    ids = np.array([rng.choice((1, 2, 3, 4)) for _ in range(20_000)], np.uint32)
    last = np.arange(len(ids)) == len(ids) - 1
    _, symbols, _ = repair.compress(ids, last)
    pairs = {}
    for a, b in zip(symbols.tolist(), symbols.tolist()[1:]):
        pairs[a, b] = pairs.get((a, b), 0) + 1
    assert max(pairs.values()) < repair.LEAST


def test_slots_are_kept_from_round_to_round(monkeypatch):
    """All slots are counted once, whatever the number of rounds; later only those beside what was replaced."""
    seen, slots = [], repair._slots
    monkeypatch.setattr(repair, "_slots", lambda a, b: (seen.append(len(a)), slots(a, b))[1])
    rng = random.Random(6)
    words = [[rng.randrange(50_000) for _ in range(rng.randrange(2, 9))] for _ in range(40)]
    ids = np.array([i for _ in range(20_000) for i in rng.choice(words)] + list(range(100_000)), np.uint32) % 60_000
    last = np.arange(len(ids)) % 500 == 499
    last[-1] = True
    rules, symbols, _ = repair.compress(ids, last)
    assert (repair.expand(symbols, rules) == ids).all()
    # Beside each symbol taken away two slots change; pairs that are candidates are hashed as well.
    assert len(seen) > 10 and sum(n >= len(symbols) for n in seen) <= 2 and sum(seen) < len(ids) + 3 * (len(ids) - len(symbols)) + 20_000


def test_random_access_and_odd_rows(spark, plain):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(None, "no id", "x"), (3, ODD[3], "y"), (3, "other", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    path = scratch_dir(spark, "t") + "/s"
    repair.write_ids(docs, path, 3)
    shards = [r.asDict() for r in spark.read.parquet(path).collect()]
    wanted = sorted(crc(plain(t)) for _, t, _ in rows)
    assert sorted(crc(repair.read_range(s, k)) for s in shards for k in range(len(s["doc_ids"]))) == wanted
    for s in shards:
        for k, n in enumerate(s["doc_tokens"]):
            whole = repair.read_range(s, k).tolist()
            assert len(whole) == n
            for a, size in ((0, 1), (n // 2, 7), (n - 1, 5), (n, 3)):
                assert repair.read_range(s, k, a, size).tolist() == whole[a:a + size]
    got = repair.read_digests(spark.read.schema(repair.SHARD).parquet(path)).collect()
    assert sorted(r.ids_crc32 for r in got) == wanted
    first = min(got, key=lambda r: r.start)
    assert first.doc_id is None and first.start == 0
    repair.write_ids(docs.limit(0), path + "0", 2)
    assert repair.read_digests(spark.read.schema(repair.SHARD).parquet(path + "0")).count() == 0


def check_places(rows, want, size=1024):
    """Every id in one piece, sequences gapless; the share of padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == want.keys()
    for d, ids in want.items():
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
    padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= size
        padded += 0 if at & (at - 1) == 0 else size - at
    assert sorted(by_seq) == list(range(len(by_seq)))
    return padded / sum(map(len, want.values()))


def test_op7_places(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    waste = check_places(QUERIES["op7_packing"](spark, SF).collect(), {d: plain(t) for d, t in docs})
    assert waste < 0.02


@pytest.mark.parametrize("rank_rows", [200_000, 3])
def test_packing_of_odd_rows(spark, plain, monkeypatch, rank_rows):
    monkeypatch.setattr(packing, "RANK_ROWS", rank_rows)
    rows = [(k, t, 1.5) for k, t in enumerate(ODD)] + [(100 + k, "same text", 2.5) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset double")
    places, pieces = packing.pack_documents(docs)
    check_places(places.collect(), {d: plain(t) for d, t, _ in rows})
    whole = packing.sequences(places, pieces).collect()
    assert sum(r.length for r in whole) == sum(len(plain(t)) for _, t, _ in rows)
    assert all(len(r.ids) == 4 * r.length for r in whole)
    twice = docs.union(docs).unionByName(spark.createDataFrame([(None, "x", 0.0)], docs.schema))
    got = packing.pack_documents(twice)[0].collect()
    assert sum(r.length for r in got) == 2 * sum(len(plain(t)) for _, t, _ in rows) + len(plain("x"))
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert packing.pack_documents(docs.limit(0))[0].count() == 0


def test_best_fill_is_best():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 90)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
        fill = packing.best_fill(counts, room)
        assert sum(k * n for k, n in fill.items()) == max(sums) and all(counts[k] >= n for k, n in fill.items())


def test_a_worker_gives_back_what_packing_needed():
    """Beside a full heap an executor has little room; a worker that waits holds a bounded store and little else."""
    code = """
import random
from unittest.mock import MagicMock
import corpus_pipeline
import pyarrow as pa
from millrace.llm import packing, tokens

def held():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) / 1024

def batches():
    draw = random.Random(1)
    for k in range(11):
        texts = [" ".join(str(draw.randrange(10**8)) for _ in range(5000)) for _ in range(20)]
        yield pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), pa.array(texts)], names=["doc_id", "text"])

docs, packing.F = MagicMock(), MagicMock()
packing.cut = lambda df, label: [len(set(b.column(0).to_pylist())) for b in df]
packing.pack = lambda found, size: found
docs.select.return_value.mapInArrow = lambda run, schema: run(batches())
tokens.encoder(tokens.default_tokenizer()).encode(["one"])
before = held()
print(sum(corpus_pipeline.pack(None, docs, '')), held() - before)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parents[2], timeout=300)
    assert done.returncode == 0, done.stderr
    documents, grown = map(float, done.stdout.split())
    # Of 1.1 million distinct stretches.
    assert documents == 220 and grown < 150
