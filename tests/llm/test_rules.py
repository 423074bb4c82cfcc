import math
import re

import duckdb
import numpy as np
import pytest

from check import rows_of
from millrace.llm import line_dedup as L
from millrace.llm import quality_rules as Q
from millrace.llm import url_filters as U
from millrace.llm.queries import ORACLES, QUERIES
from tests.conftest import SF, plan

GAPS = re.compile("[\x20\x09-\x0d]+")
DIRTY = [None, "", " \n\t", "one", "a b c d e f g h i j k", "w " * 12, "x y z\nx y z\n\nx y z", "é È 日本 # | $" * 4, "big " * 90_000,
         "a b c d e a b c d e f a b c d e", "\x0b\x0cv\x0bw\x0c" * 8, "line\nline\n \nline", "A\u00a0B c\u2003d " * 5]


def counts(text):
    text = text or ""
    words = [w for w in GAPS.split(text) if w]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if GAPS.sub("", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(lines), sum(c.isupper() for c in text))


def test_statistics(spark):
    texts = DIRTY + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame([(k, t, None, "s", 5) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, q_words int")
    got = {r.doc_id: tuple(r.q) for r in Q.add_statistics(docs).select("doc_id", "q").collect()}
    for k, t in enumerate(texts):
        assert got[k] == counts(t), t


def brute_kept(rows):
    """rows of (key, text, lang, source): verdict by the same estimate in numpy."""
    stats = {k: counts(t) for k, t, _, _ in rows}
    base = {k: s[0] < 10 or 100 * s[4] > 20 * s[0] for k, s in stats.items()}
    share = lambda a, b: math.asin(math.sqrt(min(1.0, a / b if b else 0.0)))
    vec = {k: [math.log1p(s[0]), math.log(s[1] / s[0]) if s[0] and s[1] else 0.0, share(s[2], s[1]), share(s[3], s[5]), share(s[4], s[0]), share(s[6], s[1])]
           for k, s in stats.items()}
    groups = {}
    for k, _, lang, source in rows:
        if not base[k]:
            groups.setdefault((lang, source), []).append(k)
    name = {}
    for g, ks in groups.items():
        left = sum(len(v) for h, v in groups.items() if h[0] == g[0] and len(v) < Q.MIN_GROUP)
        name[g] = g if len(ks) >= Q.MIN_GROUP else (g[0], "all") if left >= Q.MIN_GROUP else "all"
    pooled = {}
    for g, ks in groups.items():
        pooled.setdefault(name[g], []).extend(ks)
    spread = np.array(list(Q.SPREAD.values()))
    far = {}
    for g, ks in pooled.items():
        of = ks if len(ks) >= Q.MIN_GROUP else [k for k in vec if not base[k]]
        x = np.array([vec[k] for k in of])
        low, mid, high = (np.sort(x, axis=0)[math.ceil(p * len(x)) - 1] for p in (0.25, 0.5, 0.75))
        mean, cov = mid, np.diag(((high - low) / 1.349) ** 2 + spread**2)
        for _ in range(Q.STEPS):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            bins = np.floor(16 * np.log2(d + 2.0**-20))
            ranked = np.sort(bins)
            use = bins <= ranked[math.ceil(Q.SUPPORT * len(x)) - 1]
            mean = x[use].mean(axis=0)
            cov = Q.CONSISTENCY * np.cov(x[use].T, bias=True) + np.diag(spread**2)
        for k in ks:
            v = np.array(vec[k]) - mean
            far[k] = v @ np.linalg.inv(cov) @ v
    return {k: not base[k] and far.get(k, 0.0) <= Q.CUTOFF for k in stats}, far


def test_verdicts_equal_numpy(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    want, far = brute_kept(rows)
    got = QUERIES["op6_quality_rules"](spark, "/root/testdata/sf0.01")
    assert "Python" not in plan(got)
    got = got.collect()
    assert {r.doc_id: r.kept for r in got} == want
    assert all(math.isclose(r.distance, far[r.doc_id], rel_tol=1e-6, abs_tol=1e-9) for r in got if r.doc_id in far)
    assert any(not r.kept and not r.base_failed for r in got)


@pytest.mark.parametrize("n", [1, 2, 110, 400])
def test_every_text_has_a_distance(spark, n):
    """Few texts, or a few of other languages beside many, are judged by the estimate of all."""
    some = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(n).collect()
    rows = [(r.doc_id, r.text, "aa" if n == 400 and r.doc_id % 9 else r.lang, "one") for r in some]
    want, far = brute_kept(rows)
    got = Q.score(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), ["doc_id"]).collect()
    assert all((r.distance is None) == r.base_failed or r.distance is not None for r in got)
    assert {r.doc_id: r.kept for r in got} == want
    assert all(math.isclose(r.distance, far[r.doc_id], rel_tol=1e-6, abs_tol=1e-9) for r in got if r.doc_id in far)


def test_quality_rules_of_odd_rows(spark):
    rows = [(k % 7 if k % 7 else None, t, [None, "en"][k % 2], None, 1, "x") for k, t in enumerate(DIRTY * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept int, g string")
    kept = Q.quality_rules(docs)
    assert kept.columns == docs.columns
    want, far = brute_kept([(k, t, lang, source) for k, (_, t, lang, source, *_) in enumerate(rows)])
    assert sorted(r.text for r in kept.collect()) == sorted(rows[k][1] for k in want if want[k])
    assert len(far) == sum(counts(t)[0] >= 10 and 100 * counts(t)[4] <= 20 * counts(t)[0] for _, t, *_ in rows)
    assert Q.quality_rules(docs.limit(0)).count() == 0


def brute_lines(rows, span):
    """rows of (order, text) in order: texts without later repeated runs."""
    first, out = {}, []
    for d, (order, text) in enumerate(rows):
        lines = text.split("\n") if text is not None else []
        no = [i for i, x in enumerate(lines) if GAPS.sub("", x)]
        for j in range(len(no) - span + 1):
            key = tuple(lines[i] for i in no[j:j + span])
            first[key] = min(first.get(key, (order, j)), (order, j))
    for order, text in rows:
        if text is None:
            out.append((text, 0))
            continue
        lines = text.split("\n")
        no = [i for i, x in enumerate(lines) if GAPS.sub("", x)]
        gone = set()
        for j in range(len(no) - span + 1):
            if first[tuple(lines[i] for i in no[j:j + span])] < (order, j):
                gone.update(no[j:j + span])
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text, len(gone)))
    return out


@pytest.mark.parametrize("window,gram", [(2, 1), (1, 1), (3, 2), (4, 1)])
def test_line_dedup(spark, window, gram):
    rng = np.random.default_rng(4)
    texts = DIRTY + ["\n".join(f"l{x}" if x else " " for x in rng.integers(0, 6, rng.integers(0, 30))) for _ in range(60)] + ["same\n" * 5000]
    rows = [(d, t) for d, t in enumerate(texts)]
    docs = spark.createDataFrame([(d, t, len(t or ""), "x") for d, t in rows], "doc_id long, text string, n_chars long, row string")
    got = L.line_dedup(docs, window, gram, counts=True)
    assert got.columns == [*docs.columns, "n_lines", "n_removed", "n_runs"] and "Python" not in plan(got)
    want = brute_lines(rows, window + gram - 1)
    got = {r.doc_id: r for r in got.collect()}
    for (d, _), (text, n) in zip(rows, want):
        assert (got[d].text, got[d].n_removed) == (text, n)
        assert text is None or got[d].n_chars == len(text)


def test_line_dedup_of_odd_rows(spark):
    two = "first line\nsecond line"
    docs = spark.createDataFrame([(None, two), (None, None), (4, two), (4, two), (9, two + "\n \nmore"), (2, "x\n" + two)], "doc_id long, text string")
    got = sorted(str((r.doc_id, r.text)) for r in L.line_dedup(docs).collect())
    assert got == sorted(map(str, [(None, ""), (None, None), (4, ""), (4, ""), (9, " \nmore"), (2, "x\n" + two)]))
    assert L.line_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op5_line_dedup", "op9_url_filters"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    assert "Python" not in plan(got)
    assert rows_of(got.toPandas()) == rows_of(con.sql(ORACLES[name]).df())


@pytest.mark.parametrize("broadcast", [8 << 20, 0])
def test_url_filters(spark, monkeypatch, broadcast):
    monkeypatch.setattr(U, "BROADCAST_RULE_BYTES", broadcast)
    rules = [("net", "/", "block"), ("Example.net", "/en/", "allow"), ("example.net", "/en/", "block"), ("b.example.net", "/e", "allow"), ("org", "", "block"),
             ("x.org", "", "allow"), (None, "/", "block"), ("com", None, "block"), ("", "", "block"), ("com", "/q", "deny"), ("1.2", "/é", "block")]
    urls = [None, "", "no scheme", "http://", "http://net", "http://NET/", "https://a.b.net/x?y#z", "ftp://example.net/en/1", "http://a.b.example.net/exit",
            "http://notexample.net/en/", "http://x.org", "http://y.org?x/z", "http://a.x.org#/", "http://com/q", "a://b://c.net/d", "http://9.1.2/éa", "http://.net/",
            "http://" + "a." * 3000 + "net/" + "p" * 90_000, "http://u@Ünet/"] * 2
    kept = [(h.lower(), p, a) for h, p, a in rules if h and p is not None and a in ("allow", "block")]
    want = []
    for k, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in kept if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        want.append((k, host, path, best and best[3], best[4] if best else "allow"))
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, host string")
    frame = spark.createDataFrame(rules, "host string, path string, action string")
    got = U.judge_urls(pages, frame)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {r.verdict for r in U.judge_urls(pages, frame.limit(0)).collect()} == {"allow"}
    assert U.judge_urls(pages.limit(0), frame).count() == 0
