"""The registered queries of this package, and SQL where it can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, fill_middle, language_id, line_dedup, packing, periodic_runs, quality_classifier, quality_rules
from millrace.llm import quartile_digest, repair, repeated_bytes, simhash, url_filters
from millrace.llm.common import text_bytes
from millrace.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


#: SQL of the lines of documents that line dedup keeps, for spans of two lines.
SQL_LINES = r"""
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
          FROM documents WHERE text IS NOT NULL),
worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j,
                  lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS after
           FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
firsts AS (SELECT line, after, min((doc_id, j)) AS place FROM worded WHERE after IS NOT NULL GROUP BY line, after),
starts AS (SELECT w.doc_id, w.j FROM worded w JOIN firsts f ON w.line = f.line AND w.after = f.after WHERE f.place < (w.doc_id, w.j)),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, j FROM starts UNION ALL SELECT doc_id, j + 1 FROM starts)),
removed AS (SELECT w.doc_id, w.i, w.j FROM worded w JOIN gone g ON w.doc_id = g.doc_id AND w.j = g.j),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
         FROM lines l LEFT JOIN removed r ON l.doc_id = r.doc_id AND l.i = r.i WHERE r.i IS NULL GROUP BY l.doc_id)
"""


@query("op5_line_dedup", f"""
WITH {SQL_LINES},
runs AS (SELECT doc_id, count(*) AS n_removed, sum(CASE WHEN before IS NULL OR before < j - 1 THEN 1 ELSE 0 END)::BIGINT AS n_runs
         FROM (SELECT *, lag(j) OVER (PARTITION BY doc_id ORDER BY j) AS before FROM removed) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
       coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.text, '')) END AS kept_md5
FROM documents d LEFT JOIN runs USING (doc_id) LEFT JOIN kept k ON d.doc_id = k.doc_id
""")
def op5(t):
    """Later repeated runs of two or more lines, deleted from every document."""
    docs = t("documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs, counts=True).select("doc_id", "n_lines", "n_removed", "n_runs", F.md5("text").alias("kept_md5"))


@query("op6_quality_rules")
def op6(t):
    """Word statistics of every document, base rules and the robust outlier verdict."""
    judged = quality_rules.score(t("documents"), ["doc_id"])
    return judged.select(
        "doc_id", *[F.col(f"q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", "kept", "distance",
    )


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op9_url_filters", """
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split s LEFT JOIN best USING (page_id)
""")
def op9(t):
    """Every page's URL against the rule list."""
    pages = t("pages")
    return url_filters.judge_urls(pages, pages.sparkSession.createDataFrame(URL_RULES, "host string, path string, action string"))


@query("op3_simhash")
def op3(t):
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(t("documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op7_packing")
def op7(t):
    """Every piece of every document and its place in the packed sequences."""
    return packing.pack_documents(t("documents"))[0]


@query("op1_token_files")
def op1(t):
    """Digests of all documents' ids, read back from the files they were written to."""
    docs = t("documents")
    return repair.round_trip(docs, 1 + text_bytes(docs) // repair.TASK_BYTES)


@query("op4_language_id")
def op4(t):
    """The predicted language of every document."""
    docs = t("documents")
    return language_id.predict(docs, language_id.train(docs))


@query("op8_quality_classifier")
def op8(t):
    """The quality score of every document."""
    docs = t("documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, t("labels")))


@query("op2_decontamination")
def op2(t):
    """The benchmark items that each document holds a near copy of, nearest first."""
    found = decontamination.annotate(t("documents").select("doc_id", "text"), t("benchmark"), "hits")
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"),
        F.col("hits.item_id").alias("item_ids"), F.try_element_at("hits", F.lit(1))["distance"].alias("least_distance"),
    )


@query("op10_repeated_bytes")
def op10(t):
    """What every document loses to strings that documents before it hold."""
    found = repeated_bytes.repeated_bytes(t("documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of a tenth of the ids, the words from a place on repeat with a period, both drawn by the id."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    return words[:a] + words[a : a + p] * times + words[a : a + rest]


@query("op11_periodic_runs")
def op11(t):
    """Runs of every document's words, some with a period planted, and digests of what is left of one period each."""
    found = periodic_runs.periodic_runs(t("documents"), planted_period)
    # Of equal lengths the least start, then the least period, is first.
    best = F.try_element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("longer"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), F.lit(1))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words",
    )


@query("op12_fill_middle", """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT doc_id, text, regexp_extract_all(text, '(?s)[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM texts),
drawn AS (SELECT *, len(units) AS n,
                 ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM cut),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s FROM formed),
made AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM parts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM made
""")
def op12(t):
    """Every document in its fill-in-middle form, and the text rebuilt from it."""
    made = fill_middle.fill_middle(t("documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op13_fingerprints")
def op13(t):
    """Fingerprints of every document and of its half edited text, and how alike they and the next document's are."""
    return quartile_digest.half_edited(t("documents"))
