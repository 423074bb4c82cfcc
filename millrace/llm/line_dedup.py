"""Line dedup by winnowing over line hashes.

A document is its lines that have a word. Of every ``window`` consecutive line-gram hashes the least
one is a fingerprint, so a run of ``window + gram - 1`` lines (the span) that stands in two places
has a fingerprint in common there. Fingerprints found in one place only end the search for most of
the text. Where one is found twice, the spans that chose it are compared with the earliest equal
span; neighbouring spans that match join into one run, which thereby extends both ways as far as
the lines agree. Every run that stands earlier as well is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut

WINDOW = 2
GRAM = 1
LAST = (1 << 63) - 1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _worded(lines: Column) -> Column:
    """Structs of number and text of the lines that have a word."""
    return F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("no"), x.alias("line"))),
        lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"),
    )


def _key() -> list[Column]:
    """Order and identity of a document; a null id comes last."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k_doc"), F.xxhash64("text").alias("k_text")]


def spans(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """One row per span: its document, first line, chosen fingerprint with position, 128-bit key."""
    span = window + gram - 1
    df = docs.where(F.col("text").isNotNull()).select(*_key(), F.transform(_worded(_lines(F.col("text"))), lambda x: x["line"]).alias("w"))
    df = df.where(F.size("w") >= span).select(
        "k_doc", "k_text", F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
        F.transform("w", lambda x: F.xxhash64(F.lit("second"), x)).alias("h2"),
    )
    grams = F.col("h") if gram == 1 else F.transform(
        F.sequence(F.lit(1), F.size("h") - (gram - 1)), lambda i: F.xxhash64(F.slice("h", i, gram)))
    df = df.select("k_doc", "k_text", "h", "h2", grams.alias("g"))

    def one(i: Column) -> Column:
        seen = F.slice("g", i, window)
        least = F.array_min(seen)
        # The rightmost of equal minima, so that neighbouring windows choose the same one.
        at = i + window - F.array_position(F.reverse(seen), least)
        return F.struct(
            i.alias("at"), least.alias("mark"), at.alias("mark_at"),
            F.xxhash64(F.slice("h", i, span)).alias("a"), F.xxhash64(F.slice("h2", i, span)).alias("b"),
        )

    return df.select("k_doc", "k_text", F.explode(
        F.transform(F.sequence(F.lit(1), F.size("h") - (span - 1)), one)).alias("s")).select("k_doc", "k_text", "s.*")


def repeated_spans(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Document and first line of every span that also stands earlier."""
    every = cut(spans(docs, window, gram), "line-spans")
    place = F.struct("k_doc", "k_text", "mark_at")
    common = every.groupBy("mark").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select("mark")
    met = every.join(common, "mark", "left_semi")
    first = met.groupBy("a", "b").agg(F.min(F.struct("k_doc", "k_text", "at")).alias("first"))
    return met.join(first, ["a", "b"]).where(F.col("first") < F.struct("k_doc", "k_text", "at")).select("k_doc", "k_text", "at")


def line_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, counts: bool = False) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from ``text`` (and ``n_chars`` brought up to date).

    Earlier means a smaller doc_id (null ids last; equal ids in the order of a hash of their texts),
    then a smaller line number; the first place of a run keeps it. Lines are compared as they stand.
    Lines without a word are never deleted, nor do they end a run. A text whose lines are all
    deleted becomes empty; null stays null, and empty texts and single lines stay as they are. Rows
    that repeat id and text are one document and get the same result. Other columns are kept as they
    are. With ``counts``, columns n_lines, n_removed and n_runs (maximal deleted runs) are added,
    over columns of these names.
    """
    span = window + gram - 1
    found = repeated_spans(docs, window, gram).distinct().groupBy("k_doc", "k_text").agg(F.sort_array(F.collect_list("at")).alias("k_at"))
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *_key())
    df = row.join(found, ["k_doc", "k_text"], "left")
    df = df.withColumn("k_lines", _lines(F.col("row.text")))
    df = df.withColumn("k_no", F.when(F.col("k_at").isNotNull(), F.transform(_worded(F.col("k_lines")), lambda x: x["no"])))
    df = df.withColumn("k_gone", F.array_distinct(F.flatten(F.transform("k_at", lambda s: F.slice("k_no", s, span)))))
    left = F.array_except(F.sequence(F.lit(0), F.size("k_lines") - 1), F.col("k_gone"))
    df = df.withColumn("k_new", F.when(F.col("k_at").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("k_lines", i)), "\n")))
    out = []
    for c in names:
        if c == "text":
            out.append(F.col("k_new").alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("k_at").isNull(), F.col("row.n_chars")).otherwise(F.length("k_new")).cast(docs.schema[c].dataType).alias(c))
        elif not (counts and c in ("n_lines", "n_removed", "n_runs")):
            out.append(F.col(f"row.`{c}`").alias(c))
    if counts:
        gaps = F.filter(F.transform("k_at", lambda s, i: s - F.get("k_at", i - 1)), lambda gap: gap > span)
        out += [
            F.when(F.col("row.text").isNull(), 0).otherwise(F.size("k_lines")).cast("long").alias("n_lines"),
            F.when(F.col("k_at").isNull(), 0).otherwise(F.size("k_gone")).cast("long").alias("n_removed"),
            F.when(F.col("k_at").isNull(), 0).otherwise(1 + F.size(gaps)).cast("long").alias("n_runs"),
        ]
    return df.select(*out)
