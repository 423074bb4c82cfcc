"""CSV records whose quoted values hold line breaks, from scans that are split.

Whether a line starts a record depends on all lines before it. But what a line does is one of four
maps of the state (in quotes or not): it keeps the state, turns it, or ends in one state whatever it
was. Such maps are composed within each byte range first, then over the ranges of a file, which are
few; so each range learns the state it starts in, and no file is read by one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_dir

# A quoted part up to the quote that may close it; quotes within are doubled. No step goes back.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'


def _patterns(sep: str) -> tuple[str, str, str]:
    """Whether a line ends in quotes: one read from outside, one from inside that stays, one that opens anew."""
    s = re.escape(sep)
    other = f"[^{s}]" if len(sep) == 1 else f"(?!{s})."
    field = f'(?:"{_QUOTED}"(?:{other})*+|(?!"){other}(?:{other})*+)?+{s}'
    opened = f'(?:{field})*+"{_QUOTED}$'
    return f"(?s)^{opened}", f"(?s)^{_QUOTED}$", f'(?s)^{_QUOTED}"(?:{other})*+{s}{opened}'


def _lines(spark: SparkSession, files: Sequence[str], encoding: str) -> DataFrame:
    """file, block (first byte of the range), at (order within it) and value of every line."""
    text = spark.read.option("lineSep", "\n").option("encoding", encoding).text(list(files))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def has_open_lines(spark: SparkSession, files: Sequence[str], sep: str = ",", encoding: str = "utf-8") -> bool:
    """Whether a line of some file ends within quotes, read alone: one scan, and it stops at the first one."""
    return not _lines(spark, files, encoding).filter(F.col("value").rlike(_patterns(sep)[0])).select("file").limit(1).isEmpty()


def csv_records(
    spark: SparkSession, files: Sequence[str], sep: str = ",", encoding: str = "utf-8", skiprows: int = 0
) -> DataFrame:
    """file, text and head (whether it is the file's first) of every record; blank lines are none.

    ``skiprows`` lines at the start of each file are no part of a record. A file that ends within
    quotes is an error. The lines are written once, with what each needs to know; only those of
    records of several lines are exchanged again.
    """
    outside, stays, anew = _patterns(sep)
    per_range = Window.partitionBy("file", "block").orderBy("at")
    before = per_range.rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("value")
    lines = _lines(spark, files, encoding).withColumn("n", F.row_number().over(per_range).cast("long"))
    lines = lines.withColumn("skip", (F.col("block") == 0) & (F.col("n") <= skiprows))
    # Lines without a quote, most of them, keep the state.
    plain = F.col("skip") | ~F.contains(v, F.lit('"'))
    lines = lines.withColumn("to_out", ~plain & v.rlike(outside)).withColumn("to_in", plain | v.rlike(stays) | v.rlike(anew))
    fixed = F.when(F.col("to_out") == F.col("to_in"), F.col("to_in"))
    lines = lines.withColumn("fixed", fixed).withColumn("turns", (F.col("to_out") & ~F.col("to_in")).cast("long"))
    lines = lines.withColumn("turned", F.sum("turns").over(per_range))
    last = F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turned"))
    staged = lines.withColumn("last", F.last(last, True).over(per_range)).select(
        "file", "block", "n", "skip", "to_out", "to_in", "value", "turned", "last",
        F.last(last, True).over(before).alias("p_last"), (F.col("turned") - F.col("turns")).alias("p_turned"))
    path = f"{scratch_dir(spark, 'csv')}/lines"
    staged.write.option("compression", "zstd").parquet(path)
    lines = spark.read.schema(staged.schema).parquet(path)

    # What each range does as a whole, and the state it starts in.
    ranges = lines.groupBy("file", "block").agg(F.max_by(F.struct("last", "turned"), "n").alias("end"))
    ranges = ranges.select("file", "block", *_effect(F.col("end.last"), F.col("end.turned")))
    upto = Window.partitionBy("file").orderBy("block")
    ranges = ranges.withColumn("turned", F.sum("turn").over(upto))
    known = F.when(F.col("ends").isNotNull(), F.struct(F.col("ends").alias("fixed"), "turned"))
    prior = upto.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("known", F.last(known, True).over(upto)).select(
        "file", "block", F.coalesce(_state(F.col("known"), F.col("turned")), F.lit(False)).alias("after"),
        F.coalesce(_state(F.last(known, True).over(prior), F.col("turned") - F.col("turn")), F.lit(False)).alias("open"))
    ends = ranges.groupBy("file").agg(F.max_by("after", "block").alias("open")).filter("open").select("file").limit(3).collect()
    if ends:
        raise ValueError(f"quotes are not closed at the end of {[r['file'] for r in ends]}")

    local = F.when(F.col("p_last").isNotNull(), F.col("p_last.fixed") != ((F.col("p_turned") - F.col("p_last.turned")) % 2 == 1))
    rows = lines.join(ranges.select("file", "block", "open"), ["file", "block"]).withColumn(
        "inside", F.coalesce(local, F.col("open") != (F.col("p_turned") % 2 == 1)))
    rows = rows.withColumn("goes_on", F.when(F.col("inside"), F.col("to_in")).otherwise(F.col("to_out"))).filter(~F.col("skip"))
    single = rows.filter(~F.col("inside") & ~F.col("goes_on")).select("file", "block", "n", "value")
    parts = rows.filter(F.col("inside") | F.col("goes_on"))
    # A part belongs to the last start before it: in its range, or the last of the ranges before.
    parts = parts.withColumn("first", F.last(F.when(~F.col("inside"), F.col("n")), True).over(Window.partitionBy("file", "block").orderBy("n")))
    starts = parts.groupBy("file", "block").agg(F.max("first").alias("n")).filter(F.col("n").isNotNull())
    borders = lines.select("file", "block").distinct().join(starts, ["file", "block"], "left").select(
        "file", "block", F.last(F.when(F.col("n").isNotNull(), F.struct(F.col("block"), F.col("n"))), True).over(prior).alias("from"))
    parts = parts.join(borders, ["file", "block"], "left").select(
        "file", F.when(F.col("first").isNotNull(), F.col("block")).otherwise(F.col("from.block")).alias("s_block"),
        F.coalesce("first", F.col("from.n")).alias("s_n"), F.struct("block", "n", "value").alias("part"))
    joined = parts.groupBy("file", "s_block", "s_n").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["value"]), "\n").alias("value")
    ).select("file", F.col("s_block").alias("block"), F.col("s_n").alias("n"), "value")
    records = single.unionByName(joined).withColumn("head", (F.col("block") == 0) & (F.col("n") == skiprows + 1))
    # The line break before \n, and the mark some files start with.
    text = F.regexp_replace("value", r"\r\z", "")
    text = F.when(F.col("head"), F.regexp_replace(text, "^﻿", "")).otherwise(text)
    return records.select("file", text.alias("text"), "head").filter(F.col("head") | (F.trim("text") != ""))


def _effect(last: Column, turned: Column) -> list[Column]:
    """The state a range ends in whatever it was, else NULL, and whether it turns it."""
    ends = F.when(last.isNotNull(), last["fixed"] != ((turned - last["turned"]) % 2 == 1))
    return [ends.alias("ends"), F.when(last.isNull(), turned % 2).otherwise(0).alias("turn")]


def _state(known: Column, turned: Column) -> Column:
    """The state after ranges: a file starts outside; after a range that ends in one state, by the turns since."""
    since = F.when(known.isNotNull(), known["fixed"] != ((turned - known["turned"]) % 2 == 1))
    return F.coalesce(since, turned % 2 == 1)


def parse_strings(spark: SparkSession, texts: DataFrame, **options) -> DataFrame:
    """Records as a frame with inferred types and positional names; ``texts`` has one column of them."""
    reader = spark.read.options(**options, inferSchema=True)
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(strings), spark)
