"""The corpus pipeline: documents through the operators of ``millrace.llm``, stage by stage.

Rejected documents go, later repeated lines go, one document of each group of near copies (SimHash of
four-word shingles, at most four differing bits) stays, what holds a benchmark passage goes, and the rest
is packed into training sequences. Each stage gives back the columns of documents, but for the last,
which gives the places of all pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination as benchmark
from millrace.llm import line_dedup as lines
from millrace.llm import packing, simhash
from millrace.llm import quality_rules as rules
from millrace.llm.common import cut
from millrace.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.quality_rules(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.line_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedupe(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmark.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, **packing.SPARING)[0]


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontaminate", decontaminate), ("pack", pack),
]
#: Iterated estimates, components, edit distances and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
