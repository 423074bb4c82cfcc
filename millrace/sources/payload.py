"""Landed API payloads (S5, S6) and locating records in them.

A payload is one JSON document per file (or per row). Its shape may be undeclared, so it is
parsed to VARIANT and only the record fields that are asked for get a type.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shaping import flatten

# Keys that may hold the record list, in order of preference.
RECORD_KEYS = ("results", "data", "items")


def read_payloads(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """``payload`` VARIANT and ``file``; one document per file, or per line.

    Malformed documents are an error, as they are for a JSON parser.
    """
    raw = spark.read.text(path, wholetext=not per_line)
    return raw.select(F.parse_json("value").alias("payload"), F.col("_metadata.file_path").alias("file"))


def json_path(chain: Sequence[str | int]) -> str:
    """Keys and list indexes to a path; digit strings are indexes."""
    steps = []
    for key in chain:
        if isinstance(key, int) or str(key).isdigit():
            steps.append(f"[{int(key)}]")
        else:
            steps.append("['" + str(key).replace("'", "\\'") + "']")
    return "$" + "".join(steps)


def dig(payload: Column, chain: Sequence[str | int], as_type: str = "variant") -> Column:
    """The value at the end of a key chain, NULL if a step is missing."""
    return F.try_variant_get(payload, json_path(chain), as_type)


def record_list(payload: Column, chain: Sequence[str | int] | None = None) -> Column:
    """The array of records of a payload.

    With a chain: the list it leads to, the value there as the only record, no record if it is
    null. Otherwise, or if the chain leads nowhere: the root list, else the first list under a
    known key, else the whole root as one record.
    """
    found = []
    if chain:
        target = dig(payload, chain)
        found.append(F.when(F.is_variant_null(target), F.array().cast("array<variant>")))
        found.append(F.try_variant_get(target, "$", "array<variant>"))
        found.append(F.when(target.isNotNull(), F.array(target)))
    found.append(F.try_variant_get(payload, "$", "array<variant>"))
    found += [F.try_variant_get(payload, f"$.{key}", "array<variant>") for key in RECORD_KEYS]
    return F.coalesce(*found, F.array(payload))


def explode_records(payloads: DataFrame, chain: Sequence[str | int] | None = None) -> DataFrame:
    """One row per record, column ``record`` (VARIANT)."""
    return payloads.select(F.explode(record_list(F.col("payload"), chain)).alias("record"))


def explode_pages(payloads: DataFrame, chain: Sequence[str | int]) -> DataFrame:
    """Records of all landed pages; an empty, null or missing page yields no rows."""
    rows = F.try_variant_get(F.col("payload"), json_path(chain), "array<variant>")
    return payloads.select(F.explode(rows).alias("record"))


def numbered_pages(
    payloads: DataFrame, page: Sequence[str | int], pages: Sequence[str | int], sets: Sequence[str] = ()
) -> DataFrame:
    """``sets``, ``page`` and ``pages`` (how many the page says there are) of every landed page, and the payload.

    ``sets`` are columns beside ``payload`` that tell page sets apart, e.g. their folder or indicator.
    """
    number = lambda chain: F.try_variant_get("payload", json_path(chain), "bigint")
    return payloads.select(*sets, number(page).alias("page"), number(pages).alias("pages"), "payload")


def missing_pages(numbered: DataFrame, sets: Sequence[str] = ()) -> DataFrame:
    """``sets`` and ``page`` of every page that a landed one promises and none is; NULL sets are one set."""
    promised = numbered.groupBy(*sets).agg(F.max("pages").alias("pages")).filter("pages >= 1")
    promised = promised.select(*sets, F.explode(F.sequence(F.lit(1).cast("bigint"), "pages")).alias("page"))
    landed = numbered.select(*[F.col(c).alias(f"_{c}") for c in sets], F.col("page").alias("_page")).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in sets], F.col("page") == F.col("_page"))
    return promised.join(landed, same, "left_anti")


def complete_pages(
    payloads: DataFrame, page: Sequence[str | int], pages: Sequence[str | int], sets: Sequence[str] = (), on_gap: str = "error"
) -> DataFrame:
    """Each page of each set once, whichever copy of it; a missing page is an error unless ``on_gap`` is ``ignore``.

    Pages without a number are kept as they are. Copies go by a digest of set and number, so of the
    pages only those of a number that landed twice are compared.
    """
    numbered = numbered_pages(payloads, page, pages, sets)
    if on_gap == "error":
        gaps = missing_pages(numbered, sets).limit(5).collect()
        if gaps:
            raise ValueError(f"landed pages are not complete; missing are {[r.asDict() for r in gaps]}")
    counted = numbered.filter("page IS NOT NULL").groupBy(*sets, "page").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = counted.select(*[F.col(c).alias(f"_{c}") for c in [*sets, "page"]])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*sets, "page"]])
    text = numbered.withColumn("_text", F.to_json("payload"))
    once = text.join(again, same, "left_semi").groupBy(*sets, "page").agg(F.min("_text").alias("_text"))
    once = once.select(*sets, F.parse_json("_text").alias("payload"))
    return numbered.join(again, same, "left_anti").select(*sets, "payload").unionByName(once)


def _ddl(dtype: T.DataType) -> str:
    """A type as text that Spark reads back, whatever its fields are called."""
    if isinstance(dtype, T.StructType):
        fields = (f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in dtype.fields)
        return f"struct<{', '.join(fields)}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_ddl(dtype.elementType)}>"
    return dtype.simpleString()


def _struct_ddl(text: str) -> str:
    """The text of a variant's schema as DDL: types are replaced, names are not.

    A type stands at the start, behind the colon of a field, or within an array. Names are put into
    backquotes first: they start an object or follow a comma, and a colon and a type follow them.
    """
    kind = r"(?:OBJECT<|ARRAY<|[A-Z_]+(?:\(\d+,\d+\))?(?:[,>]|$))"
    text = re.sub(rf"(OBJECT<|, )([^`]*?): (?={kind})", r"\1`\2`: ", text)
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"(^|: |ARRAY<)OBJECT<" if i == 0 else r"(: |ARRAY<)OBJECT<", r"\1STRUCT<", parts[i])
        parts[i] = re.sub(r"(: |ARRAY<)VOID(?=[,>]|$)", r"\1STRING", parts[i])
    return "".join(parts)


def infer_record_schema(records: DataFrame) -> T.StructType | None:
    """Schema holding every field of the records: one aggregation, one text back. None for scalars."""
    text = records.agg(F.schema_of_variant_agg("record")).first()[0]
    if text is None or not text.startswith("OBJECT<"):
        return None
    return T.DataType.fromDDL(_struct_ddl(text))


def typed_records(records: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """Records as columns; records that are no objects as the text column ``value``.

    A declared schema saves the inference pass.
    """
    if schema is None:
        schema = infer_record_schema(records)
        if schema is None:
            return records.select(F.try_variant_get("record", "$", "string").alias("value"))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    target = _ddl(schema)
    return records.select(F.try_variant_get("record", "$", target).alias("r")).select("r.*")


def payload_frame(
    payloads: DataFrame,
    records_key_chain: Sequence[str | int] | None = None,
    explode_properties: str | None = None,
    schema: T.StructType | str | None = None,
    max_level: int | None = 2,
    sep: str = ".",
) -> DataFrame:
    """Generic route: locate records, optionally keep one nested object (J7), flatten."""
    records = explode_records(payloads, records_key_chain)
    if explode_properties:
        records = records.select(dig(F.col("record"), [explode_properties]).alias("record"))
    return flatten(typed_records(records, schema), sep=sep, max_level=max_level)
