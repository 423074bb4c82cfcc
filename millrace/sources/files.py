"""File scans."""

from __future__ import annotations

import csv
from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import coerce, col, date_kinds, sql_cast
from millrace.functions.text import normalize_columns
from millrace.operators.shaping import flatten
from millrace.sources import records, storage

# At most this many skipped lines go into one broadcast.
HEAD_LINES_BROADCAST = 50_000

# A quote within quotes is doubled.
CSV = {"quote": '"', "escape": '"'}

# Cell texts that mean "missing" in a CSV file, besides the empty cell.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str | None = None,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Declare ``schema`` to save the type-inference scan.

    Files whose header differs from the schema are an error. With ``multi_line`` values may hold
    line breaks; files are split all the same. Without it such values are an error.
    """
    if not path:
        raise ValueError("path is required")
    sep, encoding = sep or ",", encoding or "UTF-8"
    files = storage.glob_files(spark, path)
    if _broken(spark, files, sep, encoding, multi_line):
        return _whole_records(spark, files, sep, encoding, schema)
    reader = spark.read.options(**CSV, enforceSchema=False)
    reader = reader.option("header", True).option("sep", sep).option("encoding", encoding)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def _broken(spark: SparkSession, files: Sequence[str], sep: str, encoding: str, multi_line: bool) -> bool:
    """Whether records hold line breaks; without ``multi_line`` that is an error, as they would come apart unseen."""
    found = bool(files) and records.has_open_lines(spark, files, sep, encoding)
    if found and not multi_line:
        raise ValueError("values with line breaks in quotes (or quotes that are not closed): set multi_line")
    return found


def _heads(found: DataFrame, sep: str) -> dict[str, tuple[str, ...]]:
    """Each distinct header, as text and as names."""
    texts = [r["text"] for r in found.filter("head").select("text").distinct().collect()]
    return {text: _column_names(next(csv.reader([text], delimiter=sep))) for text in sorted(texts)}


def _whole_records(
    spark: SparkSession, files: Sequence[str], sep: str, encoding: str, schema: T.StructType | str | None
) -> DataFrame:
    """Records with line breaks; the files have one header."""
    found = records.csv_records(spark, files, sep, encoding)
    heads = _heads(found, sep)
    if len(heads) != 1:
        raise ValueError(f"the headers differ: {sorted(heads)}")
    names = next(iter(heads.values()))
    rows = found.filter(~F.col("head")).select("text")
    if schema is None:
        return records.parse_strings(spark, rows, sep=sep, multiLine=True, **CSV).toDF(*names)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if [n.lower() for n in names] != [f.name.lower() for f in declared.fields]:
        raise ValueError(f"the header {list(names)} does not match the schema {declared.fieldNames()}")
    return rows.select(F.from_csv("text", _ddl(declared), {"sep": sep, "multiLine": "true", **CSV}).alias("row")).select("row.*")


def read_csv_files(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "utf-8",
    usecols: Sequence[str] | None = None,
    dtype: Mapping[str, str] | None = None,
    parse_dates: Sequence[str] | Mapping | None = None,
    na_values=None,
    skiprows: int = 0,
    infer: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Every file of a glob, united by column name.

    Spark aligns CSV files of one read by position. So files are grouped by their header
    (one short read per file) and each distinct header gets one reader; the few readers are
    united by name, missing columns become NULL.
    """
    files = storage.glob_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no files match {path}")
    heads = storage.head_lines(spark, files, skiprows + 1, encoding)
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file in files:
        if len(heads[file]) <= skiprows:
            continue  # no header line: nothing to read
        header = next(csv.reader([heads[file][skiprows].removeprefix("\ufeff")], delimiter=sep))
        groups[_column_names(header)].append(file)
    if not groups:
        raise ValueError(f"no columns to read in {path}")

    parts = []
    broken = _broken(spark, files, sep, encoding, multi_line)
    found = records.csv_records(spark, files, sep, encoding, skiprows) if broken else None
    for header, members in groups.items():
        raw = T.StructType([T.StructField(name, T.StringType()) for name in header])
        if found is not None:
            own = found.join(F.broadcast(spark.createDataFrame([(storage.uri(spark, f),) for f in members], "file string")), "file")
            parsed = F.from_csv("text", _ddl(raw), {"sep": sep, "multiLine": "true", **CSV})
            part = own.filter(~F.col("head")).select(parsed.alias("row")).select("row.*")
        elif skiprows:
            # What is broadcast has a bounded number of lines; more files are read in several parts.
            size = max(HEAD_LINES_BROADCAST // (skiprows + 1), 1)
            part = reduce(
                DataFrame.union,
                [
                    _skip_lines(spark, {f: heads[f] for f in members[i : i + size]}, raw, sep, encoding)
                    for i in range(0, len(members), size)
                ],
            )
        else:
            part = (
                spark.read.options(**CSV, header=True, sep=sep, encoding=encoding).schema(raw).csv(members)
            )
        if usecols:
            absent = [c for c in usecols if c not in header]
            if absent:
                raise ValueError(f"usecols not found in file: {absent}")
            part = part.select(*[col(c) for c in header if c in usecols])
        parts.append(part)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    df = null_texts(df, na_values)
    declared = {**(dtype or {}), **date_kinds(parse_dates)}
    return _typed(df, declared, infer)


def _column_names(header: Sequence[str]) -> tuple[str, ...]:
    """Distinct names: a repeated one gets ``.1``, ``.2``, an empty one its position."""
    names: list[str] = []
    for i, raw in enumerate(header):
        name = base = raw or f"Unnamed: {i}"
        n = 0
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return tuple(names)


def _skip_lines(
    spark: SparkSession, heads: Mapping[str, Sequence[str]], schema: T.StructType, sep: str, encoding: str
) -> DataFrame:
    """The data lines of files, without the first lines of each (``heads``).

    Rows have no place in a file once Spark splits it. But lines of one text are alike, so it
    does not matter which of them go: of every head line as many go as the head has. Lines that
    differ from the head lines of their file pass through one broadcast join.
    """
    lines = (
        spark.read.option("encoding", encoding)
        .text(list(heads))
        .select("value", F.col("_metadata.file_path").alias("file"))
        .filter(F.trim("value") != "")
    )
    counts = [
        (storage.uri(spark, file), text, n)
        for file, first in heads.items()
        for text, n in Counter(line.removeprefix("\ufeff") for line in first).items()
    ]
    skipped = F.broadcast(spark.createDataFrame(counts, "file string, value string, n bigint"))
    others = lines.join(skipped, ["file", "value"], "left_anti").select("value")
    alike = lines.join(skipped, ["file", "value"]).groupBy("file", "value").agg(
        (F.count(F.lit(1)) - F.first("n")).alias("left")
    )
    parsed = F.from_csv("value", _ddl(schema), {"sep": sep, **CSV})
    return others.unionByName(_repeat(alike)).select(parsed.alias("row")).select("row.*")


def _repeat(counted: DataFrame, portion: int = 10_000) -> DataFrame:
    """``value`` as often as ``left`` says; a large number is spread over tasks by portions."""
    portions = counted.filter(F.col("left") > 0).select(
        "value", "left", F.explode(F.sequence(F.lit(0), F.floor((F.col("left") - 1) / portion))).alias("i")
    )
    return portions.repartition("value", "i").select(
        "value", F.explode(F.sequence(F.lit(1), F.least(F.lit(portion), F.col("left") - F.col("i") * portion))).alias("_")
    ).select("value")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def null_texts(df: DataFrame, na_values) -> DataFrame:
    """Text cells that mean "missing" become NULL; ``na_values`` adds texts, for all columns or by column."""

    def extra(name: str) -> list[str]:
        value = na_values.get(name, []) if isinstance(na_values, Mapping) else na_values or []
        return [str(v) for v in ([value] if isinstance(value, (str, int, float)) else value)]

    return df.select(
        *[
            F.when(~col(f.name).isin(*MISSING_TEXTS, *extra(f.name)), col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in df.schema.fields
        ]
    )


def _typed(df: DataFrame, declared: Mapping[str, str], infer: bool) -> DataFrame:
    """Declared columns by policy; the rest by one aggregation over what they hold."""
    new: dict[str, Column] = {}
    for name, kind in declared.items():
        if name not in df.columns:
            continue
        kind = {"int64": "int", "Int64": "int", "float64": "float", "string": "str", "object": "str"}.get(kind, kind)
        known = kind in ("int", "float", "datetime", "str")
        new[name] = coerce(col(name), T.StringType(), kind) if known else sql_cast(col(name), T.StringType(), kind)
    open_columns = [c for c in df.columns if c not in new] if infer else []
    if open_columns:
        kinds = infer_kinds(df, open_columns)
        new.update({c: coerce(col(c), T.StringType(), k) for c, k in kinds.items() if k in ("int", "float")})
        new.update({c: F.lower(col(c)) == "true" for c, k in kinds.items() if k == "bool"})
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def infer_kinds(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """``int``, ``float``, ``bool`` or ``str`` for text columns: one aggregation, one row back."""
    text = T.StringType()
    counts = df.agg(
        *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(names)],
        *[F.count(coerce(col(c), text, "int")).alias(f"i{i}") for i, c in enumerate(names)],
        *[F.count(coerce(col(c), text, "float")).alias(f"f{i}") for i, c in enumerate(names)],
        *[F.count_if(col(c).rlike("[.eE]")).alias(f"p{i}") for i, c in enumerate(names)],
        *[F.count_if(F.lower(col(c)).isin("true", "false")).alias(f"b{i}") for i, c in enumerate(names)],
    ).first()
    kinds = {}
    for i, name in enumerate(names):
        if counts[f"n{i}"] and counts[f"i{i}"] == counts[f"n{i}"] and not counts[f"p{i}"]:
            kinds[name] = "int"
        elif counts[f"n{i}"] and counts[f"f{i}"] == counts[f"n{i}"]:
            kinds[name] = "float"
        elif counts[f"n{i}"] and counts[f"b{i}"] == counts[f"n{i}"]:
            kinds[name] = "bool"
        else:
            kinds[name] = "str"
    return kinds


def read_csv_normalized(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S3: types from the whole file, column names normalised."""
    files = storage.glob_files(spark, path)
    if _broken(spark, files, ",", "UTF-8", multi_line):
        return normalize_columns(_whole_records(spark, files, ",", "UTF-8", None))
    return normalize_columns(spark.read.options(**CSV).csv(path, header=True, inferSchema=True, samplingRatio=1.0))


def read_json(
    spark: SparkSession,
    path: str,
    records_path: str | None = None,
    schema: T.StructType | str | None = None,
    per_line: bool = False,
) -> DataFrame:
    """JSON documents, the record list under a dotted path, nested fields flattened.

    One document per file, or per line. A path that does not exist falls back to the document
    root. Declare ``schema`` to save the inference scan.
    """
    reader = spark.read.option("multiLine", not per_line)
    df = (reader.schema(schema) if schema else reader).json(path)
    return flatten(records_at(df, records_path))


def records_at(df: DataFrame, records_path: str | None) -> DataFrame:
    dtype: T.DataType = df.schema
    for key in (records_path or "").split(".") if records_path else []:
        if not isinstance(dtype, T.StructType) or key not in dtype.fieldNames():
            return df
        dtype = dtype[key].dataType
    if not records_path:
        return df
    target = F.col(".".join(f"`{k}`" for k in records_path.split(".")))
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.StructType):
            return df.select(F.inline(target))
        return df.select(F.explode(target).alias("0"))
    if isinstance(dtype, T.StructType):
        return df.select(target.alias("_record")).select("_record.*")
    return df


def read_parquet_tree(spark: SparkSession, root: str, partition_schema: str | None = None) -> DataFrame:
    """A Hive-partitioned tree. Partition values are text unless a type is declared,

    so that ``month=01`` reads back as ``'01'``. ``partition_schema`` is DDL such as
    ``"year int, month string"``.
    """
    if partition_schema is None:
        # A session of its own, where values of folder names stay text.
        plain = spark.newSession()
        plain.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        return spark.read.schema(plain.read.parquet(root).schema).parquet(root)
    types = T.StructType.fromDDL(partition_schema)
    first = spark.read.parquet(root).schema
    data = [f for f in first.fields if f.name not in types.fieldNames()]
    return spark.read.schema(T.StructType(data + types.fields)).parquet(root)


def preview(df: DataFrame, n: int = 100, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows; give an order for a reproducible preview."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
