"""Automatic summaries (B1-B4): axes from the schema, top groups, series for a chart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import coerce_datetime, col
from millrace.operators.aggregate import RANK_CHARS, top_groups, top_long_groups, totals
from millrace.operators.project import drop_missing

DATE_LIKE_SHARE = 0.7


def _numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def pick_axes(schema: T.StructType) -> tuple[str, str]:
    """B1: x is the first column that is no number (else the first), y the first number that is

    not x (else the last column). Reads no data.
    """
    names = schema.fieldNames()
    x = next((f.name for f in schema.fields if not _numeric(f.dataType)), names[0])
    y = next((f.name for f in schema.fields if f.name != x and _numeric(f.dataType)), names[-1])
    return x, y


def summarize(df: DataFrame, k: int = 10) -> DataFrame:
    """B2: the top ``k`` groups of x: the sum of y if it is a number, else the row count."""
    x, y = pick_axes(df.schema)
    measure = y if _numeric(df.schema[y].dataType) else None
    if isinstance(df.schema[y].dataType, T.BooleanType):
        df = df.select(col(x), col(y).cast("int").alias(y)) if x != y else df.select(col(y).cast("int").alias(y))
    if isinstance(df.schema[x].dataType, T.StringType) and _long(df, x):
        return top_long_groups(df, x, measure, k)
    return top_groups(totals(df, x, measure), k)


def _long(df: DataFrame, x: str) -> bool:
    """Whether some of the first values are long; it only decides how the same groups are found."""
    first = df.select(F.octet_length(col(x)).alias("n")).limit(100).agg(F.max("n").alias("n")).first()["n"]
    return first is not None and first > 2 * RANK_CHARS


def summarize_all(tables: Mapping[str, DataFrame], k: int = 10) -> dict[str, DataFrame]:
    """A summary of every table that has rows and at least two columns."""
    return {
        name: summarize(df, k)
        for name, df in tables.items()
        if len(df.columns) >= 2 and not df.limit(1).isEmpty()
    }


def looks_like_dates(df: DataFrame, x: str) -> bool:
    """Typed as a time, or text of which more than 70 % parses; one number comes back."""
    dtype = df.schema[x].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return True
    if _numeric(dtype):
        return True  # a number is a position on a time axis too: the series is sorted by it
    share = df.agg(F.avg(coerce_datetime(col(x), dtype).isNotNull().cast("int")).alias("share")).first()["share"]
    return bool(share is not None and share > DATE_LIKE_SHARE)


def series(df: DataFrame, top: int = 10) -> DataFrame:
    """The pairs to draw: sorted by a date-like x, otherwise the top rows by y."""
    x, y = pick_axes(df.schema)
    by_date = looks_like_dates(df, x)
    pairs = drop_missing(df.select(*[col(c) for c in dict.fromkeys([x, y])]), list(dict.fromkeys([x, y])))
    if not by_date:
        return pairs.orderBy(col(y).desc_nulls_last(), col(x)).limit(top)
    dtype = df.schema[x].dataType
    if not _numeric(dtype):
        pairs = pairs.withColumn(x, coerce_datetime(col(x), dtype))
    return pairs.orderBy(col(x).asc_nulls_last(), col(y))
