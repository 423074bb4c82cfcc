"""Relative time windows (S9) and high-water marks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.casts import col
from millrace.functions.times import moment, resolve_now, utc_now


def resolve_query(query: Mapping | None, as_of: datetime | None = None) -> dict:
    """Replace the relative tokens of a query block, all against one moment."""
    moment = as_of or utc_now()
    return {key: resolve_now(value, moment) for key, value in (query or {}).items()}


def window_filter(
    df: DataFrame,
    time_column: str,
    query: Mapping,
    as_of: datetime | None = None,
    magnitude_column: str | None = None,
) -> DataFrame:
    """``starttime``/``endtime``/``minmagnitude`` as predicates that reach the scan."""
    q = resolve_query(query, as_of)
    out, dtype = df, df.schema[time_column].dataType
    if q.get("starttime"):
        out = out.filter(col(time_column) >= moment(q["starttime"], dtype))
    if q.get("endtime"):
        out = out.filter(col(time_column) < moment(q["endtime"], dtype))
    if q.get("minmagnitude") is not None and magnitude_column:
        out = out.filter(col(magnitude_column) >= F.lit(float(q["minmagnitude"])))
    return out


def past(df: DataFrame, since_field: str, since_value: str | None) -> DataFrame:
    """Rows past the stored mark, compared in the column's own type."""
    if since_value is None:
        return df
    return df.filter(col(since_field) > F.lit(since_value).cast(df.schema[since_field].dataType))


def mark_of(since_field: str) -> Column:
    """The new mark as text, the maximum taken on the typed column."""
    return F.max(col(since_field)).cast("string")


def high_water_mark(df: DataFrame, since_field: str) -> DataFrame:
    return df.agg(mark_of(since_field).alias("since_value"))
