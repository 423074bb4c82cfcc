"""Time functions: epochs (T6), date parts (T7, T8), truncation and periods (T9), now tokens."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import col


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def from_epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c.cast("bigint"))


def from_epoch_s(c: Column) -> Column:
    return F.timestamp_seconds(c.cast("bigint"))


def iso_text(c: Column) -> Column:
    """ISO 8601 with a numeric offset, as ``datetime.isoformat`` writes whole seconds."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")


def year_of(c: Column) -> Column:
    return F.year(c)


def month_padded(c: Column) -> Column:
    """Month as two-digit text."""
    return F.lpad(F.month(c).cast("string"), 2, "0")


def moment(value: datetime | str, dtype: T.DataType) -> Column:
    """A literal of a time column's own type, so that a comparison with it reaches the scan.

    A datetime without a zone, and text without an offset, is UTC.
    """
    if isinstance(value, datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value).cast("timestamp").cast(dtype)


def same_month(df: DataFrame, column: str, as_of: datetime) -> DataFrame:
    """Rows of the calendar month of ``as_of``, as a range of the time column."""
    first = as_of.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    following = (first + timedelta(days=32)).replace(day=1)
    dtype = df.schema[column].dataType
    return df.filter((col(column) >= moment(first, dtype)) & (col(column) < moment(following, dtype)))


def last_days(df: DataFrame, column: str, as_of: datetime, days: int = 30) -> DataFrame:
    """Rows not older than ``days`` days before ``as_of``."""
    return df.filter(col(column) >= moment(as_of - timedelta(days=days), df.schema[column].dataType))


_TOKEN = re.compile(r"^@now(?:-(\d+)([dh]))?$")


def resolve_now(value, as_of: datetime):
    """S9 tokens: ``@now`` and ``@now-<n>d`` are dates, ``@now-<n>h`` is an instant.

    ``as_of`` is fixed once per run, so that every bound of a run means the same moment.
    Other values pass through; an unknown token means the instant itself.
    """
    if not isinstance(value, str) or not value.startswith("@now"):
        return value
    found = _TOKEN.match(value)
    if not found:
        return as_of.isoformat()
    amount, unit = found.groups()
    if unit == "h":
        return (as_of - timedelta(hours=int(amount))).isoformat()
    return (as_of - timedelta(days=int(amount or 0))).date().isoformat()
