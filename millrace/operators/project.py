"""Projection, filters and row transforms (P1-P13), and the fixed-order chains."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.casts import coerce_columns, col, date_kinds


def select_strict(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A missing column is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {missing}")
    return df.select(*[col(c) for c in columns])


def select_lenient(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing columns are ignored, the listed order is kept."""
    return df.select(*[col(c) for c in columns if c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Unknown names are ignored."""
    return df.withColumnsRenamed(dict(names))


_ASSIGN = re.compile(r"^\s*([A-Za-z_]\w*)\s*=(?!=)\s*(.+)$", re.S)


def derive(df: DataFrame, expressions: Sequence[str]) -> DataFrame:
    """``new = <Spark SQL expression>`` in order; each may use the ones before."""
    for text in expressions:
        found = _ASSIGN.match(text)
        if not found:
            raise ValueError(f"derive needs 'name = expression', got {text!r}")
        df = df.withColumn(found.group(1), F.expr(found.group(2)))
    return df


def enrich(df: DataFrame, constants: Mapping) -> DataFrame:
    """P6."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else df


def where_all(df: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """Conditions in Spark SQL, all must be true; NULL drops the row."""
    for condition in conditions:
        df = df.filter(F.expr(condition))
    return df


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P10: drop rows with NULL (or NaN) in any listed column."""
    return df.dropna("any", subset=list(columns))


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key, NULL keys form one group.

    With ``order_by`` the first row in that order stays. ``row_number() = 1`` is planned with a
    group limit before the exchange: each task sends at most one row per key, so a hot key
    costs one row per task. Without an order any one row of the group may stay.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"missing key column(s): {missing}")
    if not order_by:
        return df.dropDuplicates(list(keys))
    order = [_order(o) for o in order_by]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def _order(item: str | Column) -> Column:
    """``"c"`` or ``"c desc"``; NULLs last either way."""
    if isinstance(item, Column):
        return item
    name, _, way = item.strip().rpartition(" ")
    if name and way.lower() in ("asc", "desc"):
        return col(name).desc_nulls_last() if way.lower() == "desc" else col(name).asc_nulls_last()
    return col(item).asc_nulls_last()


def transform(df: DataFrame, params: Mapping) -> DataFrame:
    """Select, rename, derive, select_final, dtypes, parse_dates, filter, dedupe.

    One lazy plan; the order of the steps is fixed, the keys are all optional.
    """
    if params.get("select"):
        df = select_strict(df, params["select"])
    if params.get("rename"):
        df = rename(df, params["rename"])
    df = derive(df, params.get("derive") or [])
    if params.get("select_final"):
        df = select_strict(df, params["select_final"])
    df = coerce_columns(df, {c: t for c, t in (params.get("dtypes") or {}).items() if t != "datetime"})
    df = coerce_columns(df, date_kinds(params.get("parse_dates")))
    df = where_all(df, params.get("filter") or [])
    if params.get("dedupe_on"):
        df = dedupe(df, params["dedupe_on"], params.get("order_by"))
    return df


def postprocess(df: DataFrame, post: Mapping | None) -> DataFrame:
    """R2: ``cast`` by coercion (a missing column is an error), then ``dropna_any``."""
    if not post:
        return df
    casts = post.get("cast") or {}
    missing = [c for c in casts if c not in df.columns]
    if missing:
        raise ValueError(f"cast of unknown column(s): {missing}")
    df = coerce_columns(df, casts)
    if post.get("dropna_any"):
        df = drop_missing(df, post["dropna_any"])
    return df
