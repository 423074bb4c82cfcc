"""Nested payloads to flat rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import coerce_datetime, coerce_float, coerce_int
from millrace.functions.times import from_epoch_ms, from_epoch_s, iso_text


def _path(parts: Sequence[str]) -> Column:
    return F.col(".".join("`" + p.replace("`", "``") + "`" for p in parts))


def flatten(df: DataFrame, sep: str = ".", max_level: int | None = None) -> DataFrame:
    """Struct fields as columns named ``a.b.c``; arrays stay.

    Only the schema is walked. ``max_level`` counts from the root: 2 gives at most ``a.b.c``.
    """
    leaves: list[Column] = []

    def walk(fields: Sequence[T.StructField], parents: tuple[str, ...]) -> None:
        for field in fields:
            here = (*parents, field.name)
            deeper = max_level is None or len(parents) < max_level
            if isinstance(field.dataType, T.StructType) and deeper:
                walk(field.dataType.fields, here)
            else:
                leaves.append(_path(here).alias(sep.join(here)))

    walk(df.schema.fields, ())
    return df.select(*leaves)


def _dtype_at(df: DataFrame, path: Sequence[str]) -> T.DataType | None:
    dtype: T.DataType = df.schema
    for key in path:
        if not isinstance(dtype, T.StructType) or key not in dtype.fieldNames():
            return None
        dtype = dtype[key].dataType
    return dtype


def optional(df: DataFrame, path: str, cast: str) -> Column:
    """The field at a dotted path, a typed NULL where the schema has no such field."""
    parts = path.split(".")
    if _dtype_at(df, parts) is None:
        return F.lit(None).cast(cast)
    return _path(parts).cast(cast)


def explode_path(df: DataFrame, path: str | Sequence[str], sep: str = ".") -> DataFrame:
    """One row per element of a nested record list, each element flattened."""
    parts = path.split(".") if isinstance(path, str) else list(path)
    dtype = _dtype_at(df, parts)
    if not isinstance(dtype, T.ArrayType):
        raise ValueError(f"{'.'.join(parts)} is not a list of records")
    if isinstance(dtype.elementType, T.StructType):
        return flatten(df.select(F.inline(_path(parts))), sep=sep)
    return df.select(F.explode(_path(parts)).alias("0"))


def keep_nested(df: DataFrame, name: str, sep: str = ".", max_level: int | None = 2) -> DataFrame:
    """Keep one nested object of each record; where it is missing the row is all NULL."""
    if not isinstance(_dtype_at(df, [name]), T.StructType):
        raise ValueError(f"{name} is not a nested object")
    return flatten(df.select(_path([name]).alias("_kept")).select("_kept.*"), sep=sep, max_level=max_level)


def zip_arrays(
    df: DataFrame, time: Column, value: Column, time_name: str, value_name: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Parallel lists to rows. Lists of different length are an error, not padded."""
    time = F.coalesce(time, F.array())
    value = F.coalesce(value, F.array())
    same = F.when(
        F.size(time) != F.size(value),
        F.raise_error(F.lit(f"lists {time_name} and {value_name} differ in length")).cast("boolean"),
    ).otherwise(F.lit(True))
    pairs = F.arrays_zip(time.alias("t"), value.alias("v"))
    return df.filter(same).select(*keep, F.inline(pairs)).withColumnsRenamed({"t": time_name, "v": value_name})


def hourly_to_rows(df: DataFrame, args: Mapping | None = None) -> DataFrame:
    """``hourly.<time>`` and ``hourly.<value>`` lists to rows with UTC time and constants."""
    a = dict(args or {})
    time_key, value_key = a.get("time_key", "time"), a.get("value_key", "pm2_5")
    time, value = ["hourly", time_key], ["hourly", value_key]
    rows = zip_arrays(
        df,
        _path(time) if _dtype_at(df, time) else F.array().cast("array<string>"),
        _path(value) if _dtype_at(df, value) else F.array().cast("array<double>"),
        "datetime_utc",
        "value",
    )
    return rows.select(
        coerce_datetime(F.col("datetime_utc"), rows.schema["datetime_utc"].dataType).alias("datetime_utc"),
        F.col("value"),
        F.lit(a.get("parameter")).cast("string").alias("parameter"),
        F.lit(a.get("unit")).cast("string").alias("unit"),
        F.lit(a.get("latitude")).cast("double").alias("latitude"),
        F.lit(a.get("longitude")).cast("double").alias("longitude"),
    )


def raw_hourly_to_rows(df: DataFrame, time_field: str, value_field: str, constant_fields: Mapping | None = None) -> DataFrame:
    """J3, declarative form: field names and values kept as they are, constants added."""
    rows = zip_arrays(df, _path(["hourly", time_field]), _path(["hourly", value_field]), time_field, value_field)
    return rows.withColumns({k: F.lit(v) for k, v in (constant_fields or {}).items()}) if constant_fields else rows


def features_to_rows(df: DataFrame, args: Mapping | None = None) -> DataFrame:
    """A feature collection to one row per feature; missing parts are NULL.

    ``id_path`` says where the event id is: ``id`` of the feature (default) or
    ``properties.code``. Extra items of a coordinate list are ignored.
    """
    a = dict(args or {})
    if _dtype_at(df, ["features"]) is not None:
        df = df.select(F.inline("features"))
    coords = (
        _path(["geometry", "coordinates"])
        if _dtype_at(df, ["geometry", "coordinates"])
        else F.lit(None).cast("array<double>")
    )
    return df.select(
        from_epoch_ms(optional(df, "properties.time", "bigint")).alias("datetime_utc"),
        optional(df, "properties.mag", "double").alias("magnitude"),
        F.get(coords, F.lit(2)).cast("double").alias("depth_km"),
        F.get(coords, F.lit(1)).cast("double").alias("latitude"),
        F.get(coords, F.lit(0)).cast("double").alias("longitude"),
        optional(df, "properties.place", "string").alias("place"),
        optional(df, a.get("id_path", "id"), "string").alias("event_id"),
        optional(df, "properties.type", "string").alias("type"),
        optional(df, "properties.status", "string").alias("status"),
    )


def indicator_records(df: DataFrame) -> DataFrame:
    """Indicator observations, nested ids and labels by safe access."""
    date = _dtype_at(df, ["date"]) or T.StringType()
    value = _dtype_at(df, ["value"]) or T.DoubleType()
    return df.select(
        coerce_int(optional(df, "date", date.simpleString()), date).alias("year"),
        coerce_float(optional(df, "value", value.simpleString()), value).alias("value"),
        optional(df, "indicator.id", "string").alias("indicator_id"),
        optional(df, "indicator.value", "string").alias("indicator"),
        optional(df, "country.id", "string").alias("country_id"),
        optional(df, "country.value", "string").alias("country"),
    )


# Snapshot column, where it is found in the repository record, its type.
SNAPSHOT_FIELDS = (
    ("full_name", "full_name", "string"),
    ("description", "description", "string"),
    ("visibility", "visibility", "string"),
    ("fork", "fork", "boolean"),
    ("archived", "archived", "boolean"),
    ("disabled", "disabled", "boolean"),
    ("language", "language", "string"),
    ("license", "license.spdx_id", "string"),
    ("topics", "topics", "array<string>"),
    ("default_branch", "default_branch", "string"),
    ("stars", "stargazers_count", "bigint"),
    ("forks", "forks_count", "bigint"),
    ("open_issues", "open_issues_count", "bigint"),
    ("watchers", "subscribers_count", "bigint"),
    ("size_kb", "size", "bigint"),
    ("created_at", "created_at", "string"),
    ("pushed_at", "pushed_at", "string"),
    ("updated_at", "updated_at", "string"),
    ("owner", "owner.login", "string"),
    ("repo", "name", "string"),
)


def repository_snapshot(df: DataFrame, as_of: datetime) -> DataFrame:
    """One row per repository record, topics joined by ``,``, stamped with ``as_of``."""
    columns = []
    for name, path, cast in SNAPSHOT_FIELDS:
        found = optional(df, path, cast)
        if cast.startswith("array"):
            found = F.array_join(F.coalesce(found, F.array().cast(cast)), ",")
        columns.append(found.alias(name))
    return df.select(*columns, F.lit(as_of.isoformat()).alias("snapshot_utc"))


def weekly_activity(df: DataFrame) -> DataFrame:
    """``week`` (epoch seconds) and ``total`` to instants, sorted by week."""
    week = F.when(F.col("week") != 0, F.col("week"))
    return df.select(
        iso_text(from_epoch_s(week)).alias("week_start_utc"),
        F.col("total").cast("bigint").alias("total_commits"),
    ).orderBy(F.col("week_start_utc").asc_nulls_last())
