"""Named source adapters (E1) and payload transforms.

An adapter is ``(spark, params, as_of) -> DataFrame``. The network call of an API source is not
part of a Spark job: payloads are landed as files and ``params.path`` says where.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.casts import coerce_columns
from millrace.operators import shaping
from millrace.operators.project import enrich, rename, select_lenient, transform
from millrace.sources import files, payload, storage, windows

Adapter = Callable[[SparkSession, Mapping, datetime], DataFrame]

ADAPTERS: dict[str, Adapter] = {}
TRANSFORMS: dict[str, Callable[[DataFrame, Mapping], DataFrame]] = {
    "hourly_time_value": shaping.hourly_to_rows,
    "usgs_features": shaping.features_to_rows,
}


def register_adapter(name: str) -> Callable[[Adapter], Adapter]:
    def add(fn: Adapter) -> Adapter:
        ADAPTERS[name] = fn
        return fn

    return add


def get_adapter(name: str) -> Adapter:
    if name not in ADAPTERS:
        raise ValueError(f"adapter {name!r} is not registered; known: {sorted(ADAPTERS)}")
    return ADAPTERS[name]


def register_transform(name: str):
    def add(fn):
        TRANSFORMS[name] = fn
        return fn

    return add


def get_transform(name: str):
    if name not in TRANSFORMS:
        raise ValueError(f"transform {name!r} is not registered; known: {sorted(TRANSFORMS)}")
    return TRANSFORMS[name]


def _landed(params: Mapping) -> str:
    if not params.get("path"):
        raise ValueError("params.path must name the landed payload files")
    return params["path"]


def _documents(spark: SparkSession, params: Mapping) -> DataFrame:
    """Landed JSON documents as structs: one per file, or per line; declare ``schema`` to save a scan."""
    reader = spark.read.option("multiLine", not params.get("per_line"))
    return (reader.schema(params["schema"]) if params.get("schema") else reader).json(_landed(params))


def _one_csv(spark: SparkSession, params: Mapping) -> DataFrame:
    """Columns by name and typed by their cells, or as declared; texts that mean "missing" are NULL."""
    if not params.get("path"):
        raise ValueError("path is required")
    options = {k: params[k] for k in ("sep", "encoding", "na_values", "multi_line") if params.get(k) is not None}
    if not params.get("schema"):
        return files.read_csv_files(spark, params["path"], **options)
    na_values = options.pop("na_values", None)
    return files.null_texts(files.read_csv(spark, params["path"], schema=params["schema"], **options), na_values)


@register_adapter("csv_local")
def csv_one(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    return _one_csv(spark, params)


@register_adapter("csv_local_simple")
def csv_many(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    options = ("sep", "encoding", "usecols", "dtype", "parse_dates", "na_values", "skiprows", "multi_line")
    df = files.read_csv_files(spark, params["path"], **{k: params[k] for k in options if params.get(k) is not None})
    return transform(df, params)


@register_adapter("http_json")
def landed_json(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    """Landed payloads: a named transform, or the generic route with select, rename, enrich."""
    if params.get("transform"):
        df = get_transform(params["transform"])(_documents(spark, params), params.get("transform_args") or {})
        query = windows.resolve_query(params.get("query"), as_of)
        if "datetime_utc" in df.columns and {"starttime", "endtime", "minmagnitude"} & query.keys():
            magnitude = "magnitude" if "magnitude" in df.columns else None
            df = windows.window_filter(df, "datetime_utc", query, as_of, magnitude)
        return df
    df = payload.payload_frame(
        payload.read_payloads(spark, _landed(params), bool(params.get("per_line"))),
        params.get("records_key_chain"),
        params.get("explode_properties"),
        params.get("schema"),
    )
    if params.get("select"):
        df = select_lenient(df, params["select"])
    return enrich(rename(df, params.get("rename") or {}), params.get("enrich") or {})


@register_adapter("http_json_simple")
def landed_json_simple(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    """Landed payloads: root index, hourly lists or a record path, then the transform chain."""
    sep = params.get("flatten_sep", ".")
    root = [params["root_index"]] if "root_index" in params else []
    if params.get("hourly_to_rows"):
        h = params["hourly_to_rows"]
        df = shaping.raw_hourly_to_rows(_documents(spark, params), h["time_field"], h["value_field"], h.get("constant_fields"))
        return transform(df, params)
    docs = payload.read_payloads(spark, _landed(params), bool(params.get("per_line")))
    path = params.get("record_path") or []
    chain = root + (path if isinstance(path, list) else [path])
    if path:
        records = payload.explode_pages(docs, chain)
    else:
        target = payload.dig(F.col("payload"), root) if root else F.col("payload")
        as_list = F.try_variant_get(target, "$", "array<variant>")
        records = docs.select(F.explode(F.coalesce(as_list, F.array(target))).alias("record"))
    df = shaping.flatten(payload.typed_records(records, params.get("schema")), sep=sep)
    return transform(df, params)


@register_adapter("parquet")
def parquet_tree(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    if not storage.exists(spark, params["path"]):
        raise FileNotFoundError(f"no files at {params['path']}")
    df = files.read_parquet_tree(spark, params["path"], params.get("partition_schema"))
    return transform(df, params)


@register_adapter("csv")
def csv_source(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    return _one_csv(spark, params)


@register_adapter("json")
def json_source(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    per_line = bool(params.get("per_line"))
    return files.read_json(spark, params["path"], params.get("records_path"), params.get("schema"), per_line)


@register_adapter("api")
def api_source(spark: SparkSession, params: Mapping, as_of: datetime) -> DataFrame:
    """All landed pages as one record set; with ``pages`` each once, and none may be missing."""
    docs = payload.read_payloads(spark, _landed(params), bool(params.get("per_line")))
    if params.get("pages"):
        # Where a page says its number and how many there are: {page: [0, page], pages: [0, pages]}.
        docs = payload.complete_pages(docs, params["pages"]["page"], params["pages"]["pages"], on_gap=params.get("on_gap", "error"))
    chain = params["records_path"].split(".") if params.get("records_path") else []
    if chain:
        records = payload.explode_pages(docs, chain)
    else:
        as_list = F.try_variant_get(F.col("payload"), "$", "array<variant>")
        records = docs.select(F.explode(F.coalesce(as_list, F.array("payload"))).alias("record"))
    df = shaping.flatten(payload.typed_records(records, params.get("schema")))
    return coerce_columns(df, params.get("dtypes") or {})
