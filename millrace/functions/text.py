"""Text functions: name normalisation (P9), slugs (T10), JSON records (T12), code maps."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short pollutant codes and the payload field each one is found under.
PARAMETER_FIELDS = {
    "pm25": "pm2_5",
    "pm2_5": "pm2_5",
    "pm10": "pm10",
    "no2": "nitrogen_dioxide",
    "o3": "ozone",
    "so2": "sulphur_dioxide",
    "co": "carbon_monoxide",
}


def normal_name(name: str) -> str:
    """Lower case, every run of other characters to one ``_``, none at the ends."""
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]+", "_", name.lower())).strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """P9 for all columns of a frame; a clash or an empty name gets a position suffix."""
    seen: set[str] = set()
    names = []
    for i, raw in enumerate(df.columns):
        name = normal_name(raw) or f"column{i}"
        if name in seen:
            name = f"{name}_{i}"
        seen.add(name)
        names.append(name)
    return df.toDF(*names)


def normal_text(c: Column) -> Column:
    """P9 as a column function."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9_]+", "_"), "_+", "_"), F.lit("_"))


def slug(*parts: Column) -> Column:
    """Parts joined by ``_``, lower case, other characters to ``_`` (ends kept)."""
    return F.regexp_replace(F.lower(F.concat_ws("_", *parts)), "[^a-z0-9_]+", "_")


def map_code(c: Column, mapping: dict[str, str] = PARAMETER_FIELDS) -> Column:
    """Look up the lower-cased code, unknown codes pass through lower-cased."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    key = F.lower(c)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)


def json_records(df: DataFrame, name: str = "record", timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """One JSON text per row, timestamps as text, NULL fields kept."""
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
    options = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format, "ignoreNullFields": "false"}
    return df.select(F.to_json(row, options).alias(name))
