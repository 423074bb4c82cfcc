"""Cast policies.

Two families, because the two callers expect different things from dirty text:

* ``coerce_*``: frame-style coercion. Text that is not a value of the type becomes NULL,
  ``NaN`` is missing, and text or a float with a fraction is not an integer.
* ``sql_cast``: ``TRY_CAST`` semantics. Fractions round (text: half away from zero, floats:
  half to even), ``NaN`` survives in a floating column.

Both need the source type, so they take it as an argument; ``cast_columns`` reads it from
the frame's schema. Nothing here is a UDF: everything stays in generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)

# Type names accepted in specs, and the Spark type each one means.
SQL_TYPES = {
    "INT": "int", "INTEGER": "int", "INT4": "int",
    "BIGINT": "bigint", "INT8": "bigint", "LONG": "bigint",
    "SMALLINT": "smallint", "TINYINT": "tinyint",
    "DOUBLE": "double", "FLOAT8": "double", "REAL": "float", "FLOAT": "float",
    "BOOLEAN": "boolean", "BOOL": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp", "DATETIME": "timestamp",
    "TIMESTAMPTZ": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp",
    "TIMESTAMP_NTZ": "timestamp_ntz",
    "VARCHAR": "string", "TEXT": "string", "STRING": "string",
}
COERCE_KINDS = ("int", "float", "datetime", "str")


# Text is matched before it is cast: a failing cast raises and catches an exception per row,
# which costs far more than the match. The number pattern also keeps out what only the JVM's
# parser takes for a number (``12d``, hex floats).
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)\s*$"


def text_to_integer(c: Column, target: str) -> Column:
    """Digits to an integer type, NULL out of its range."""
    return F.when(c.rlike(_WHOLE), c.try_cast(target))


def text_to_double(c: Column) -> Column:
    """Decimal text, infinity and NaN to double."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def _whole_to_long(d: Column) -> Column:
    return F.when(d == F.rint(d), d.try_cast("bigint"))


def coerce_int(c: Column, dtype: T.DataType) -> Column:
    """T1. Integer cast first, so that digits above 2**53 keep their precision."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(text_to_integer(c, "bigint"), _whole_to_long(text_to_double(c)))
    if isinstance(dtype, _FLOATS):
        return _whole_to_long(c.cast("double"))
    return c.try_cast("bigint")


def coerce_float(c: Column, dtype: T.DataType) -> Column:
    """T2."""
    if isinstance(dtype, T.StringType):
        return nan_to_null(text_to_double(c))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nan_to_null(c.cast("double"))
    return c.try_cast("double")


def coerce_str(c: Column, dtype: T.DataType) -> Column:
    """T3."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(c)
    return c.cast("string")


def declared(kind: str | Mapping) -> tuple[str, tuple[str, ...]]:
    """A type and the formats of its text: ``"datetime"`` or ``{"type": "datetime", "format": ...}``."""
    if not isinstance(kind, Mapping):
        return kind, ()
    formats = kind.get("format") or ()
    return kind["type"], (formats,) if isinstance(formats, str) else tuple(formats)


def _by_formats(c: Column, formats: Sequence[str]) -> Column:
    """The first format that fits the whole text, around which spaces do not count; else NULL."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats])


def coerce_datetime(c: Column, dtype: T.DataType, formats: Sequence[str] = ()) -> Column:
    """T5. Each value is parsed on its own; text without an explicit day is not a date.

    Text is ISO, or has one of the declared ``formats`` (Spark's patterns) and no other.
    """
    if isinstance(dtype, T.StringType):
        if formats:
            return _by_formats(c, formats)
        return F.when(_has_full_date(c), _dashed(c).try_cast("timestamp"))
    if isinstance(dtype, _TIMES):
        return c.cast("timestamp")
    return F.lit(None).cast("timestamp")


def _has_full_date(c: Column) -> Column:
    return c.rlike(r"^\s*\d{4}([-/])\d{1,2}\1\d{1,2}")


def _dashed(c: Column) -> Column:
    """Slash dates to dash dates; only the date part can hold a slash once it leads."""
    return F.when(c.contains("/"), F.regexp_replace(c, r"^(\s*\d{4})/(\d{1,2})/", "$1-$2-")).otherwise(c)


def sql_cast(c: Column, dtype: T.DataType, type_name: str | Mapping) -> Column:
    """T4: ``TRY_CAST(c AS type_name)``; dates and timestamps may declare the formats of their text."""
    type_name, formats = declared(type_name)
    target = SQL_TYPES.get(type_name.strip().upper(), type_name.strip().lower())
    if target in ("tinyint", "smallint", "int", "bigint"):
        if isinstance(dtype, T.StringType):
            return F.coalesce(text_to_integer(c, target), F.round(text_to_double(c)).try_cast(target))
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return F.rint(c).try_cast(target)
        if isinstance(dtype, T.DecimalType):
            return F.round(c).try_cast(target)
    elif target in ("double", "float"):
        if isinstance(dtype, T.StringType):
            return text_to_double(c).cast(target)
    elif target in ("timestamp", "timestamp_ntz", "date"):
        if isinstance(dtype, T.StringType):
            if formats:
                return _by_formats(c, formats).cast(target)
            return F.when(_has_full_date(c), _dashed(c).try_cast(target))
        if not isinstance(dtype, _TIMES):
            return F.lit(None).cast(target)
        return c.cast(target)
    elif target == "string":
        return coerce_str(c, dtype)
    return c.try_cast(target)


_COERCIONS = {
    "int": coerce_int,
    "float": coerce_float,
    "datetime": coerce_datetime,
    "str": coerce_str,
}


def coerce(c: Column, dtype: T.DataType, kind: str | Mapping) -> Column:
    kind, formats = declared(kind)
    if kind == "datetime":
        return coerce_datetime(c, dtype, formats)
    if kind not in _COERCIONS:
        raise ValueError(f"unknown coercion {kind!r}; use one of {COERCE_KINDS}")
    return _COERCIONS[kind](c, dtype)


def date_kinds(dates: Sequence[str] | Mapping | None) -> dict:
    """Kinds of ``parse_dates``: a list of columns, or a map of columns to their formats."""
    if isinstance(dates, Mapping):
        return {c: {"type": "datetime", "format": f} for c, f in dates.items()}
    return dict.fromkeys(dates or [], "datetime")


def quoted(name: str) -> str:
    """Column name as one identifier, even with dots in it."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def coerce_columns(df: DataFrame, kinds: Mapping[str, str | Mapping]) -> DataFrame:
    """Coerce the listed columns in place; unknown columns and unknown kinds are skipped."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    new = {
        name: coerce(col(name), fields[name], kind)
        for name, kind in kinds.items()
        if name in fields and declared(kind)[0] in _COERCIONS
    }
    return _replace(df, new)


def cast_columns(df: DataFrame, types: Mapping[str, str | Mapping] | None) -> DataFrame:
    """``SELECT * REPLACE (TRY_CAST(c AS t) AS c)``; a missing column is an error."""
    if not types:
        return df
    fields = {f.name: f.dataType for f in df.schema.fields}
    missing = [name for name in types if name not in fields]
    if missing:
        raise ValueError(f"cast of unknown column(s): {missing}")
    return _replace(df, {n: sql_cast(col(n), fields[n], t) for n, t in types.items()})


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    if not new:
        return df
    return df.select(*[new[n].alias(n) if n in new else col(n) for n in df.columns])


def cast_failures(df: DataFrame, kinds: Mapping[str, str | Mapping]) -> list[Column]:
    """Aggregates ``<column>_cast_failed``: present in the input, NULL after coercion."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.count_if(col(n).isNotNull() & coerce(col(n), fields[n], k).isNull()).alias(f"{n}_cast_failed")
        for n, k in kinds.items()
        if n in fields
    ]
