"""Key joins (K1-K5). All are equi joins.

A key set is broadcast only when it is known to be small: by Spark's own size check
(``spark.sql.autoBroadcastJoinThreshold``, also at run time), or by the bytes the caller has just
counted. Otherwise both sides are exchanged on the keys and AQE may split a hot partition of
the row side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import cast_columns, col

# The keys of a batch are broadcast if they have been counted at no more bytes than this.
BROADCAST_KEY_BYTES = 16 * 1024 * 1024


def _present_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[col(k) for k in keys]).dropna("any", subset=list(keys))


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct non-NULL keys of a table.

    They are grouped together with a hash of themselves. The grouping combines copies of a hot
    key before its exchange, and, because it is not partitioned by the bare keys, a later join
    adds an exchange of its own; AQE only splits a skewed join partition if both inputs of the
    join are plain exchanges.
    """
    hashed = _present_keys(df, keys).withColumn("_h", F.xxhash64(*[col(k) for k in keys]))
    return hashed.groupBy("_h", *[col(k) for k in keys]).agg(F.lit(1).alias("_one")).drop("_h", "_one")


def key_bytes(df: DataFrame, keys: Sequence[str]) -> Column:
    """Aggregate: the bytes all keys of a frame take, one row of them after another."""
    def size(k: str) -> Column:
        dtype = df.schema[k].dataType
        if isinstance(dtype, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(col(k)), F.lit(0)) + 8
        if isinstance(dtype, (T.ArrayType, T.StructType)):  # about what their text takes
            return F.coalesce(F.octet_length(F.to_json(F.struct(col(k)))), F.lit(0)) + 16
        return F.lit(16)

    sizes = [size(k) for k in keys]
    return F.coalesce(F.sum(reduce(lambda a, b: a + b, sizes).cast("bigint")), F.lit(0))


def anti_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], counted_bytes: int | None = None) -> DataFrame:
    """K1, K2: rows whose key is not in the table; a NULL key never matches, so it stays.

    ``counted_bytes`` is the ``key_bytes`` of ``rows`` where the caller has taken them. For a
    small batch the table's keys are first reduced to those of the batch, so the table is scanned
    but never exchanged; nothing broadcast is larger than the keys of the batch.
    """
    if counted_bytes is not None and counted_bytes <= BROADCAST_KEY_BYTES:
        wanted = F.broadcast(_present_keys(rows, keys))
        seen = F.broadcast(table.select(*[col(k) for k in keys]).join(wanted, list(keys), "left_semi").distinct())
    else:
        seen = key_set(table, keys)
    return rows.join(seen, list(keys), "left_anti").select(*[col(c) for c in rows.columns])


def anti_join_cast(rows: DataFrame, table: DataFrame, keys: Sequence[str], cast_map: Mapping[str, str]) -> DataFrame:
    """K3: cast the staged columns first, then compare."""
    return anti_join(cast_columns(rows, cast_map), table, keys)


def merge_rows(
    table: DataFrame, changes: DataFrame, keys: Sequence[str], counted_bytes: int | None = None
) -> DataFrame:
    """K5: update the columns of ``changes`` on a key match, insert the rest of them.

    ``changes`` has to be unique on the keys. Every matching table row is updated; columns the
    changes lack keep their value (NULL in inserted rows). A NULL key matches nothing. With few keys
    the rows that none of them matches pass through as they lie; only matched rows are joined with
    the columns of the changes, however wide either are.
    """
    if counted_bytes is not None and counted_bytes <= BROADCAST_KEY_BYTES:
        wanted = F.broadcast(_present_keys(changes, keys))
        matched = table.join(wanted, list(keys), "left_semi").select(*[col(c) for c in table.columns])
        same = table.join(wanted, list(keys), "left_anti").select(*[col(c) for c in table.columns])
        # As many distinct keys at most as the changes have.
        seen = F.broadcast(matched.select(*[col(k) for k in keys]).distinct())
        inserted = changes.join(seen, list(keys), "left_anti").select(*[col(c) for c in changes.columns])
        parts = [same, _updated(matched, changes, keys, "inner"), inserted]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*[col(c) for c in table.columns])
    inserted = anti_join(changes, table, keys, counted_bytes)
    updated = _updated(table, changes, keys, "left")
    return updated.unionByName(inserted, allowMissingColumns=True).select(*[col(c) for c in table.columns])


def _updated(table: DataFrame, changes: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Table rows with the columns of the changes of their key."""
    others = [c for c in changes.columns if c not in keys and c in table.columns]
    new = changes.dropna("any", subset=list(keys)).select(
        *[col(k) for k in keys],
        *[col(c).alias(f"_new_{i}") for i, c in enumerate(others)],
        F.lit(True).alias("_hit"),
    )
    position = {c: i for i, c in enumerate(others)}
    return table.join(new, list(keys), how).select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{position[c]}")).otherwise(col(c)).alias(c) if c in position else col(c)
            for c in table.columns
        ]
    )


# Types whose ranges Parquet keeps exact statistics for.
_TIMES = (T.TimestampType, T.TimestampNTZType)
_RANGE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, *_TIMES)


def range_of_keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Aggregates giving the smallest and largest value of each key column that has a range."""
    out = []
    for i, key in enumerate(keys):
        dtype = df.schema[key].dataType
        if isinstance(dtype, _RANGE_TYPES):
            c = F.unix_micros(col(key).cast("timestamp")) if isinstance(dtype, _TIMES) else col(key)
            out += [F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}")]
    return out


def within_range(table: DataFrame, keys: Sequence[str], bounds: Mapping) -> DataFrame:
    """Only the part of the table that can match: a predicate Parquet statistics prune by."""
    for i, key in enumerate(keys):
        low, high = bounds.get(f"_lo{i}"), bounds.get(f"_hi{i}")
        if low is None:
            continue
        dtype = table.schema[key].dataType
        if isinstance(dtype, _TIMES):
            low, high = (F.timestamp_micros(F.lit(v)).cast(dtype) for v in (low, high))
        else:
            low, high = F.lit(low), F.lit(high)
        table = table.filter(col(key).between(low, high))
    return table
