"""Cast policies and scalar functions against hand-written values."""

import math
import re
from datetime import datetime, timezone

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import casts, text, times
from tests.conftest import plan

TEXT = T.StringType()


def one(spark, values, fn, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


@pytest.mark.parametrize(
    "value, want",
    [("47.5", 48), ("48.5", 49), ("2.5", 3), ("-2.5", -3), ("1e3", 1000), (" 12 ", 12), ("abc", None), (None, None),
     ("12d", None), ("0x10", None), ("1_000", None), ("NaN", None), ("inf", None), ("2147483648", None), ("", None)],
)
def test_sql_integer_from_text(spark, value, want):
    assert one(spark, [value], lambda c: casts.sql_cast(c, TEXT, "INTEGER")) == [want]


def test_sql_integer_from_double_rounds_half_to_even(spark):
    got = one(spark, [47.5, 48.5, -2.5, 1e300, math.nan, math.inf, None], lambda c: casts.sql_cast(c, T.DoubleType(), "INTEGER"), "s double")
    assert got == [48, 48, -2, None, None, None, None]


def test_sql_double_keeps_nan_and_coercion_drops_it(spark):
    got = one(spark, ["NaN", "inf", "1.5", ".5", "5.", "BAD", "1f"], lambda c: casts.sql_cast(c, TEXT, "DOUBLE"))
    assert math.isnan(got[0]) and got[1:] == [math.inf, 1.5, 0.5, 5.0, None, None]
    assert one(spark, ["NaN", "1.5", "BAD"], lambda c: casts.coerce_float(c, TEXT)) == [None, 1.5, None]


@pytest.mark.parametrize(
    "value, want",
    [("2025-08-20 03:00:00+02:00", "2025-08-20 01:00:00"), ("2025-08-20T03:00", "2025-08-20 03:00:00"),
     ("2025/08/20", "2025-08-20 00:00:00"), ("2025", None), ("12:00:00", None), ("INVALID", None),
     ("2025-13-45", None), (None, None)],
)
def test_timestamp_is_an_instant_in_utc(spark, value, want):
    for fn in (lambda c: casts.sql_cast(c, TEXT, "TIMESTAMP"), lambda c: casts.sql_cast(c, TEXT, "TIMESTAMPTZ"),
               lambda c: casts.coerce_datetime(c, TEXT)):
        assert one(spark, [value], lambda c: F.date_format(fn(c), "yyyy-MM-dd HH:mm:ss")) == [want]


def test_coerce_int(spark):
    values = ["9007199254740993", "47.0", "47.5", "1e3", "x", None, " 7"]
    assert one(spark, values, lambda c: casts.coerce_int(c, TEXT)) == [9007199254740993, 47, None, 1000, None, None, 7]
    assert one(spark, [1.0, 2.5, math.nan], lambda c: casts.coerce_int(c, T.DoubleType()), "s double") == [1, None, None]


@pytest.mark.parametrize("value", ["+-0", "-+1", "--2", "++3"])
def test_a_number_has_one_sign(spark, value):
    """Some engines read -0.0 from the first; here none of them is a number."""
    assert one(spark, [value], lambda c: casts.sql_cast(c, TEXT, "DOUBLE")) == [None]


@settings(max_examples=20, deadline=None, derandomize=True, database=None)
@given(st.lists(st.one_of(
    st.integers(-10**12, 10**12).map(str), st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
    st.text("0123456789.eE+- abc", max_size=8).filter(lambda v: not re.search(r"[+-]\s*[+-]", v))), min_size=1, max_size=40))
def test_numeric_text_agrees_with_duckdb(spark, values):
    want = duckdb.connect().execute(
        "SELECT TRY_CAST(v AS DOUBLE) FROM (SELECT unnest(?) AS v)", [values]
    ).fetchall()
    assert one(spark, values, lambda c: casts.sql_cast(c, TEXT, "DOUBLE")) == [w[0] for w in want]


def test_cast_columns_keeps_position_and_needs_the_column(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, b string, c string")
    out = casts.cast_columns(df, {"c": "DOUBLE", "a": "INTEGER"})
    assert out.columns == ["a", "b", "c"] and out.first() == (1, "x", 2.5)
    with pytest.raises(ValueError):
        casts.cast_columns(df, {"zz": "INTEGER"})


def test_coerce_columns_skips_unknown_and_counts_failures(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert [r[0] for r in casts.coerce_columns(df, {"a": "int", "zz": "int"}).collect()] == [1, None, None]
    assert df.agg(*casts.cast_failures(df, {"a": "int"})).first()[0] == 1


def test_no_python_in_cast_plan(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("s"))
    assert "Python" not in plan(casts.cast_columns(df, {"s": "INTEGER"}))


def test_names():
    assert text.normal_name("  Cust-Key (No)") == "cust_key_no"


def test_normalize_columns_avoids_clashes(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A b", "a-b", "!!"])
    assert text.normalize_columns(df).columns == ["a_b", "a_b_1", "column2"]


def test_code_map(spark):
    got = one(spark, ["PM25", "no2", "O3", "Other", None], lambda c: text.map_code(c))
    assert got == ["pm2_5", "nitrogen_dioxide", "ozone", "other", None]


def test_slug_and_epochs(spark):
    df = spark.createDataFrame([("OwNer", "A-B.c", 1_700_000_000_123)], "a string, b string, ms bigint")
    row = df.select(
        text.slug(F.col("a"), F.col("b")), times.iso_text(times.from_epoch_ms(F.col("ms"))), times.iso_text(times.from_epoch_s(F.lit(0)))
    ).first()
    assert tuple(row) == ("owner_a_b_c", "2023-11-14T22:13:20+00:00", "1970-01-01T00:00:00+00:00")


def test_now_tokens():
    now = datetime(2025, 8, 20, 12, 30, tzinfo=timezone.utc)
    assert times.resolve_now("@now", now) == "2025-08-20"
    assert times.resolve_now("@now-7d", now) == "2025-08-13"
    assert times.resolve_now("@now-24h", now) == "2025-08-19T12:30:00+00:00"
    assert times.resolve_now("@now-x", now) == now.isoformat()
    assert times.resolve_now("plain", now) == "plain" and times.resolve_now(4.0, now) == 4.0


def test_json_records(spark):
    df = spark.sql("SELECT 1 AS a, TIMESTAMP '2025-08-19 16:27:27' AS t, CAST(NULL AS STRING) AS n")
    assert text.json_records(df).first()[0] == '{"a":1,"t":"2025-08-19 16:27:27","n":null}'


def test_period_filters_reach_the_scan(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    as_of = datetime(2024, 1, 31, tzinfo=timezone.utc)
    for df in (times.same_month(e, "ts", as_of), times.last_days(e, "ts", as_of, 10)):
        assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(df)


def test_declared_date_formats(spark):
    df = spark.createDataFrame(
        [("20250820", "08/20/2025"), (" 20250821 ", "20 Aug 2025"), ("2025-08-20", "2025-08-20 3:00 PM"), ("20251340", "x"), ("", ""), (None, None)],
        "a string, b string",
    )
    kinds = {"a": {"type": "datetime", "format": "yyyyMMdd"}, "b": {"type": "datetime", "format": ["MM/dd/yyyy", "dd MMM yyyy", "yyyy-MM-dd h:mm a"]}}
    got = casts.coerce_columns(df, kinds).select(*[F.date_format(c, "MM-dd HH").alias(c) for c in "ab"]).collect()
    assert [r.a for r in got] == ["08-20 00", "08-21 00", None, None, None, None]
    assert [r.b for r in got] == ["08-20 00", "08-20 00", "08-20 15", None, None, None]
    failed = df.agg(*casts.cast_failures(df, kinds)).first()
    assert (failed.a_cast_failed, failed.b_cast_failed) == (3, 2)
    days = casts.cast_columns(df, {"a": {"type": "DATE", "format": "yyyyMMdd"}}).select(F.col("a").cast("string").alias("a")).collect()
    assert [r.a for r in days] == ["2025-08-20", "2025-08-21", None, None, None, None]
