"""Payloads to rows."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.operators import shaping
from millrace.sources import files, payload
from tests.conftest import rows


def land(path, *docs):
    path.mkdir(parents=True, exist_ok=True)
    for i, doc in enumerate(docs):
        (path / f"{i}.json").write_text(json.dumps(doc))
    return str(path)


def payloads(spark, *docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string")
    return df.select(F.parse_json("t").alias("payload"))


def test_dig(spark):
    p = payloads(spark, {"a": [{"b c": 5}], "n": None})
    got = p.select(
        payload.dig(F.col("payload"), ["a", "0", "b c"], "int"), payload.dig(F.col("payload"), ["a", 3, "b"], "int"),
        payload.dig(F.col("payload"), ["zz"], "int"),
    ).first()
    assert tuple(got) == (5, None, None)


@pytest.mark.parametrize(
    "doc, chain, want",
    [
        ([{"i": 1}, {"i": 2}], None, [1, 2]),
        ({"results": [{"i": 1}], "data": [{"i": 9}]}, None, [1]),
        ({"results": {}, "data": [{"i": 9}]}, None, [9]),
        ({"items": [{"i": 4}]}, None, [4]),
        ({"i": 7}, None, [7]),
        ([{"m": 0}, [{"i": 3}]], ["1"], [3]),
        ([{"m": 0}, None], ["1"], []),
        ({"one": {"i": 6}}, ["one"], [6]),
        ({"data": [{"i": 8}]}, ["nowhere"], [8]),
    ],
)
def test_record_autodetect(spark, doc, chain, want):
    records = payload.explode_records(payloads(spark, doc), chain)
    assert sorted(r[0] for r in payload.typed_records(records, "i int").collect()) == want


def test_pages_skip_null_and_missing_rows(spark):
    p = payloads(spark, [{}, [{"i": 1}]], [{}, None], [{}, []], [{}])
    assert rows(payload.typed_records(payload.explode_pages(p, ["1"]), "i int")) == [(1,)]


def test_inferred_record_schema_covers_all_records(spark):
    p = payloads(spark, [{"a": 1, "n": {"x": None}}], [{"a": 2.5, "b": "t", "n": {"x": "y"}}])
    df = payload.payload_frame(p)
    assert sorted(df.columns) == ["a", "b", "n.x"]
    assert rows(df.select(F.col("a").cast("double"), "b", "`n.x`")) == [(1.0, None, None), (2.5, "t", "y")]


def test_generic_route_keeps_level_two(spark):
    p = payloads(spark, [{"a": {"b": {"c": {"d": 1}}}}])
    assert payload.payload_frame(p).columns == ["a.b.c"]
    assert payload.payload_frame(p, max_level=None).columns == ["a.b.c.d"]


def test_explode_properties_missing_is_empty_row(spark):
    p = payloads(spark, {"items": [{"properties": {"m": 1}}, {"other": 2}]})
    assert rows(payload.payload_frame(p, explode_properties="properties")) == [(1,), (None,)]


def test_json_file_with_records_path(spark, tmp_path):
    path = land(tmp_path / "j", {"data": {"items": [{"a": 1, "n": {"x": 2, "l": [1]}}, {"a": 3, "n": {"x": 4, "l": []}}]}})
    assert rows(files.read_json(spark, path, "data.items").select("a", "`n.x`")) == [(1, 2), (3, 4)]
    assert files.read_json(spark, path, "no.such").columns == ["data.items"]
    assert files.read_json(spark, path).columns == ["data.items"]
    assert rows(files.read_json(spark, land(tmp_path / "r", [{"a": 1}, {"a": 2}]))) == [(1,), (2,)]


def test_flatten_separator_depth_and_arrays(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('c', 2, 'd', array(1, 2))) AS a")
    assert shaping.flatten(df).columns == ["id", "a.b.c", "a.b.d"]
    assert shaping.flatten(df, sep="_", max_level=1).columns == ["id", "a_b"]
    assert shaping.flatten(df, max_level=0).columns == ["id", "a"]


def test_explode_path_and_keep_nested(spark):
    df = spark.sql("SELECT named_struct('r', array(named_struct('x', 1, 'y', named_struct('z', 2)))) AS a, named_struct('m', 5) AS p")
    assert shaping.explode_path(df, "a.r").collect()[0].asDict() == {"x": 1, "y.z": 2}
    assert shaping.keep_nested(df, "p").collect() == [(5,)]
    with pytest.raises(ValueError):
        shaping.explode_path(df, "p.m")


HOURLY = "hourly struct<time: array<string>, pm2_5: array<double>>"


def test_hourly_lists(spark):
    df = spark.createDataFrame([((["2025-08-20T00:00", "2025-08-20T01:00", "bad"], [1.5, None, 3.0]),)], HOURLY)
    got = shaping.hourly_to_rows(df, {"parameter": "pm25", "unit": "u", "latitude": 40, "longitude": -3.5})
    assert got.columns == ["datetime_utc", "value", "parameter", "unit", "latitude", "longitude"]
    assert rows(got.select(F.date_format("datetime_utc", "HH:mm"), "value", "latitude")) == [
        ("00:00", 1.5, 40.0), ("01:00", None, 40.0), (None, 3.0, 40.0)]


def test_hourly_lists_of_unequal_length_are_an_error(spark):
    df = spark.createDataFrame([((["2025-08-20T00:00"], [1.0, 2.0]),)], HOURLY)
    with pytest.raises(Exception, match="differ in length"):
        shaping.hourly_to_rows(df).collect()


def test_hourly_without_lists_is_empty(spark):
    assert shaping.hourly_to_rows(spark.createDataFrame([((None, None),)], HOURLY)).count() == 0
    assert shaping.hourly_to_rows(spark.createDataFrame([(1,)], "other int")).count() == 0


def test_raw_hourly_lists(spark):
    df = spark.createDataFrame([((["t1"], [1.0]),)], HOURLY)
    got = shaping.raw_hourly_to_rows(df, "time", "pm2_5", {"unit": "u"})
    assert got.columns == ["time", "pm2_5", "unit"] and got.collect() == [("t1", 1.0, "u")]


def test_features(spark):
    schema = ("features array<struct<id: string, properties: struct<time: bigint, mag: double, place: string, code: string, "
              "type: string, status: string>, geometry: struct<coordinates: array<double>>>>")
    features = [
        ("a1", (1_700_000_000_123, 5.5, "here", "c1", "earthquake", "reviewed"), ([-3.0, 40.0, 10.0, 99.0],)),
        ("a2", (None, 4.5, None, "c2", None, None), ([1.0],)),
        ("a3", None, None),
    ]
    df = spark.createDataFrame([(features,)], schema)
    got = shaping.features_to_rows(df)
    assert rows(got.select("event_id", "magnitude", "longitude", "latitude", "depth_km", F.unix_millis("datetime_utc"))) == [
        ("a1", 5.5, -3.0, 40.0, 10.0, 1_700_000_000_123), ("a2", 4.5, 1.0, None, None, None), ("a3", None, None, None, None, None)]
    by_code = shaping.features_to_rows(df, {"id_path": "properties.code"})
    assert rows(by_code.select("event_id")) == [("c1",), ("c2",), (None,)]


def test_indicator_records(spark):
    df = spark.createDataFrame(
        [("2020", 5.0, ("I", "ind"), ("E", "Es")), ("x", None, None, None)],
        "date string, value double, indicator struct<id: string, value: string>, country struct<id: string, value: string>",
    )
    assert rows(shaping.indicator_records(df)) == [(2020, 5.0, "I", "ind", "E", "Es"), (None, None, None, None, None, None)]


def test_repository_snapshot(spark):
    df = spark.createDataFrame(
        [("o/r", ["a", "b"], ("MIT",), 5, ("o",)), ("o/s", None, None, None, None)],
        "full_name string, topics array<string>, license struct<spdx_id: string>, stargazers_count bigint, owner struct<login: string>",
    )
    got = shaping.repository_snapshot(df, datetime(2025, 1, 1, tzinfo=timezone.utc))
    assert len(got.columns) == 21
    assert rows(got.select("full_name", "topics", "license", "stars", "owner", "archived", "snapshot_utc")) == [
        ("o/r", "a,b", "MIT", 5, "o", None, "2025-01-01T00:00:00+00:00"), ("o/s", "", None, None, None, None, "2025-01-01T00:00:00+00:00")]


def test_weekly_activity_is_sorted(spark):
    df = spark.createDataFrame([(1_700_352_000, 3), (1_699_747_200, 5), (None, 1)], "week bigint, total int")
    assert [tuple(r) for r in shaping.weekly_activity(df).collect()] == [
        ("2023-11-12T00:00:00+00:00", 5), ("2023-11-19T00:00:00+00:00", 3), (None, 1)]
