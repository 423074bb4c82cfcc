"""File scans, windows, marks, registry."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.plans.export import export_frame
from millrace.sources import files, registry, windows
from tests.conftest import plan, rows

AS_OF = datetime(2024, 1, 31, 12, tzinfo=timezone.utc)


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_single_csv_infers_types(spark, tmp_path):
    p = write(tmp_path / "ventas.csv", "fecha,producto,importe,region\n2025-01-01,A,10,N\n2025-01-02,B,20,S\n")
    df = files.read_csv(spark, p)
    assert [t for _, t in df.dtypes] == ["date", "string", "int", "string"] and df.count() == 2
    with pytest.raises(ValueError):
        files.read_csv(spark, "")


def test_csv_separator_encoding_and_schema(spark, tmp_path):
    p = write(tmp_path / "x.csv", "a;b\n1;ñ\n", "latin-1")
    assert files.read_csv(spark, p, ";", "ISO-8859-1").collect() == [(1, "ñ")]
    assert files.read_csv(spark, p, ";", "ISO-8859-1", "a string, b string").collect() == [("1", "ñ")]


def test_many_csv_unite_by_name(spark, tmp_path):
    write(tmp_path / "d" / "1.csv", "id,v\n1,1.5\n2,\n")
    write(tmp_path / "d" / "2.csv", "v,id,extra\n2.5,3,z\n")
    df = files.read_csv_files(spark, str(tmp_path / "d" / "*.csv"))
    assert df.columns == ["id", "v", "extra"]
    assert rows(df) == [(1, 1.5, None), (2, None, None), (3, 2.5, "z")]
    assert dict(df.dtypes) == {"id": "bigint", "v": "double", "extra": "string"}


def test_many_csv_options(spark, tmp_path):
    write(tmp_path / "d" / "1.csv", "junk\nid;when;v\n7;2025-08-20;NA\n8;bad;-\n9;2025-08-21;5\n")
    df = files.read_csv_files(
        spark, str(tmp_path / "d" / "*.csv"), sep=";", skiprows=1, usecols=["id", "when", "v"], dtype={"v": "float"},
        parse_dates=["when"], na_values={"v": "-"},
    )
    got = df.select("id", F.date_format("when", "yyyy-MM-dd"), "v")
    assert rows(got) == [(7, "2025-08-20", None), (8, None, None), (9, "2025-08-21", 5.0)]


def test_skipped_lines_are_the_first_of_each_file_only(spark, tmp_path):
    for i in range(5):
        body = "".join(f"{i * 1000 + j};# note\n" for j in range(300))
        write(tmp_path / "d" / f"{i}.csv", f"# note\n# note\nid;t\n{body}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # several splits per file
    try:
        df = files.read_csv_files(spark, str(tmp_path / "d" / "*.csv"), sep=";", skiprows=2)
        assert rows(df.select("id")) == sorted([(i * 1000 + j,) for i in range(5) for j in range(300)], key=lambda r: str(r[0]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_data_lines_like_skipped_lines_stay(spark, tmp_path, monkeypatch):
    write(tmp_path / "d" / "1.csv", "1;a\n1;a\nid;t\n1;a\n1;a\n1;a\n2;b\n")
    write(tmp_path / "d" / "2.csv", "note\n1;a\nid;t\n1;a\nid;t\n\n")
    write(tmp_path / "d" / "3 ñ%.csv", "\ufeffnote\n\nid;t\n9;z\n")
    want = sorted([("1", "a")] * 4 + [("2", "b"), ("id", "t"), ("9", "z")])
    for bound in (50_000, 3):  # one read, or one per file
        monkeypatch.setattr(files, "HEAD_LINES_BROADCAST", bound)
        df = files.read_csv_files(spark, str(tmp_path / "d" / "*.csv"), sep=";", skiprows=2, dtype={"id": "str", "t": "str"})
        assert rows(df) == want


def test_many_lines_like_a_skipped_line(spark, tmp_path):
    write(tmp_path / "d" / "1.csv", "5\nid\n" + "5\n" * 25_000)
    df = files.read_csv_files(spark, str(tmp_path / "d" / "*.csv"), skiprows=1)
    assert df.count() == 25_000 and df.distinct().collect() == [(5,)]


def test_no_files_and_missing_columns_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv_files(spark, str(tmp_path / "none" / "*.csv"))
    write(tmp_path / "d" / "1.csv", "a\n1\n")
    with pytest.raises(ValueError):
        files.read_csv_files(spark, str(tmp_path / "d" / "*.csv"), usecols=["b"])


def test_bom_and_quoted_header(spark, tmp_path):
    write(tmp_path / "d" / "1.csv", '﻿"a,x",b\n"1,5",2\n')
    assert files.read_csv_files(spark, str(tmp_path / "d" / "*.csv")).columns == ["a,x", "b"]


def test_repeated_and_empty_header_names_and_booleans(spark, tmp_path):
    write(tmp_path / "d" / "1.csv", "a,a,,f,g\n1,2,3,True,true\n4,5,6,FALSE,x\n")
    df = files.read_csv_files(spark, str(tmp_path / "d" / "*.csv"))
    assert df.columns == ["a", "a.1", "Unnamed: 2", "f", "g"]
    assert rows(df) == [(1, 2, 3, True, "true"), (4, 5, 6, False, "x")]


def test_normalized_names(spark, tmp_path):
    p = write(tmp_path / "n.csv", "Año Fiscal,B--c\n1,2.5\n")
    assert files.read_csv_normalized(spark, p).dtypes == [("a_o_fiscal", "int"), ("b_c", "double")]


def test_partition_values_keep_their_declared_type(spark, tmp_path):
    df = spark.createDataFrame([(1, 2024, "01"), (2, 2025, "12"), (3, None, "01")], "id int, year int, month string")
    path = export_frame(df, str(tmp_path / "t"), ["year", "month"])
    back = files.read_parquet_tree(spark, path, "year int, month string")
    assert rows(back) == [(1, 2024, "01"), (2, 2025, "12"), (3, None, "01")]
    pruned = back.filter("year >= 2025")
    assert "PartitionFilters: [isnotnull(year" in plan(pruned) and pruned.count() == 1


def test_preview(spark):
    assert files.preview(spark.range(100), 3, [F.desc("id")]).collect() == [(99,), (98,), (97,)]


def test_window_filter_is_pushed(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    df = windows.window_filter(e, "ts", {"starttime": "@now-7d", "endtime": "@now", "minmagnitude": 4}, AS_OF, "value")
    text = plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-24" in text and "LessThan(ts,2024-01-31" in text and "GreaterThanOrEqual(value,4.0)" in text


def test_marks(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "n int")
    assert windows.high_water_mark(df, "n").first()[0] == "10"  # by value, not as text
    assert rows(windows.past(df, "n", "9")) == [(10,)]
    assert windows.past(df, "n", None).count() == 3


def test_registry(spark):
    assert {"csv_local", "csv_local_simple", "http_json", "http_json_simple"} <= registry.ADAPTERS.keys()
    with pytest.raises(ValueError):
        registry.get_adapter("nothing")
    with pytest.raises(ValueError):
        registry.get_transform("nothing")
    with pytest.raises(ValueError):
        registry.get_adapter("http_json")(spark, {"url": "http://x"}, AS_OF)


def test_landed_adapters(spark, tmp_path):
    page = '[{"page": 1}, [{"date": "2020", "value": 5, "indicator": {"id": "I"}}]]'
    write(tmp_path / "p" / "1.json", page)
    params = {"path": str(tmp_path / "p"), "records_key_chain": ["1"], "select": ["date", "value", "zz"],
              "rename": {"date": "year"}, "enrich": {"indicator_id": "SP"}}
    assert registry.get_adapter("http_json")(spark, params, AS_OF).collect() == [("2020", 5, "SP")]
    simple = {"path": str(tmp_path / "p"), "root_index": 1, "flatten_sep": "_", "select": ["date", "indicator_id"],
              "rename": {"date": "year"}, "dtypes": {"year": "int"}}
    assert registry.get_adapter("http_json_simple")(spark, simple, AS_OF).collect() == [(2020, "I")]
    write(tmp_path / "r" / "1.json", '{"a": {"rows": [{"x": 1, "y": {"z": 2}}, {"x": 3, "y": {"z": 4}}]}}')
    nested = {"path": str(tmp_path / "r"), "record_path": ["a", "rows"], "filter": ["x > 1"]}
    assert registry.get_adapter("http_json_simple")(spark, nested, AS_OF).collect() == [(3, 4)]
    write(tmp_path / "h" / "1.json", '{"hourly": {"time": ["2025-08-20T00:00"], "pm2_5": [1.5]}}')
    hourly = {"path": str(tmp_path / "h"), "hourly_to_rows": {"time_field": "time", "value_field": "pm2_5", "constant_fields": {"u": "x"}},
              "rename": {"time": "ts"}, "parse_dates": ["ts"]}
    assert registry.get_adapter("http_json_simple")(spark, hourly, AS_OF).select(F.hour("ts"), "pm2_5", "u").collect() == [(0, 1.5, "x")]
    transform = {"path": str(tmp_path / "h"), "transform": "hourly_time_value", "transform_args": {"parameter": "pm25"}}
    assert registry.get_adapter("http_json")(spark, transform, AS_OF).select("value", "parameter").collect() == [(1.5, "pm25")]


def test_feature_adapter_applies_the_query_window(spark, tmp_path):
    old, new = 1_600_000_000_000, int(datetime(2024, 1, 30, tzinfo=timezone.utc).timestamp() * 1000)
    feature = '{"id": "%s", "properties": {"time": %d, "mag": %s}, "geometry": {"coordinates": [1.0, 2.0, 3.0]}}'
    doc = '{"features": [%s]}' % ",".join([feature % ("a", old, "5.0"), feature % ("b", new, "5.0"), feature % ("c", new, "3.0")])
    write(tmp_path / "q" / "1.json", doc)
    params = {"path": str(tmp_path / "q"), "transform": "usgs_features",
              "query": {"starttime": "@now-7d", "endtime": "@now", "minmagnitude": 4.0, "format": "geojson"}}
    assert rows(registry.get_adapter("http_json")(spark, params, AS_OF).select("event_id")) == [("b",)]


def test_flat_dialect_adapters(spark, tmp_path):
    write(tmp_path / "c.csv", "a\n1\n")
    assert registry.get_adapter("csv")(spark, {"path": str(tmp_path / "c.csv")}, AS_OF).collect() == [(1,)]
    write(tmp_path / "j" / "1.json", '{"d": {"i": [{"a": 1}]}}')
    assert registry.get_adapter("json")(spark, {"path": str(tmp_path / "j"), "records_path": "d.i"}, AS_OF).collect() == [(1,)]
    write(tmp_path / "a" / "1.json", '{"next": "x", "rows": [{"a": 1}]}')
    write(tmp_path / "a" / "2.json", '{"next": null, "rows": []}')
    write(tmp_path / "a" / "3.json", '{"rows": [{"a": 2, "b": {"c": 3}}]}')
    got = registry.get_adapter("api")(spark, {"path": str(tmp_path / "a"), "records_path": "rows"}, AS_OF)
    assert rows(got) == [(1, None), (2, 3)]
