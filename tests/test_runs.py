"""Group runs, independent runs, the ledger; specs of both dialects."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.plans import ledger, runner
from millrace.plans.spec import SourceSpec, group_sources, load_yaml
from tests.conftest import rows

AS_OF = datetime(2025, 8, 21, tzinfo=timezone.utc)

YAML = """
defaults: {mode: replace, group: daily}
groups:
  daily:
    - name: pop
      type: http_json
      table: population
      mode: incremental
      params:
        path: %(root)s/pop
        records_key_chain: ["1"]
        select: [date, value]
        rename: {date: year}
        enrich: {indicator_id: SP}
      incremental: {key: [year], cast_map: {year: INTEGER, value: DOUBLE}}
    - name: aq
      type: http_json
      table: air
      mode: incremental
      params:
        path: %(root)s/aq
        transform: hourly_time_value
        transform_args: {parameter: pm25, unit: u, latitude: 40.4, longitude: -3.7}
      incremental: {key: datetime_utc, cast_map: {datetime_utc: TIMESTAMP, value: DOUBLE}}
      export_parquet:
        dir: %(root)s/out/air
        overwrite: true
        export_sql: SELECT *, year(datetime_utc) AS year, lpad(CAST(month(datetime_utc) AS VARCHAR), 2, '0') AS month FROM air
        partition_by: [year, month]
    - name: quakes
      type: http_json
      table: quakes
      params: {path: %(root)s/q, transform: usgs_features, query: {starttime: "@now-7d", endtime: "@now", minmagnitude: 4.0}}
      post: {cast: {magnitude: float, depth_km: float}, dropna_any: [depth_km]}
"""
DQ = {
    "rules": {
        "population": {"schema": {"year": "int"}, "checks": [{"not_null": ["year", "value"]}, {"unique": ["year"]}], "on_fail": "warn"},
        "quakes": {"checks": [{"range": {"column": "magnitude", "min": 4, "max": 10}}]},
    }
}


def put(path, doc):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc))


@pytest.fixture
def config(tmp_path):
    put(tmp_path / "pop/1.json", [{"page": 1}, [{"date": "2020", "value": 5}, {"date": "2021", "value": None}, {"date": "XXXX", "value": 1}]])
    put(tmp_path / "aq/1.json", {"hourly": {"time": ["2025-08-19T00:00", "2025-09-01T01:00"], "pm2_5": [1.0, 2.0]}})
    ms = int(datetime(2025, 8, 20, tzinfo=timezone.utc).timestamp() * 1000)

    def quake(i, coords):
        return {"id": i, "properties": {"time": ms, "mag": 5.0}, "geometry": {"coordinates": coords}}

    put(tmp_path / "q/1.json", {"features": [quake("a", [1.0, 2.0, 3.0]), quake("b", [1.0, 2.0])]})
    (tmp_path / "sources.yml").write_text(YAML % {"root": tmp_path})
    return load_yaml(str(tmp_path / "sources.yml"))


def test_group_run_end_to_end(spark, wh, config, tmp_path):
    result = runner.run_group(spark, wh, config, DQ, "daily", as_of=AS_OF)
    assert (result.status, result.error) == ("ok", None)
    assert [(r.source.name, r.rows, r.decision) for r in result.results] == [("pop", 2, "warn"), ("aq", 2, "pass"), ("quakes", 1, "pass")]
    assert rows(wh.table("population")) == [(2020, 5.0, "SP"), (2021, None, "SP")]
    out = spark.read.option("basePath", str(tmp_path / "out/air")).parquet(str(tmp_path / "out/air"))
    assert rows(out.groupBy("year").count()) == [(2025, 2)]
    again = runner.run_group(spark, wh, config, DQ, "daily", as_of=AS_OF)
    assert [r.rows for r in again.results] == [0, 0, 1] and wh.table("population").count() == 2

    runs, metrics = ledger.runs(wh), ledger.metrics(wh)
    assert runs.count() == 2 and metrics.count() == 6
    assert ledger.last_run(runs).first()["run_id"] == again.run_id
    assert [r[0] for r in ledger.recent_runs(runs, 1).collect()] == [again.run_id]
    assert [r["table_name"] for r in ledger.last_loads(metrics).collect()] == ["air", "population", "quakes"]
    health = json.loads(ledger.run_health(runs).filter(F.col("run_id") == result.run_id).first()["health"])
    assert (health["status"], health["sources"], health["rows_total"], health["error"]) == ("ok", 3, 5, None)
    report = wh.table(ledger.DQ_REPORT).filter(F.col("run_id") == result.run_id)
    assert rows(report.select("table_name", "rule", "bad_rows")) == [
        ("population", "not_null(year,value)", 1), ("population", "unique(year)", 0), ("quakes", "range(magnitude,4,10)", 0)]


def test_fail_fast_stops_and_records(spark, wh, config):
    result = runner.run_group(spark, wh, config, DQ, "daily", fail_fast=True, as_of=AS_OF)
    assert result.status == "fail" and [r.source.name for r in result.results] == ["pop"]
    assert rows(ledger.metrics(wh).select("source_name", "dq_pass", "dq_violations")) == [("pop", False, 1)]


def test_block_does_not_publish(spark, wh, config):
    dq = {"rules": {"population": {**DQ["rules"]["population"], "on_fail": "block"}}}
    result = runner.run_group(spark, wh, config, dq, "daily", as_of=AS_OF)
    assert result.status == "ok" and not wh.exists("population") and wh.exists("air")
    assert result.results[0].rows == 0 and result.results[0].decision == "block"


def test_error_ends_a_group_but_not_an_independent_run(spark, wh, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "ok"))
    bad = {"name": "bad", "type": "csv_local", "table": "bad", "params": {"path": str(tmp_path / "missing.csv")}}
    good = {"name": "good", "type": "parquet", "table": "good", "params": {"path": str(tmp_path / "ok")}}
    result = runner.run_group(spark, wh, {"groups": {"g": [bad, good]}}, None, "g")
    assert result.status == "fail" and result.error and not wh.exists("good")
    both = runner.run_sources(wh, [bad, good])
    assert both.status == "fail" and wh.table("good").count() == 4
    got = {r["source_name"]: json.loads(r["health"]) for r in ledger.source_health(ledger.metrics(wh).filter(F.col("run_id") == both.run_id)).collect()}
    assert got["good"]["ok"] and got["good"]["rows"] == 4 and not got["bad"]["ok"] and "error" in got["bad"]


def test_rules_of_an_upsert_see_the_whole_table(spark, wh, tmp_path):
    for i, part in enumerate((spark.range(0, 10), spark.range(10, 20))):
        wh.publish(wh.write("t", part.withColumn("v", F.lit(1.0 if i else -1.0)).coalesce(1)))
    spark.range(15, 16).withColumn("v", F.lit(2.0)).write.parquet(str(tmp_path / "in"))
    source = {"type": "parquet", "target_table": "t", "load_mode": "upsert", "key_columns": ["id"], "path": str(tmp_path / "in")}
    dq = {"rules": {"t": {"checks": [{"range": {"column": "v", "min": 0}}, {"unique": ["id"]}]}}}
    report = runner.run_sources(wh, [source], dq).results[0].report
    assert [(r["rule"], r["bad_rows"], r["total_rows"]) for r in report] == [("range(v,0,)", 10, 20), ("unique(id)", 0, 20)]
    report = runner.run_sources(wh, [{**source, "dq_scope": "batch"}], dq).results[0].report
    # The batch is what was rewritten: the file that the first upsert left with the changed row alone.
    assert report[0]["bad_rows"] == 0 and report[0]["total_rows"] == 1


def test_failed_audit_leaves_no_files(spark, wh, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    source = {"type": "parquet", "target_table": "t", "path": str(tmp_path / "in"), "since_field": "id"}
    result = runner.run_sources(wh, [source], {"rules": {"t": {"checks": [{"unique": ["zz"]}]}}})
    assert not result.results[0].ok and not wh.exists("t")
    assert not list((tmp_path / "warehouse" / "t").iterdir()) and ledger.stored_since(wh, "t") is None


def test_empty_group(spark, wh):
    assert runner.run_group(spark, wh, {}, None, "none").status == "ok"


def test_high_water_mark_across_runs(spark, wh, tmp_path):
    source = {"type": "parquet", "target_table": "t", "load_mode": "append", "since_field": "id", "path": str(tmp_path / "in")}
    spark.range(0, 10).write.parquet(str(tmp_path / "in"))
    runner.run_sources(wh, [source])
    assert ledger.stored_since(wh, "t") == "9"
    spark.range(10, 12).write.mode("append").parquet(str(tmp_path / "in"))
    second = runner.run_sources(wh, [source])
    assert second.results[0].rows == 2 and second.results[0].since == "11"
    third = runner.run_sources(wh, [source])
    assert third.results[0].rows == 0 and ledger.stored_since(wh, "t") == "11"
    assert rows(wh.table("t")) == sorted([(i,) for i in range(12)], key=lambda r: str(r[0]))
    assert not [n for n in wh.tables() if n.startswith("_stage")]


def test_specs():
    flat = SourceSpec.from_dict({"type": "csv", "target_table": "t", "load_mode": "upsert", "key_columns": ["id"], "path": "p", "sep": ";", "every_minutes": 5, "order_by": "v desc"})
    assert flat.order_by == ("v desc",)
    assert (flat.name, flat.table, flat.mode, flat.keys, flat.params, flat.every_minutes) == ("t", "t", "upsert", ("id",), {"path": "p", "sep": ";"}, 5)
    grouped = group_sources({"defaults": {"mode": "append"}, "groups": {"g": [{"name": "n", "type": "csv_local"}]}}, "g")
    assert (grouped[0].mode, grouped[0].table) == ("append", "n")
    for wrong in ({"type": "csv"}, {"name": "n"}, {"name": "n", "type": "csv", "mode": "zz"}, {"name": "n", "type": "api"}):
        with pytest.raises(ValueError):
            SourceSpec.from_dict(wrong)


def test_ledger_queries_on_equal_and_missing_times(spark):
    schema = ledger.METRICS_SCHEMA
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)

    def row(run, table, at):
        return (run, "s", table, 1, 0.5, True, 0, at, 1, "replace", True, None, None, None)

    df = spark.createDataFrame([row("r1", "a", t1), row("r2", "a", t2), row("r3", "b", None), row("r4", "b", t1), row("r5", "b", t1)], schema)
    assert [(r["table_name"], r["loaded_at"]) for r in ledger.last_loads(df).collect()] == [("a", t2), ("b", t1)]
    assert [r["run_id"] for r in ledger.recent_metrics(df, 1).collect()] == ["r5", "r4", "r3"]
    assert [r["run_id"] for r in ledger.recent_metrics(df, 10, by_load_time=True).collect()] == ["r2", "r5", "r4", "r1", "r3"]


def test_run_ids_differ():
    now = datetime(2025, 1, 1)
    assert ledger.new_run_id(now) != ledger.new_run_id(now) and ledger.new_run_id(now).startswith("20250101_000000_")


def test_commands(spark, config, tmp_path, capsys):
    from millrace.__main__ import main

    place = ["--warehouse", str(tmp_path / "cli"), "--config", str(tmp_path / "sources.yml")]
    assert main(["run", *place]) == 0
    assert main(["export", *place]) == 0
    assert main(["status", "--last", "--json", *place]) == 0
    assert main(["summary", "--out", str(tmp_path / "top"), *place]) == 0
    printed = capsys.readouterr().out
    assert "pop -> population: 2 rows, pass" in printed and '"group_name":"daily"' in printed
    assert (tmp_path / "top" / "population_top").is_dir()
    assert main(["run", "--warehouse", str(tmp_path / "cli2"), "--config", str(tmp_path / "sources.yml"), "--group", "none"]) == 0


def test_side_by_side_sources_keep_the_order_within_a_table(spark, wh, tmp_path):
    sources = []
    for i in range(6):
        spark.range(i * 10, i * 10 + 10).withColumn("step", F.lit(i)).write.parquet(str(tmp_path / f"in{i}"))
        sources.append({"name": f"s{i}", "type": "parquet", "target_table": f"t{i % 2}", "path": str(tmp_path / f"in{i}"),
                        "load_mode": "append" if i % 2 else "replace", "since_field": "id"})
    result = runner.run_sources(wh, sources, parallel=4)
    assert result.status == "ok" and [r.source.name for r in result.results] == [f"s{i}" for i in range(6)]
    assert rows(wh.table("t0").select("step").distinct()) == [(4,)] and wh.table("t1").count() == 30
    assert ledger.since_values(wh).count() == 6 and ledger.metrics(wh).count() == 6
