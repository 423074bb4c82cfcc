"""G1, R5, P11 in streams: micro-batches as runs, once each; the best row of a key with bounded state."""

import pytest
from pyspark.sql import functions as F

from millrace.plans import export, ledger, runner
from millrace.plans.spec import SourceSpec
from millrace.streaming import ingest
from tests.conftest import rows
from tests.test_streaming import replay

SCHEMA = "id bigint, p string, v double"
DQ = {"rules": {"t": {"checks": [{"unique": ["id"]}, {"range": {"column": "v", "min": 0}}], "on_fail": "block"}}}


def source(tmp_path, **more):
    return {
        "name": "s", "type": "parquet", "table": "t", "mode": "incremental", "incremental": {"key": ["id"]},
        "params": {"path": str(tmp_path / "in"), "schema": SCHEMA},
        "export_parquet": {"dir": str(tmp_path / "out"), "partition_by": ["p"], "touched_only": True}, **more,
    }


def land(spark, tmp_path, values):
    spark.createDataFrame(values, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def run(wh, tmp_path, spec):
    ingest.stream_sources(wh, [spec], str(tmp_path / "cp"), None, DQ)["s"].awaitTermination()


def recorded(wh):
    return rows(ledger.metrics(wh).select(F.substring_index("run_id", "_", -1).cast("int"), "rows_loaded", "rows_table", "dq_pass"))


def test_micro_batches_are_runs(spark, wh, tmp_path):
    spec = source(tmp_path)
    land(spark, tmp_path, [(1, "a", 1.0), (2, "b", 2.0)])
    run(wh, tmp_path, spec)
    before = {f.name for f in (tmp_path / "out" / "p=a").iterdir()}
    land(spark, tmp_path, [(3, "c", -1.0)])
    run(wh, tmp_path, spec)  # blocked
    land(spark, tmp_path, [(2, "b", 9.0), (4, "b", 4.0)])
    run(wh, tmp_path, spec)
    assert rows(wh.table("t")) == [(1, "a", 1.0), (2, "b", 2.0), (4, "b", 4.0)]
    assert recorded(wh) == [(0, 2, 2, True), (1, 0, 2, False), (2, 1, 3, True)]
    assert rows(ledger.runs(wh).select("rows_total", "status")) == [(0, "ok"), (1, "ok"), (2, "ok")]
    report = wh.table(ledger.DQ_REPORT).groupBy("rule").agg(F.max("total_rows"), F.sum("bad_rows"))
    assert rows(report) == [("range(v,0,)", 3, 1), ("unique(id)", 3, 0)]
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("id", "p")) == [(1, "a"), (2, "b"), (4, "b")]
    # The first partition was not touched again.
    assert {f.name for f in (tmp_path / "out" / "p=a").iterdir()} == before


@pytest.mark.parametrize("step", ["_record_sources", "finish", "export_table", "tidy"])
def test_a_killed_run_has_one_metrics_row(spark, wh, tmp_path, monkeypatch, step):
    spec = source(tmp_path)
    land(spark, tmp_path, [(1, "a", 1.0)])
    run(wh, tmp_path, spec)
    land(spark, tmp_path, [(2, "b", 2.0)])
    place = ledger if step == "tidy" else runner
    real, calls = getattr(place, step), []

    def killed(*a, **k):
        if not calls:
            calls.append(1)
            real(*a, **k)  # the step itself ends, what comes after does not
            raise RuntimeError("killed")
        return real(*a, **k)

    monkeypatch.setattr(place, step, killed)
    with pytest.raises(Exception):
        run(wh, tmp_path, spec)
    run(wh, tmp_path, spec)
    run(wh, tmp_path, spec)
    assert recorded(wh) == [(0, 1, 1, True), (1, 1, 2, True)] and ledger.runs(wh).count() == 2
    assert rows(wh.table("t").select("id")) == [(1,), (2,)]
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("id")) == [(1,), (2,)]
    replay(tmp_path, "cp/s")
    run(wh, tmp_path, spec)
    assert len(recorded(wh)) == 2 and wh.table("t").count() == 2


def test_ledger_is_tidied(spark, wh, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_BATCHES", 1)
    for i in range(3):
        land(spark, tmp_path, [(i, "a", 1.0)])
        run(wh, tmp_path, source(tmp_path))
    assert len(wh.batches(ledger.METRICS)) <= 2 and len(recorded(wh)) == 3


def test_best_row_of_a_key(spark, wh, tmp_path):
    schema = "k string, ts timestamp, v int, w string"

    def land_best(values):
        spark.createDataFrame(values, "k string, s int, v int, w string").select(
            "k", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts"), "v", "w"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    spec = {"name": "s", "type": "parquet", "table": "t", "mode": "append",
            "params": {"path": str(tmp_path / "in"), "schema": schema, "dedupe_on": ["k"], "order_by": ["v desc", "w"],
                       "watermark": {"column": "ts", "delay": "10 seconds"}}}

    def go():
        query = ingest.stream_sources(wh, [spec], str(tmp_path / "cp"), None)["s"]
        query.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]

    land_best([("a", 0, 1, "x"), ("a", 1, 5, "z"), ("b", 2, None, "n"), (None, 3, 1, "x"), ("a", 5, 5, "y")])
    go()
    land_best([("a", 9, 2, "q"), ("b", 4, 3, "m"), (None, 4, 0, "x"), ("c", 30, 1, "c"), ("c", 30, 1, "c")])
    go()
    land_best([("d", 100, 1, "d"), ("a", 2, 99, "late")])
    left = go()
    got = wh.table("t").select("k", "v", "w")
    assert rows(got) == [("a", 5, "y"), ("b", 3, "m"), ("c", 1, "c"), (None, 1, "x")]
    assert left == 1  # only the last key is still held
    with pytest.raises(ValueError, match="watermark"):
        ingest.stream_sources(wh, [{**spec, "params": {**spec["params"], "watermark": None}}], str(tmp_path / "cp2"), None)


def test_failed_export_leaves_the_old_one(spark, wh, tmp_path):
    out = str(tmp_path / "out")
    export.export_frame(spark.range(3).withColumn("p", F.col("id") % 2), out, ["p"])
    bad = spark.range(3, 9).withColumn("p", F.when(F.col("id") > 7, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id") % 2))
    for job in (lambda: export.export_frame(bad, out, ["p"]), lambda: export.export_touched(bad, spark.range(1).select(F.lit(0).cast("bigint").alias("p")), out, ["p"])):
        with pytest.raises(Exception, match="stop"):
            job()
        assert rows(spark.read.parquet(out).select("id")) == [(0,), (1,), (2,)]
    export.export_frame(spark.range(5, 7).withColumn("p", F.lit(7)), out, ["p"])
    assert rows(spark.read.parquet(out).select("id")) == [(5,), (6,)]
    assert [f.name for f in tmp_path.iterdir() if f.name.startswith("out")] == ["out"]


def test_touched_partitions_of_a_query_and_of_an_upsert(spark, wh, tmp_path):
    out = str(tmp_path / "out")
    options = {"dir": out, "partition_by": ["p"], "touched_only": True, "export_sql": "SELECT id, v, CASE WHEN v > 1 THEN 'x y' WHEN v > 0 THEN 'b' END AS p FROM t"}
    spec = SourceSpec.from_dict({"name": "t", "type": "parquet", "mode": "upsert", "key_columns": ["id"], "export_parquet": options, "params": {"path": "in"}})
    steps = ([(1, 0.5), (2, 2.0)], [(3, -1.0), (4, 0.7)], [(3, 5.0)])
    for step, values in enumerate(steps):
        path = str(tmp_path / f"in{step}")
        spark.createDataFrame(values, "id bigint, v double").write.parquet(path)
        done = runner.run_sources(wh, [{"name": "t", "type": "parquet", "table": "t", "mode": spec.mode, "key_columns": ["id"], "path": path, "export_parquet": options}])
        assert done.error is None
        whole = export.query_frame(wh, options["export_sql"])
        assert rows(spark.read.parquet(out).select("id", "v", "p")) == rows(whole.select("id", "v", "p"))
    assert not (tmp_path / "out" / "p=__HIVE_DEFAULT_PARTITION__").exists()


def test_stream_and_tidy_commands(spark, wh, tmp_path, capsys):
    from millrace.__main__ import main

    land(spark, tmp_path, [(1, "a", 1.0)])
    (tmp_path / "s.yml").write_text(f"""
defaults: {{mode: append, db_path: x}}
groups:
  daily:
    - {{name: s, type: parquet, table: t, params: {{path: {tmp_path}/in, schema: "{SCHEMA}"}}}}
""")
    place = ["--warehouse", wh.root, "--config", str(tmp_path / "s.yml")]
    for i in range(2):
        assert main(["stream", *place, "--checkpoint", str(tmp_path / "cp"), "--once"]) == 0
        land(spark, tmp_path, [(2 + i, "a", 1.0)])
    assert rows(wh.table("t").select("id")) == [(1,), (2,)] and len(recorded(wh)) == 2
    assert main(["tidy", *place, "--most-batches", "1"]) == 0
    assert len(wh.batches("t")) == 1 and wh.table("t").count() == 2
    assert "t: 2 batches removed" in capsys.readouterr().out
    assert main(["stream", *place, "--checkpoint", str(tmp_path / "cp"), "--once"]) == 0
    assert wh.table("t").count() == 3 and len(recorded(wh)) == 3
    with pytest.raises(SystemExit):
        main(["stream", *place])
