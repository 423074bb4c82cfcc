"""Streams over landed files equal the batch jobs on the same files."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.plans import load
from millrace.plans.warehouse import Warehouse
from millrace.streaming import ingest
from tests.conftest import rows

SCHEMA = "id string, v string"
CASTS = {"id": "BIGINT", "v": "DOUBLE"}


def land(spark, path, values, files=3):
    spark.createDataFrame(values, SCHEMA).repartition(files, "id").write.mode("append").parquet(path)


def test_incremental_stream_equals_batch_and_resumes(spark, wh, tmp_path):
    landed, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    values = [(str(i % 50), str(i)) for i in range(50)] + [(None, "1"), ("BAD", "2")]
    land(spark, landed, values)

    def run():
        stream = ingest.file_stream(spark, landed, SCHEMA, max_files=1)
        ingest.ingest_incremental(stream, wh, "t", ["id"], checkpoint, CASTS).awaitTermination()

    run()
    batch_wh = Warehouse(spark, str(tmp_path / "batch"))
    load.load(batch_wh, "t", spark.read.parquet(landed), "incremental", keys=["id"], cast_map=CASTS)
    assert rows(wh.table("t")) == rows(batch_wh.table("t"))
    land(spark, landed, [("49", "x"), ("50", "7")])
    run()
    assert wh.table("t").count() == 51
    run()
    assert wh.table("t").count() == 51


def replay(tmp_path, name):
    """Forget that the last micro-batch of a query ended."""
    commits = tmp_path / name / "commits"
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("tidy", [False, True])
def test_replayed_micro_batch_is_loaded_once(spark, wh, tmp_path, tidy):
    landed = str(tmp_path / "in")
    land(spark, landed, [("1", "1")])

    def run(name):
        ingest.append_stream(ingest.file_stream(spark, landed, SCHEMA), wh, "t", str(tmp_path / name)).awaitTermination()

    run("a")
    if tidy:
        wh.compact("t")
        wh.vacuum("t")
    replay(tmp_path, "a")
    run("a")
    assert wh.table("t").count() == 1
    land(spark, landed, [("2", "2")])
    run("a")
    run("b")  # another query: all that is there
    assert wh.table("t").count() == 4


def test_two_streams_into_one_table(spark, wh, tmp_path):
    for name, ids in (("a", range(5)), ("b", range(5, 10))):
        land(spark, str(tmp_path / f"in_{name}"), [(str(i), "1") for i in ids])
        stream = ingest.file_stream(spark, str(tmp_path / f"in_{name}"), SCHEMA)
        if name == "b":
            stream = stream.select("v", "id")  # aligned by name
        ingest.append_stream(stream, wh, "t", str(tmp_path / name)).awaitTermination()
    assert sorted(r.id for r in wh.table("t").collect()) == [str(i) for i in range(10)]


def test_dedupe_stream(spark, wh, tmp_path):
    landed = str(tmp_path / "in")
    df = spark.range(100).select("id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts"))
    df.unionByName(df).repartition(4).write.parquet(landed)
    once = ingest.dedupe_stream(ingest.file_stream(spark, landed, df.schema, max_files=1), ["id"], "ts", "1 day")
    ingest.append_stream(once, wh, "t", str(tmp_path / "cp")).awaitTermination()
    assert rows(wh.table("t").select("id")) == rows(df.select("id"))


def test_quality_stream(spark, wh, tmp_path):
    landed = str(tmp_path / "in")
    land(spark, landed, [("1", "5"), (None, "NaN")], 1)
    land(spark, landed, [("x", "500"), ("4", "-1")], 1)
    block = {"schema": {"id": "int", "v": "float"}, "checks": [{"not_null": ["id", "v"]}, {"range": {"column": "v", "min": 0, "max": 400}}]}
    rules = quality.rules_for({"rules": {"t": block}}, "t")
    stream = ingest.file_stream(spark, landed, SCHEMA, max_files=1)
    ingest.quality_stream(stream, wh, "t", rules, "m", str(tmp_path / "cp")).awaitTermination()
    got = wh.table("m").groupBy("rule").agg(F.sum("bad_rows"), F.sum("total_rows"))
    assert rows(got) == [("not_null(id,v)", 2, 4), ("range(v,0,400)", 2, 4)]
    assert wh.table("m").select("batch_id").distinct().count() == 2


def test_periodic_sources(spark, wh, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("id;v\n1;5\nx;6\n2;7\n")
    spark.range(3).write.parquet(str(tmp_path / "pq"))
    sources = [
        {"name": "inc", "type": "csv_local", "table": "t", "mode": "incremental", "incremental": {"key": "id", "cast_map": CASTS},
         "params": {"path": str(tmp_path / "in"), "schema": SCHEMA, "sep": ";", "filter": ["v <> '7'"]}},
        {"name": "app", "type": "parquet", "table": "p", "mode": "append", "params": {"path": str(tmp_path / "pq"), "schema": "id bigint"}},
    ]
    for _ in range(2):
        for query in ingest.stream_sources(wh, sources, str(tmp_path / "cp"), None).values():
            query.awaitTermination()
    assert rows(wh.table("t")) == [(1, 5.0)] and wh.table("p").count() == 3
    with pytest.raises(ValueError):
        ingest.stream_sources(wh, [{**sources[1], "mode": "replace"}], str(tmp_path / "cp"), None)
    with pytest.raises(ValueError):
        ingest.stream_sources(wh, [{**sources[1], "params": {"path": "x"}}], str(tmp_path / "cp"), None)
