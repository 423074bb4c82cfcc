"""Cases in which rows or values were once lost."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.plans import load
from millrace.plans.export import export_csv, spark_text_types
from millrace.sources import files, payload
from tests.conftest import rows


def payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("payload"))


def test_inferred_names_hold(spark):
    frame = payload.payload_frame(payloads(spark, '{"results": [{"VOIDED": 1, "a": null, "b c": {"OBJECT": "x"}, "VOID": [null]}]}'), ["results"])
    got = frame.collect()[0].asDict()
    assert got["VOIDED"] == 1 and got["a"] is None and got["b c.OBJECT"] == "x" and "VOID" in got


def test_scalar_records(spark):
    frame = payload.payload_frame(payloads(spark, '{"results": [1, "two", 3.5]}'), ["results"])
    assert frame.columns == ["value"] and [r.value for r in frame.collect()] == ["1", "two", "3.5"]


def test_text_types_of_casts_only():
    same = "SELECT lower(text) AS text, 'CAST(x AS TEXT)' AS varchar, \"a AS text\" FROM (SELECT 1 AS text)"
    assert spark_text_types(same) == same
    assert spark_text_types("CAST(a AS VARCHAR), try_cast(f(b) as text), CAST(c AS VARCHAR(3))") == "CAST(a AS STRING), try_cast(f(b) AS STRING), CAST(c AS VARCHAR(3))"


def test_partition_values_are_text(spark, tmp_path):
    spark.createDataFrame([(1, "01"), (2, "12")], "v int, month string").write.partitionBy("month").parquet(str(tmp_path / "t"))
    assert rows(files.read_parquet_tree(spark, str(tmp_path / "t"))) == [(1, "01"), (2, "12")]


def test_quotes_and_line_breaks(spark, tmp_path):
    data = [(1, 'He said "hi", ok', "x"), (2, "two\nlines", 'y"')]
    df = spark.createDataFrame(data, "a int, t string, u string")
    export_csv(df, str(tmp_path / "c"))
    assert rows(files.read_csv(spark, str(tmp_path / "c"), schema=df.schema, multi_line=True)) == data
    (tmp_path / "d.csv").write_text('skip\na,t,u\n1,"He said ""hi"", ok",x\n')
    for got in (files.read_csv_files(spark, str(tmp_path / "d.csv"), skiprows=1),):
        assert rows(got) == [(1, 'He said "hi", ok', "x")]


def test_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "2.csv").write_text("b,a\ny,2\n")
    with pytest.raises(Exception, match="header|Header"):
        files.read_csv(spark, str(tmp_path), schema="a string, b string").collect()


def test_first_upsert(spark, wh):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 1), (None, 3), (None, 4)], "k int, v int")
    with pytest.raises(ValueError, match="more than once"):
        load.load(wh, "t", df, "upsert", keys=["k"])
    assert not wh.exists("t")
    load.load(wh, "t", df, "upsert", keys=["k"], order_by=["v"])
    assert sorted(rows(wh.table("t")), key=str) == sorted([(1, 5), (2, 1), (None, 3), (None, 4)], key=str)


@pytest.mark.parametrize("limit", [0, 1 << 40])
def test_upsert_rewrites_the_same_batches(spark, wh, monkeypatch, limit):
    for k in range(3):
        load.load(wh, "t", spark.range(10 * k, 10 * k + 10).select("id", F.lit(0).alias("v")).coalesce(1), "append")
    before = set(wh.batches("t"))
    monkeypatch.setattr(joins, "BROADCAST_KEY_BYTES", limit)
    load.load(wh, "t", spark.createDataFrame([(12, 1), (13, 1)], "id bigint, v int"), "upsert", keys=["id"])
    assert len(before & set(wh.batches("t"))) == 2 and wh.table("t").filter("v = 1").count() == 2


def test_append_of_a_wrong_value_fails(spark, wh):
    load.load(wh, "t", spark.createDataFrame([(1,)], "v bigint"), "append")
    with pytest.raises(Exception):
        load.load(wh, "t", spark.createDataFrame([("x",)], "v string"), "append")
