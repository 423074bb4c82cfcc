"""K5, L3: merges that leave what they do not touch; B2 by digest; S6 page sets; R4 pools and limits."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregate, analytics, joins
from millrace.plans import ledger, load, runner
from millrace.plans.warehouse import Warehouse
from millrace.sources import payload, registry
from tests.conftest import plan, rows
from tests.test_audit import DQ, SCHEMA, full, told


def test_small_changes_of_wide_rows_exchange_no_table_row(spark, tmp_path):
    spark.range(2000).select("id", F.repeat(F.col("id").cast("string"), 200).alias("wide")).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(5, "x"), (9999, "y"), (None, "z")], "id bigint, wide string").write.parquet(str(tmp_path / "c"))
    table, changes = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "c"))
    merged = joins.merge_rows(table, changes, ["id"], 100)
    assert merged.count() == 2002 and rows(merged.filter("length(wide) = 1")) == [(5, "x"), (9999, "y"), (None, "z")]
    for line in plan(merged).splitlines():
        # What is exchanged is broadcast keys, and what is grouped of these.
        assert not ("Exchange hashpartitioning" in line and "wide" in line), line


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_untouched_files_are_not_rewritten(spark, wh, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_KEY_BYTES", limit)
    base = spark.range(400).withColumn("v", F.lit("old")).repartitionByRange(8, "id")
    load.load(wh, "t", base)
    (only,) = wh.batches("t")
    want = {i: "old" for i in range(400)}
    for step, ids in enumerate(([3, 4], [399, 5000], [3, 200])):
        batch = load.load(wh, "t", spark.createDataFrame([(i, f"s{step}") for i in ids], "id bigint, v string"), "upsert", keys=["id"])
        want |= {i: f"s{step}" for i in ids}
        assert rows(wh.table("t")) == rows(spark.createDataFrame(list(want.items()), "id bigint, v string"))
        assert batch.rows <= 160 and only in wh.batches("t")
    assert len(wh.gone_files("t")[only]) == 3
    wh.vacuum("t")
    assert wh.table("t").count() == 401
    load.load(wh, "t", wh.table("t").withColumn("v", F.lit("all")), "upsert", keys=["id"])
    assert only not in wh.batches("t") and wh.table("t").filter("v = 'all'").count() == 401
    wh.compact("t")
    wh.vacuum("t")
    assert Warehouse(spark, wh.root).table("t").count() == 401


def test_audits_after_files_went(spark, wh, tmp_path):
    steps = ([(i, "a", str(i % 80)) for i in range(200)], [(7, "a", "500"), (300, "b", None)], [(7, "b", "1")], [(400, None, "3"), (401, None, "3")])
    for step, values in enumerate(steps):
        path = str(tmp_path / f"in{step}")
        spark.createDataFrame(values, SCHEMA).repartitionByRange(4, "id").write.parquet(path)
        source = {"type": "parquet", "target_table": "t", "load_mode": "append" if step in (0, 3) else "upsert", "key_columns": ["id"], "path": path}
        result = runner.run_sources(wh, [source], DQ)
        assert result.error is None and told(result.results[0]) == full(wh)


def test_top_groups_of_long_keys(spark, monkeypatch):
    same = "same start " * 20
    texts = [same + str(i % 7) for i in range(60)] + ["b" * 300] * 5 + [None] * 6 + ["", "c"] * 2
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "x string, y int")
    for measure in (None, "y"):
        for k in (1, 3, 10, 50):
            want = rows(aggregate.top_groups(aggregate.totals(df, "x", measure), k))
            assert rows(aggregate.top_long_groups(df, "x", measure, k)) == want
    monkeypatch.setattr(aggregate, "MOST_FETCHED", 2)
    assert rows(aggregate.top_long_groups(df, "x", None, 3)) == rows(aggregate.top_groups(aggregate.totals(df, "x"), 3))


def test_no_long_text_is_ranked_or_exchanged_to_rank(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "doc_id")
    got = analytics.summarize(docs, 5)
    assert rows(got) == rows(aggregate.top_groups(aggregate.totals(docs, "text", "doc_id"), 5))
    text = plan(got).split("Initial Plan")[0]
    # The texts are read once, and only those whose digests were broadcast go on.
    assert "BroadcastHashJoin" in text and text.count("Scan parquet") == 1
    assert text.index("Exchange hashpartitioning") < text.index("BroadcastHashJoin")


def landed(tmp_path, pages):
    for i, doc in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc))
    return str(tmp_path)


def test_page_sets(spark, tmp_path):
    page = lambda n, of, ids: [{"page": n, "pages": of}, [{"id": i} for i in ids]]
    path = landed(tmp_path, [page(1, 3, [1, 2]), page(3, 3, [5]), page(3, 3, [5]), [{"note": 1}, [{"id": 9}]]])
    docs = payload.read_payloads(spark, path)
    params = {"path": path, "records_path": "1", "pages": {"page": [0, "page"], "pages": [0, "pages"]}}
    assert rows(payload.missing_pages(payload.numbered_pages(docs, [0, "page"], [0, "pages"]))) == [(2,)]
    with pytest.raises(ValueError, match="'page': 2"):
        registry.get_adapter("api")(spark, params, None)
    assert rows(registry.get_adapter("api")(spark, {**params, "on_gap": "ignore"}, None)) == [(1,), (2,), (5,), (9,)]
    landed(tmp_path, [page(2, 3, [3]), page(1, 3, [1, 2]), page(3, 3, [5])])
    assert rows(registry.get_adapter("api")(spark, params, None)) == [(1,), (2,), (3,), (5,), (9,)]
    two = docs.withColumn("s", F.lit("a")).unionByName(docs.withColumn("s", F.lit(None).cast("string")))
    assert payload.missing_pages(payload.numbered_pages(two, [0, "page"], [0, "pages"], ["s"]), ["s"]).filter("page > 3").count() == 0
    none = payload.complete_pages(docs.limit(0), [0, "page"], [0, "pages"])
    assert none.count() == 0


def test_a_large_source_neither_starves_nor_outlives_its_limit(spark, wh, tmp_path):
    spark.range(64).repartition(64).write.parquet(str(tmp_path / "large"))
    spark.range(3).write.parquet(str(tmp_path / "small"))
    slow = "s = aggregate(sequence(1, 4000000), id, (a, x) -> a + x % 7)"
    ended, real = {}, runner.run_source

    def timed(wh, source, *a):
        try:
            return real(wh, source, *a)
        finally:
            ended[source.name] = time.monotonic()

    large = {"name": "large", "type": "parquet", "target_table": "l", "path": str(tmp_path / "large"), "derive": [slow], "time_limit_seconds": 6}
    small = {"name": "small", "type": "parquet", "target_table": "s", "path": str(tmp_path / "small")}
    runner.run_source = timed
    try:
        result = runner.run_sources(wh, [large, small])
    finally:
        runner.run_source = real
    assert ended["small"] < ended["large"] and wh.table("s").count() == 3
    assert result.status == "fail" and "cancelled after 6 s" in result.results[0].error and not wh.exists("l")
    assert rows(ledger.metrics(wh).select("source_name", "ok")) == [("large", False), ("small", True)]
    assert threading.active_count() < 50
    again = runner.run_sources(wh, [{**large, "derive": [], "time_limit_seconds": 600}])
    assert again.status == "ok" and wh.table("l").count() == 64


def test_sweep_removes_what_crashed_loads_left(spark, wh):
    load.load(wh, "t", spark.range(3))
    wh.write("t", spark.range(5), tag="q_1")
    wh.stage("t", spark.range(7))
    assert wh.sweep(1) == 0
    time.sleep(1.1)
    assert wh.sweep(0) == 2 and wh.table("t").count() == 3 and wh.sweep(0) == 0
    load.load(wh, "t", spark.range(2), "append")
    assert wh.table("t").count() == 5
