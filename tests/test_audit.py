"""Audits that read what is new say what full ones say."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.plans import audit, load, runner
from millrace.plans.warehouse import Warehouse
from tests.conftest import plan, rows

BLOCK = {
    "schema": {"v": "float"},
    "checks": [{"not_null": ["id", "v"]}, {"unique": ["id"]}, {"unique": ["id", "g"]}, {"range": {"column": "v", "min": 0, "max": 90}}, {"unique": ["v"]}],
}
DQ = {"rules": {"t": BLOCK}}
RULES = quality.rules_for(DQ, "t")
SCHEMA = "id bigint, g string, v string"


def full(wh):
    return sorted((r["rule"], r["bad_rows"], r["total_rows"], r["passed"]) for r in quality.report(wh.table("t"), "t", RULES).collect())


def told(result):
    return sorted((r["rule"], r["bad_rows"], r["total_rows"], r["passed"]) for r in result.report)


def put(spark, tmp_path, step, values):
    path = str(tmp_path / f"in{step}")
    spark.createDataFrame(values, SCHEMA).write.parquet(path)
    return path


@pytest.mark.parametrize("mode", ["append", "incremental", "upsert", "replace"])
@pytest.mark.parametrize("limit", [None, 0])
def test_increments_are_judged_like_whole_tables(spark, wh, tmp_path, monkeypatch, mode, limit):
    if limit is not None:
        monkeypatch.setattr(audit.joins, "BROADCAST_KEY_BYTES", limit)
    rng = random.Random(mode)
    texts = [None, "NaN", "x", "1", "1.0", "-3", "95", "7"]
    for step in range(4):
        some = [(rng.choice([None, *range(step * 5, step * 5 + 12)]), rng.choice([None, "a", "b"]), rng.choice(texts)) for _ in range(12 if step != 2 else 0)]
        if mode == "upsert":
            some = list({r[0]: r for r in some if r[0] is not None}.values()) + [(None, "n", "2")] * 2
        source = {"type": "parquet", "target_table": "t", "load_mode": mode, "key_columns": ["id"], "path": put(spark, tmp_path, step, some)}
        result = runner.run_sources(wh, [source], DQ)
        assert result.error is None
        if some or mode != "replace":  # an empty batch replaces nothing; then the report is of nothing
            assert told(result.results[0]) == full(wh)


def test_only_the_new_batch_is_read(spark, wh, tmp_path, monkeypatch):
    wide = [(i, "a" * 50, str(i % 90)) for i in range(1000)]
    runner.run_sources(wh, [{"type": "parquet", "target_table": "t", "load_mode": "append", "path": put(spark, tmp_path, 0, wide)}], DQ)
    read, scanned = Warehouse.table, []
    monkeypatch.setattr(audit.TableAudit, "_row_counts", lambda *a: pytest.fail("earlier batches are counted again"))
    monkeypatch.setattr(quality, "repeats", lambda *a: pytest.fail("the whole table is grouped"))

    def unseen(batch, table, rules, rule, stats, real=audit.unseen_values):
        out = real(batch, table, rules, rule, stats)
        scanned.append((rule.label, plan(out)))
        return out

    monkeypatch.setattr(audit, "unseen_values", unseen)
    result = runner.run_sources(wh, [{"type": "parquet", "target_table": "t", "load_mode": "append", "path": put(spark, tmp_path, 1, [(990, "b", "5"), (1500, "b", "5")])}], DQ)
    assert result.error is None
    got = {r["rule"]: (r["bad_rows"], r["total_rows"]) for r in result.results[0].report}
    assert got["unique(id)"] == (1, 1002) and got["unique(id,g)"] == (0, 1002)
    plans = dict(scanned)
    assert "ReadSchema: struct<id:bigint>" in plans["unique(id)"] and "g:string" not in plans["unique(id)"]
    assert "GreaterThanOrEqual(id,990)" in plans["unique(id)"] and "LessThanOrEqual(id,1500)" in plans["unique(id)"]
    assert Warehouse.table is read


def test_other_rules_and_rewritten_batches_are_counted_anew(spark, wh, tmp_path):
    for step, values in enumerate(([(1, "a", "1"), (2, "a", "2")], [(2, "b", "3"), (2, "b", "100")])):
        runner.run_sources(wh, [{"type": "parquet", "target_table": "t", "load_mode": "append", "path": put(spark, tmp_path, step, values)}], DQ)
    wh.compact("t")
    load.load(wh, "t", spark.createDataFrame([(7, "z", "-1")], SCHEMA), "append")  # without rules
    result = runner.run_sources(wh, [{"type": "parquet", "target_table": "t", "load_mode": "append", "path": put(spark, tmp_path, 9, [(7, "z", "5")])}], DQ)
    assert told(result.results[0]) == full(wh)
    other = {"rules": {"t": {"checks": [{"unique": ["g"]}, {"not_null": ["g"]}]}}}
    result = runner.run_sources(wh, [{"type": "parquet", "target_table": "t", "load_mode": "append", "path": put(spark, tmp_path, 10, [(8, None, "5")])}], other)
    assert [(r["rule"], r["bad_rows"], r["total_rows"]) for r in result.results[0].report] == [("not_null(g)", 1, 7), ("unique(g)", 3, 7)]


def test_blocked_batches_leave_no_counts(spark, wh, tmp_path):
    dq = {"rules": {"t": {**BLOCK, "on_fail": "block"}}}
    good = {"type": "parquet", "target_table": "t", "load_mode": "append", "path": put(spark, tmp_path, 0, [(1, "a", "1")])}
    bad = {**good, "path": put(spark, tmp_path, 1, [(1, "a", "200")])}
    runner.run_sources(wh, [good], dq)
    assert runner.run_sources(wh, [bad], dq).results[0].decision == "block"
    last = runner.run_sources(wh, [{**good, "path": put(spark, tmp_path, 2, [(2, "a", "2")])}], dq).results[0]
    assert last.decision == "pass" and told(last) == full(wh)
    assert rows(wh.table(audit.AUDIT).groupBy("batch").agg(F.count("*") > 0)) == [("b00000001", True), ("b00000002", True)]
