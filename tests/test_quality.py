"""Q1-Q7: rules, reports, verdicts, gates."""

import pytest

from millrace.operators import quality
from tests.conftest import plan, rows

BLOCK = {
    "schema": {"year": "int", "value": "float", "absent": "int"},
    "checks": [
        {"not_null": ["year", "value"]},
        {"unique": ["year"]},
        {"range": {"column": "value", "min": 0, "max": 100}},
        {"range": {"column": "absent", "min": 0}},
    ],
    "on_fail": "block",
}
DQ = {"rules": {"t": BLOCK}}


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [("2020", "1"), ("2020", "NaN"), ("x", "101"), ("y", "-1"), ("2021", "inf"), ("2022", "100"), ("2023", "0")],
        "year string, value string",
    )


def test_report(df):
    got = quality.report(df, "t", quality.rules_for(DQ, "t"))
    assert rows(got) == [
        ("t", "not_null(year,value)", 3, 7, False),
        ("t", "range(absent,0,)", 0, 7, True),
        ("t", "range(value,0,100)", 3, 7, False),
        ("t", "unique(year)", 2, 7, False),  # 2020 once more, and the two NULL years are one value
    ]


def test_verdict_counts_rules_not_rows(df):
    v = quality.check(df, "t", DQ)
    assert (v.passed, v.violations, v.on_fail) == (False, 3, "block")
    frame = quality.verdict_frame(quality.report(df, "t", quality.rules_for(DQ, "t")), "t", "block")
    assert frame.collect() == [("t", 3, False, "block")]


def test_no_rules_pass(df):
    assert quality.check(df, "other", DQ) == quality.check(df, "t", None) == quality.Verdict(True, 0, "warn")
    assert quality.report(df, "t", quality.TableRules({}, ())).count() == 0


def test_bounds_inclusive_or_not(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,), (float("nan"),)], "v double")

    def bad(**options):
        rules = quality.rules_for({"rules": {"t": {"checks": [{"range": {"column": "v", **options}}]}}}, "t")
        return quality.report(df, "t", rules).first()["bad_rows"]

    assert bad(min=0, max=10) == 0
    assert bad(min=0, max=10, inclusive=False) == 2
    assert bad(max=4) == 2 and bad(min=6) == 2


def test_composite_unique_and_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan), (1, nan), (1, None), (1, None), (2, 0.0)], "a int, b double")
    rules = quality.rules_for({"rules": {"t": {"checks": [{"unique": ["a", "b"]}, {"not_null": ["b"]}]}}}, "t")
    assert rows(quality.report(df, "t", rules).select("rule", "bad_rows")) == [("not_null(b)", 4), ("unique(a,b)", 2)]


def test_rules_on_missing_columns(df):
    for check in ({"not_null": ["zz"]}, {"unique": ["zz"]}):
        rules = quality.rules_for({"rules": {"t": {"checks": [check]}}}, "t")
        with pytest.raises(ValueError):
            quality.report(df, "t", rules)


def test_row_rules_share_one_scan(spark, wh):
    wh.publish(wh.write("t", spark.range(10).selectExpr("id AS year", "id AS value", "id AS other")))
    checks = {"checks": [{"not_null": ["year"]}, {"not_null": ["value"]}, {"range": {"column": "value", "min": 0}}]}
    rules = quality.rules_for({"rules": {"t": checks}}, "t")
    text = plan(quality.report(wh.table("t"), "t", rules))
    assert text.count("FileScan") == 1 and "other" not in text


def test_observed_counts_need_no_scan(spark, wh, df):
    rules = quality.rules_for(DQ, "t")
    batch = wh.publish(wh.write("t", df, metrics=lambda d: quality.row_counts(d, rules)))
    assert batch.counters["_total"] == 7
    observed = quality.report(wh.table("t"), "t", rules, batch.counters)
    assert plan(observed).count("FileScan") == 1  # the uniqueness rule's
    assert rows(observed) == rows(quality.report(df, "t", rules))


def test_gate():
    ok, warn, block = (quality.Verdict(p, 1, f) for p, f in ((True, "block"), (False, "warn"), (False, "block")))
    assert [quality.gate(v) for v in (ok, warn, block)] == ["pass", "warn", "block"]
    assert [quality.gate(v, fail_fast=True) for v in (ok, warn, block)] == ["pass", "stop", "stop"]
