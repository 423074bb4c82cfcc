"""P1-P13, R1, R2, A1-A8, W1, O1-O4, U1-U3, B1-B4."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregate, analytics, project
from tests.conftest import plan, rows


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, "x"), (1, "b", 2.0, None), (2, None, 3.0, "y"), (None, "c", None, "z"), (None, "d", 5.0, "z")],
        "k int, s string, v double, t string",
    )


def test_select_strict_and_lenient(df):
    assert project.select_strict(df, ["v", "k"]).columns == ["v", "k"]
    with pytest.raises(ValueError):
        project.select_strict(df, ["zz"])
    assert project.select_lenient(df, ["zz", "s", "k"]).columns == ["s", "k"]


def test_derive_in_order_and_filter_drops_null(df):
    out = project.derive(df, ["w = v * 2", "z = w + 1"])
    assert rows(project.where_all(out, ["z > 3", "k = 1"]).select("z")) == [(5.0,)]
    assert project.where_all(df, ["v > 0"]).count() == 4
    with pytest.raises(ValueError):
        project.derive(df, ["no assignment"])


def test_dropna_takes_nan_too(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert project.drop_missing(df, ["v"]).count() == 1


def test_dedupe_keeps_first_in_order_and_one_null_group(df):
    assert rows(project.dedupe(df, ["k"], ["v desc"]).select("k", "s")) == [(1, "b"), (2, None), (None, "d")]
    assert rows(project.dedupe(df, ["k"], ["v"]).select("k", "s")) == [(1, "a"), (2, None), (None, "d")]
    assert project.dedupe(df, ["k"]).count() == 3
    with pytest.raises(ValueError):
        project.dedupe(df, ["zz"])


def test_dedupe_limits_groups_before_the_exchange(df):
    text = plan(project.dedupe(df, ["k"], ["v"]))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_chain_has_a_fixed_order(spark):
    df = spark.createDataFrame([("1", "2025-01-01", "5", "n"), ("1", "2025-01-02", "6", "n"), ("x", "bad", "7", "n")], "a string, b string, c string, d string")
    params = {
        "dedupe_on": ["id"], "order_by": ["when desc"], "filter": ["total >= 5"], "parse_dates": ["when"],
        "dtypes": {"id": "int", "total": "float", "absent": "int"}, "select_final": ["id", "when", "total", "tag"],
        "derive": ["total = c", "tag = concat(total, '!')"], "rename": {"a": "id", "b": "when"}, "select": ["a", "b", "c"],
    }
    got = project.transform(df, params)
    assert rows(got.select("id", F.date_format("when", "dd"), "total", "tag")) == [(1, "02", 6.0, "6!"), (None, None, 7.0, "7!")]


def test_postprocess(df):
    out = project.postprocess(df, {"cast": {"k": "str", "v": "int"}, "dropna_any": ["k", "t"]})
    assert rows(out.select("k", "v")) == [("1", 1), ("2", 3)]
    assert project.postprocess(df, None) is df
    with pytest.raises(ValueError):
        project.postprocess(df, {"cast": {"zz": "int"}})


def test_totals_and_top(df):
    assert rows(aggregate.totals(df, "k", "v")) == [(1, 3.0), (2, 3.0), (None, 5.0)]
    top = aggregate.top_groups(aggregate.totals(df, "k"), 2)
    assert top.collect() == [(1, 2), (None, 2)] and "TakeOrderedAndProject" in plan(top)
    assert aggregate.count_rows(df).collect() == [(5,)]


def test_probe_partition_counts_last_and_unions(df):
    assert rows(aggregate.duplicate_probe(df, ["k"], "v")) == [(1, 2, 1.0, 2.0), (2, 1, 3.0, 3.0), (None, 2, 5.0, 5.0)]
    assert aggregate.partition_counts(df, ["k"]).collect() == [(None, 2), (1, 2), (2, 1)]
    last = aggregate.last_per_group(df, ["k"], [F.col("v").desc_nulls_last()])
    assert rows(last.select("k", "s")) == [(1, "b"), (2, None), (None, "d")] and "WindowGroupLimit" in plan(last)
    assert aggregate.union_all(df, df.select("t", "v", "s", "k")).count() == 10
    assert rows(aggregate.concat_by_name(df.select("k").limit(1), df.select("s").limit(1)))[0] == (1, None)
    assert aggregate.distinct_by(df, ["t"]).count() == 4


def test_reconcile(df):
    got = aggregate.reconcile({"a": df, "b": df}, {"a": df, "b": df.limit(1)})
    assert rows(got) == [("TOTAL", 10, 6, -4), ("a", 5, 5, 0), ("b", 5, 1, -4)]


def test_axes(spark, df):
    assert analytics.pick_axes(df.schema) == ("s", "k")
    assert analytics.pick_axes(spark.createDataFrame([(1, 2)], "a int, b int").schema) == ("a", "b")
    assert analytics.pick_axes(spark.createDataFrame([("1", "2")], "a string, b string").schema) == ("a", "b")
    assert analytics.pick_axes(spark.createDataFrame([(1,)], "a int").schema) == ("a", "a")


def test_summaries(spark, df):
    assert analytics.summarize(df.select("t", "v"), 2).collect() == [("z", 5.0), ("y", 3.0)]
    assert analytics.summarize(df.select("t", "s"), 1).collect() == [("z", 2)]
    flags = spark.createDataFrame([("a", True), ("a", True), ("b", False)], "x string, y boolean")
    assert analytics.summarize(flags).collect() == [("a", 2), ("b", 0)]
    done = analytics.summarize_all({"t": df, "one": df.select("k"), "none": df.limit(0)})
    assert list(done) == ["t"]


def test_series(spark):
    dated = spark.createDataFrame([("2025-01-02", 1.0), ("2025-01-01", 2.0), ("2025-01-03", None), ("odd", 9.0)], "x string, y double")
    got = analytics.series(dated).select(F.date_format("x", "dd"), "y").collect()
    assert got == [("01", 2.0), ("02", 1.0), (None, 9.0)]
    ranked = spark.createDataFrame([(f"c{i}", float(i)) for i in range(20)], "x string, y double")
    assert [r[0] for r in analytics.series(ranked).collect()] == [f"c{i}" for i in range(19, 9, -1)]
