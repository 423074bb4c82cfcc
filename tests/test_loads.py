"""Joins, loads and exports, on the noise the jobs have to survive."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.casts import cast_columns
from millrace.operators import aggregate, joins, project
from millrace.plans import export, load
from millrace.plans.warehouse import Warehouse
from millrace.sources import files
from tests.conftest import plan, rows

SERIES = "datetime_utc timestamp, value double, parameter string"
RAW = "datetime_utc string, value string, parameter string, extra string"
CASTS = {"datetime_utc": "TIMESTAMP", "value": "DOUBLE"}


def raw(spark, *values):
    return spark.createDataFrame([(d, v, "pm25", "noise") for d, v in values], RAW)


@pytest.fixture
def loaded(spark, wh):
    base = spark.createDataFrame([("2025-08-19 00:00:00", "20.4")], "datetime_utc string, value string")
    load.load(wh, "aq", cast_columns(base, CASTS).withColumn("parameter", F.lit("pm25")))
    return wh


def counters(batch):
    return {k: batch.counters[k] for k in ("inserted", "skipped_null_key", "skipped_dup")}


def test_increment_skips_null_invalid_and_known_keys(spark, loaded):
    stage = raw(spark, (None, "10"), ("2025-08-20 02:00:00+02:00", "21"), ("INVALID", "30"), ("2025-08-19 00:00:00", "99.9"),
                ("2025-08-19 02:00:00+02:00", "1"), ("2025-08-21", "BAD"))
    batch = load.load(loaded, "aq", stage, "incremental", keys=["datetime_utc"], cast_map=CASTS)
    assert counters(batch) == {"inserted": 2, "skipped_null_key": 2, "skipped_dup": 2}
    got = loaded.table("aq").select(F.date_format("datetime_utc", "dd HH"), "value", "parameter")
    assert rows(got) == [("19 00", 20.4, "pm25"), ("20 00", 21.0, "pm25"), ("21 00", None, "pm25")]
    assert loaded.table("aq").columns == ["datetime_utc", "value", "parameter"]


def test_increment_twice_inserts_nothing(spark, loaded):
    stage = raw(spark, ("2025-08-20", "1"), ("2025-08-21", "2"), (None, "3"))
    for want in (2, 0):
        batch = load.load(loaded, "aq", stage, "incremental", keys=["datetime_utc"], cast_map=CASTS)
        assert batch.counters["inserted"] == want
        assert sum(counters(batch).values()) == 3
    assert loaded.table("aq").count() == 3


def test_increment_keeps_copies_within_a_batch_unless_asked(spark, wh):
    stage = raw(spark, ("2025-08-20", "1"), ("2025-08-20", "2"))
    load.load(wh, "a", stage, "incremental", keys=["datetime_utc"], cast_map=CASTS)
    load.load(wh, "b", stage, "incremental", keys=["datetime_utc"], cast_map=CASTS, dedupe_batch=True, order_by=["value desc"])
    assert wh.table("a").count() == 2 and wh.table("a").columns[-1] == "extra"
    assert rows(wh.table("b").select("value")) == [(2.0,)]


def test_increment_errors(spark, loaded):
    with pytest.raises(ValueError):
        load.load(loaded, "aq", raw(spark, ("2025-08-20", "1")), "incremental")
    with pytest.raises(ValueError):
        load.load(loaded, "aq", raw(spark, ("2025-08-20", "1")), "incremental", keys=["zz"])
    with pytest.raises(ValueError):
        load.load(loaded, "aq", raw(spark, ("2025-08-20", "1")).drop("parameter"), "incremental", keys=["datetime_utc"], cast_map=CASTS)


def test_increment_composite_key_with_bad_year(spark, wh):
    base = spark.createDataFrame([("ES", 2020, 1.0, "a")], "country string, year int, value double, sector string")
    load.load(wh, "u", base)
    stage = spark.createDataFrame(
        [("ES", "2020", "5", "a"), ("ES", "2021", "BAD", "b"), ("FR", "XXXX", "6", "c"), (None, "2020", "7", "d"), ("FR", "2020", "8", "e")],
        "country string, year string, value string, sector string",
    )
    batch = load.load(wh, "u", stage, "incremental", keys=["country", "year"], cast_map={"year": "INTEGER", "value": "DOUBLE"})
    assert counters(batch) == {"inserted": 2, "skipped_null_key": 2, "skipped_dup": 1}
    assert rows(wh.table("u")) == [("ES", 2020, 1.0, "a"), ("ES", 2021, None, "b"), ("FR", 2020, 8.0, "e")]


@pytest.mark.parametrize("small", [True, False])
def test_increment_same_result_small_and_large(spark, wh, monkeypatch, small):
    monkeypatch.setattr(joins, "BROADCAST_KEY_BYTES", 10**9 if small else -1)
    n = 5000
    load.load(wh, "t", spark.range(0, n, 2).withColumn("s", F.sha2(F.col("id").cast("string"), 256)))
    stage = spark.range(0, n).select(
        F.when(F.col("id") % 100 == 0, None).when(F.col("id") % 200 == 1, F.lit("INVALID")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("new").alias("s"),
    ).unionByName(spark.range(0, n, 20).select(F.col("id").cast("string").alias("id"), F.lit("copy").alias("s")))
    batch = load.load(wh, "t", stage, "incremental", keys=["id"], cast_map={"id": "BIGINT"})
    brute = {int(i) for i in range(n) if i % 100 and i % 200 != 1 and i % 2}
    assert batch.counters["inserted"] == len(brute)
    assert batch.counters["skipped_null_key"] == n // 100 + n // 200
    assert sum(counters(batch).values()) == n + n // 20
    assert wh.table("t").count() == n // 2 + len(brute)


def test_large_batch_past_the_table_is_not_joined(spark, wh, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_KEY_BYTES", -1)
    joined = []
    monkeypatch.setattr(load, "anti_join", lambda *a: joined.append(1) or joins.anti_join(*a))
    load.load(wh, "t", spark.range(100))
    assert load.load(wh, "t", spark.range(100, 300), "incremental", keys=["id"]).rows == 200 and not joined
    assert load.load(wh, "t", spark.range(250, 400), "incremental", keys=["id"]).rows == 100 and joined
    assert wh.table("t").distinct().count() == wh.table("t").count() == 400


def test_key_range_prunes_the_table_scan(spark, loaded):
    bounds = {"_lo0": 5, "_hi0": 9}
    load.load(loaded, "n", spark.range(100))
    text = plan(joins.within_range(loaded.table("n"), ["id"], bounds))
    assert "GreaterThanOrEqual(id,5)" in text and "LessThanOrEqual(id,9)" in text


def test_anti_join_plans(spark):
    a, b = spark.range(10).withColumn("v", F.lit(1)), spark.range(5)
    df = joins.anti_join(a, b, ["id"])
    assert "LeftAnti" in plan(df) and rows(df.select("id")) == [(i,) for i in range(5, 10)]
    nulls = spark.createDataFrame([(None,), (1,)], "id bigint")
    assert rows(joins.anti_join(nulls, nulls, ["id"])) == [(None,)]


def test_hot_keys_are_split_and_combined(spark):
    """A third of all rows on one key, on both sides: the row side is split, the key side combined first."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        left = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        right = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, -9).otherwise(F.col("id") * 2).alias("k"))
        df = joins.anti_join(left, right, ["k"])
        got = len(df.collect())
        assert "SortMergeJoin(skew=true)" in plan(df) and "AQEShuffleRead skewed" in plan(df)
        known = {i * 2 for i in range(n) if i % 3}
        assert got == n // 3 + sum(1 for i in range(n) if i % 3 and i not in known)
        changes = spark.range(50_000).select((F.col("id") * 3 + 1).alias("k"), F.lit("new").alias("v"))
        merged = joins.merge_rows(left, changes, ["k"])
        out = merged.collect()
        assert "SortMergeJoin(skew=true)" in plan(merged)
        inside = sum(1 for i in range(50_000) if i * 3 + 1 < n)
        assert len(out) == n + 50_000 - inside and sum(r["v"] == "new" for r in out) == 50_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_replace_reads_its_own_table(spark, wh):
    load.load(wh, "t", spark.range(10))
    load.load(wh, "t", wh.table("t").filter("id < 4"))
    assert wh.table("t").count() == 4
    assert load.load(wh, "t", spark.range(0)).rows == 0 and wh.table("t").count() == 4
    assert wh.vacuum("t") == 1 and wh.table("t").count() == 4


def test_append_aligns_by_name_and_creates(spark, wh):
    load.load(wh, "t", spark.createDataFrame([(1, "a")], "a int, b string"), "append")
    load.load(wh, "t", spark.createDataFrame([("b", 9, 2)], "b string, x int, a int"), "append")
    assert rows(wh.table("t")) == [(1, "a"), (2, "b")] and wh.table("t").columns == ["a", "b"]
    with pytest.raises(ValueError):
        load.load(wh, "t", spark.createDataFrame([(1,)], "a int"), "append")
    assert wh.compact("t").rows == 2 and rows(wh.table("t")) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("small", [True, False])
def test_upsert(spark, wh, monkeypatch, small):
    monkeypatch.setattr(joins, "BROADCAST_KEY_BYTES", 10**9 if small else -1)
    load.load(wh, "t", spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0), (2, "bb", 2.5)], "k int, s string, v double"))
    changes = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, s string")
    for _ in range(2):
        batch = load.load(wh, "t", changes.filter("k is not null") if _ else changes, "upsert", keys=["k"])
    assert batch.counters["rows_batch"] == 2
    assert rows(wh.table("t")) == [(1, "a", 1.0), (2, "B", 2.0), (2, "B", 2.5), (3, "C", None), (None, "N", None), (None, "n", 0.0)]


def test_upsert_corner_cases(spark, wh):
    t = spark.createDataFrame([(1, "a")], "k int, s string")
    load.load(wh, "t", t, "upsert", keys=["k"])
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, s string")
    with pytest.raises(ValueError, match="more than once"):
        load.load(wh, "t", twice, "upsert", keys=["k"])
    load.load(wh, "t", twice, "upsert", keys=["k"], order_by=["s desc"])
    assert rows(wh.table("t")) == [(1, "y")]
    with pytest.raises(ValueError):
        load.load(wh, "t", t, "upsert", keys=["zz"])
    load.load(wh, "t", twice, "upsert")  # no keys: replace
    assert wh.table("t").count() == 2
    load.load(wh, "k", spark.createDataFrame([(1,)], "k int"))
    load.load(wh, "k", spark.createDataFrame([(1,), (2,)], "k int"), "upsert", keys=["k"])  # keys only
    assert rows(wh.table("k")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        load.load(wh, "t", t, "merge")


def test_unpublished_batch_is_invisible(spark, wh):
    load.load(wh, "t", spark.range(3))
    batch = load.prepare(wh, "t", spark.range(5), "append")
    assert batch.rows == 5 and wh.table("t").count() == 3
    wh.discard(batch)
    newer = load.prepare(wh, "t", spark.range(7), "replace")
    assert wh.table("t").count() == 3
    wh.publish(newer)
    assert wh.table("t").count() == 7 and wh.tables() == ["t"]


def noisy_series(spark, n):
    """Hourly series with 5 % copies, 1 % NULL and 0.5 % invalid keys, 0.5 % "NaN" values."""
    base = spark.range(n).select(
        F.col("id"), F.date_format(F.timestamp_seconds(F.lit(1_672_531_200) + F.col("id") * 3600), "yyyy-MM-dd HH:mm:ss").alias("d")
    )
    dup = base.unionByName(base.filter("id % 20 = 7"))
    return dup.select(
        F.when(F.col("id") % 100 == 0, None).when(F.col("id") % 200 == 1, F.lit("INVALID")).otherwise(F.col("d")).alias("datetime_utc"),
        F.when(F.col("id") % 200 == 3, F.lit("NaN")).otherwise((F.col("id") % 150).cast("string")).alias("value"),
        F.lit("pm25").alias("parameter"), F.lit("x").alias("noise"),
    )


def test_stress_increment_export_reconcile(spark, wh, tmp_path):
    n = 20_000
    load.load(wh, "aq", cast_columns(noisy_series(spark, 100).drop("noise"), CASTS).filter("datetime_utc is not null"))
    batch = load.load(wh, "aq", noisy_series(spark, n), "incremental", keys=["datetime_utc"], cast_map=CASTS)
    assert sum(counters(batch).values()) == n + n // 20
    sql = "SELECT *, year(datetime_utc) AS year, lpad(CAST(month(datetime_utc) AS VARCHAR), 2, '0') AS month FROM aq"
    path = export.export_query(wh, sql, str(tmp_path / "out"), ["year", "month"])
    back = files.read_parquet_tree(spark, path, "year int, month string")
    assert aggregate.partition_counts(back, ["year", "month"]).agg(F.sum("filas")).first()[0] == wh.table("aq").count()
    assert rows(aggregate.reconcile({"aq": wh.table("aq")}, {"aq": back}).select("difference")) == [(0,), (0,)]
    # "NaN" is a value in the table, as the cast says, not a missing one.
    assert wh.table("aq").filter(F.isnan("value")).count() > 0


def test_export_modes(spark, wh, tmp_path):
    load.load(wh, "t", spark.range(10).withColumn("p", F.col("id") % 2))
    out = str(tmp_path / "e")
    config = {"groups": {"g": [{"name": "a", "table": "t", "export_parquet": {"dir": out, "partition_by": ["p"]}}, {"name": "b", "table": "x"}]}}
    for _ in range(2):
        assert export.export_all(wh, config) == {"t": out}
    assert spark.read.parquet(out).count() == 10
    with pytest.raises(Exception):
        export.export_table(wh, "t", {"dir": out, "overwrite": False})
    assert export.export_table(wh, "t", {}) is None
    csv = export.export_csv(wh.table("t"), str(tmp_path / "c"))
    assert files.read_csv(spark, csv).count() == 10


def test_hot_export_partition_is_split(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 60_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("one").alias("p"))
        export.export_frame(df, str(tmp_path / "h"), ["p"])
        files_written = list((tmp_path / "h" / "p=one").glob("*.parquet"))
        assert len(files_written) > 4 and spark.read.parquet(str(tmp_path / "h")).count() == 60_000
    finally:
        spark.conf.set(*next(iter({k: old for k in conf}.items())))


def test_not_exists_is_an_anti_join(spark):
    spark.range(5).createOrReplaceTempView("ne_a")
    spark.range(3).createOrReplaceTempView("ne_b")
    assert "LeftAnti" in plan(spark.sql("SELECT * FROM ne_a a WHERE NOT EXISTS (SELECT 1 FROM ne_b b WHERE b.id = a.id)"))


def test_merge_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    c = spark.createDataFrame([(2, "B"), (3, "C")], "k int, s string")
    once = joins.merge_rows(t, c, ["k"])
    assert rows(joins.merge_rows(once, c, ["k"])) == rows(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert project.dedupe(once, ["k"]).count() == 3


def test_upsert_rewrites_only_the_batches_it_touches(spark, wh):
    for start in (0, 100, 200):
        load.load(wh, "t", spark.range(start, start + 100).withColumn("v", F.lit("old")).coalesce(1), "append")
    first, second, third = wh.batches("t")
    changes = spark.createDataFrame([(150, "new"), (151, "new"), (999, "new")], "id bigint, v string")
    batch = load.load(wh, "t", changes, "upsert", keys=["id"])
    assert list(batch.replaces) == [second] and batch.rows == 101
    assert wh.batches("t")[:2] == [first, third]
    assert wh.table("t").count() == 301 and wh.table("t").filter("v = 'new'").count() == 3
    only_new = load.load(wh, "t", spark.createDataFrame([(2000, "x")], "id bigint, v string"), "upsert", keys=["id"])
    assert only_new.rows == 1 and not only_new.replaces
    assert wh.vacuum("t") == 1 and wh.table("t").count() == 302
    load.load(wh, "t", wh.table("t"), "replace")
    assert len(wh.batches("t")) == 1 and wh.vacuum("t") == 4 and wh.table("t").count() == 302


def test_rewritten_batch_is_still_recognised(spark, wh):
    wh.publish(wh.write("t", spark.range(3), tag="s0"))
    wh.compact("t")
    assert wh.has_batch("t", "s0") and not wh.has_batch("t", "s1") and wh.table("t").count() == 3


KEYS = st.one_of(st.none(), st.integers(0, 6).map(str), st.just("BAD"), st.just(" 3 "), st.just("2.5"))
BATCHES = st.lists(st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=8), min_size=1, max_size=3)


def typed_key(text):
    return {None: None, "BAD": None, " 3 ": 3, "2.5": 3}.get(text, int(text) if text and text.isdigit() else None)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(BATCHES)
def test_increments_agree_with_brute_force(spark, tmp_path_factory, batches):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("inc")))
    want: list = []
    for batch in batches:
        df = spark.createDataFrame(batch, "k string, v int")
        got = load.load(wh, "t", df, "incremental", keys=["k"], cast_map={"k": "BIGINT"})
        known = {k for k, _ in want}
        fresh = [(typed_key(k), v) for k, v in batch if typed_key(k) is not None and typed_key(k) not in known]
        nulls = sum(typed_key(k) is None for k, _ in batch)
        assert counters(got) == {"inserted": len(fresh), "skipped_null_key": nulls, "skipped_dup": len(batch) - nulls - len(fresh)}
        want += fresh
    assert rows(wh.table("t")) == sorted(want, key=lambda r: [(False, str(v)) for v in r])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.integers(0, 8), st.integers(0, 9), max_size=6), min_size=1, max_size=3))
def test_upserts_agree_with_brute_force(spark, tmp_path_factory, batches):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("ups")))
    want: dict = {}
    for batch in batches:
        load.load(wh, "t", spark.createDataFrame(list(batch.items()), "k int, v int"), "upsert", keys=["k"])
        want |= batch
    assert rows(wh.table("t")) == rows(spark.createDataFrame(list(want.items()), "k int, v int"))
