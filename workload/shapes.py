"""Queries over nested payload shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import shaping
from millrace.session import scratch_dir
from millrace.sources.registry import get_transform
from workload import AS_OF, query, table, ts_text
from workload.scans import PAGE_ROWS


@query("hourly_arrays_to_rows", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS datetime_utc, round(sum(value), 2) AS value,
       'pm25' AS parameter, 'µg/m³' AS unit, CAST(40.4168 AS DOUBLE) AS latitude, CAST(-3.7038 AS DOUBLE) AS longitude
FROM events GROUP BY date_trunc('hour', ts)
""")
def hourly_arrays_to_rows(spark, sf):
    """One document per day with parallel hour and value lists, back to rows."""
    hours = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.round(F.sum("value"), 2).alias("v")
    )
    # At most 24 elements per document.
    days = hours.groupBy(F.to_date("hour").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct(F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("t"), "v"))).alias("h")
    )
    docs = days.select(F.struct(F.col("h.t").alias("time"), F.col("h.v").alias("pm2_5")).alias("hourly"))
    path = f"{scratch_dir(spark, 'hourly')}/docs"
    docs.write.json(path)
    landed = spark.read.schema("hourly struct<time: array<string>, pm2_5: array<double>>").json(path)
    args = {"parameter": "pm25", "unit": "µg/m³", "latitude": 40.4168, "longitude": -3.7038}
    rows = get_transform("hourly_time_value")(landed, args)
    return rows.withColumn("datetime_utc", F.date_format("datetime_utc", "yyyy-MM-dd HH:mm:ss"))


@query("features_to_rows", """
SELECT strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f') AS datetime_utc,
       value AS magnitude,
       CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE value / 2 END AS depth_km,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS latitude,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) END AS longitude,
       'near ' || CAST(user_id AS VARCHAR) AS place, 'ev' || CAST(event_id AS VARCHAR) AS event_id,
       event_type AS type, 'reviewed' AS status
FROM events
""")
def features_to_rows(spark, sf):
    """Feature collections; some features lack a geometry or a depth."""
    e = table(spark, sf, "events")
    lon, lat, depth = F.col("event_id").cast("double"), F.col("user_id").cast("double"), F.col("value") / 2
    coords = F.when(F.col("event_id") % 5 == 1, F.array(lon, lat)).when(F.col("event_id") % 5 > 1, F.array(lon, lat, depth))
    feature = F.struct(
        F.concat(F.lit("ev"), "event_id").alias("id"),
        F.struct(
            F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
            F.col("value").alias("mag"),
            F.concat(F.lit("near "), "user_id").alias("place"),
            F.col("event_type").alias("type"),
            F.lit("reviewed").alias("status"),
        ).alias("properties"),
        F.when(coords.isNotNull(), F.struct(coords.alias("coordinates"))).alias("geometry"),
    )
    docs = e.groupBy(F.floor(F.col("event_id") / PAGE_ROWS).alias("page")).agg(F.collect_list(feature).alias("features"))
    path = f"{scratch_dir(spark, 'features')}/docs"
    docs.select("features").write.json(path)
    landed = spark.read.schema(
        "features array<struct<id: string, properties: struct<time: bigint, mag: double, place: string, "
        "type: string, status: string>, geometry: struct<coordinates: array<double>>>>"
    ).json(path)
    rows = get_transform("usgs_features")(landed, {})
    return rows.withColumn("datetime_utc", ts_text("datetime_utc"))


def _nested_customers(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    region = F.struct(F.col("n_regionkey").alias("key"), F.struct(F.col("n_nationkey").alias("code")).alias("inner"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey",
        F.struct(F.col("n_name").alias("name"), region.alias("region")).alias("nation"),
        F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("properties"),
    )


@query("flatten_nested", """
SELECT c_custkey, n_name AS "nation.name", n_regionkey AS "nation.region.key",
       n_nationkey AS "nation.region.inner.code", c_name AS "properties.name", c_acctbal AS "properties.balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def flatten_nested(spark, sf):
    """Every nested field becomes a column."""
    return shaping.flatten(_nested_customers(spark, sf))


@query("flatten_depth2", """
SELECT c_custkey, n_name AS "nation_name", n_regionkey AS "nation_region_key",
       '{"code":' || CAST(n_nationkey AS VARCHAR) || '}' AS "nation_region_inner", c_name AS "properties_name",
       c_acctbal AS "properties_balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def flatten_depth2(spark, sf):
    """Two levels below the root, another separator; the deeper object stays one value."""
    flat = shaping.flatten(_nested_customers(spark, sf), sep="_", max_level=2)
    return flat.withColumn("nation_region_inner", F.to_json("nation_region_inner"))


@query("explode_records_path", """
SELECT o_orderkey, o_totalprice, o_orderpriority AS "detail.priority", o_custkey AS "detail.customer" FROM orders
""")
def explode_records_path(spark, sf):
    """A nested record list to flat rows, one job from documents to columns."""
    record = F.struct(
        "o_orderkey", "o_totalprice",
        F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("customer")).alias("detail"),
    )
    docs = table(spark, sf, "orders").groupBy(F.floor(F.col("o_orderkey") / PAGE_ROWS).alias("page")).agg(
        F.collect_list(record).alias("rows")
    )
    return shaping.explode_path(docs.select(F.struct("rows").alias("payload")), "payload.rows")


@query("explode_properties", "SELECT c_name AS name, c_acctbal AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey")
def explode_properties(spark, sf):
    """Only one nested object of each record stays."""
    return shaping.keep_nested(_nested_customers(spark, sf), "properties")


@query("nested_snapshot", """
SELECT source || '/' || CAST(d.doc_id AS VARCHAR) AS full_name, text AS description,
       CASE WHEN toxic = 1 THEN 'private' ELSE 'public' END AS visibility, quality = 1 AS fork, CAST(NULL AS BOOLEAN) AS archived,
       CAST(NULL AS BOOLEAN) AS disabled, lang AS language,
       CASE WHEN quality IS NULL THEN NULL ELSE 'L' || CAST(quality AS VARCHAR) END AS license,
       lang || ',' || source AS topics, 'main' AS default_branch, n_chars AS stars, CAST(quality AS BIGINT) AS forks,
       CAST(toxic AS BIGINT) AS open_issues, CAST(NULL AS BIGINT) AS watchers, n_chars AS size_kb,
       CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS pushed_at, CAST(NULL AS VARCHAR) AS updated_at,
       source AS owner, CAST(d.doc_id AS VARCHAR) AS repo, '2024-01-31T00:00:00+00:00' AS snapshot_utc
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def nested_snapshot(spark, sf):
    """Nested licence and owner, a topic list, absent fields."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    records = d.join(l, "doc_id", "left").select(
        F.concat("source", F.lit("/"), "doc_id").alias("full_name"),
        F.col("text").alias("description"),
        F.when(F.col("toxic") == 1, "private").otherwise("public").alias("visibility"),
        (F.col("quality") == 1).alias("fork"),
        F.col("lang").alias("language"),
        F.when(F.col("quality").isNotNull(), F.struct(F.concat(F.lit("L"), "quality").alias("spdx_id"))).alias("license"),
        F.array("lang", "source").alias("topics"),
        F.lit("main").alias("default_branch"),
        F.col("n_chars").alias("stargazers_count"),
        F.col("quality").alias("forks_count"),
        F.col("toxic").alias("open_issues_count"),
        F.col("n_chars").alias("size"),
        F.struct(F.col("source").alias("login")).alias("owner"),
        F.col("doc_id").cast("string").alias("name"),
    )
    return shaping.repository_snapshot(records, AS_OF)


@query("epoch_weeks", """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS week_start_utc, count(*) AS total_commits
FROM events GROUP BY 1
""")
def epoch_weeks(spark, sf):
    """Epoch seconds to ISO text, sorted by week."""
    weeks = table(spark, sf, "events").groupBy(
        F.unix_timestamp(F.date_trunc("week", F.col("ts").cast("timestamp"))).alias("week")
    ).agg(F.count("*").alias("total"))
    return shaping.weekly_activity(weeks)
