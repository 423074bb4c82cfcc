"""Queries over projection, filters, casts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import casts, text, times
from millrace.operators import aggregate, project
from workload import AS_OF, SQL_NOISY_EVENTS, noisy_events, query, table, ts_text


@query("select_rename_derive_filter", """
SELECT okey, CAST(linenumber AS INTEGER) AS linenumber, price * (1 - disc) AS net, price * (1 - disc) * (1 + l_tax) AS gross
FROM (SELECT l_orderkey AS okey, l_linenumber AS linenumber, l_extendedprice AS price, l_discount AS disc, l_tax FROM lineitem)
WHERE price * (1 - disc) >= 50000 AND disc < 0.05
""")
def select_rename_derive_filter(spark, sf):
    """The fixed-order chain as one plan."""
    params = {
        "select": ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"],
        "rename": {"l_orderkey": "okey", "l_linenumber": "linenumber", "l_extendedprice": "price", "l_discount": "disc", "zz": "q"},
        "derive": ["net = price * (1 - disc)", "gross = net * (1 + l_tax)"],
        "select_final": ["okey", "linenumber", "net", "gross", "disc"],
        "filter": ["net >= 50000", "disc < 0.05"],
    }
    return project.transform(table(spark, sf, "lineitem"), params).drop("disc")


@query("select_lenient_enrich", """
SELECT event_id, value AS reading, lower(event_type) AS code, 'events' AS origin, CAST(1 AS INTEGER) AS version,
       CASE user_id % 4 WHEN 0 THEN 'pm2_5' WHEN 1 THEN 'nitrogen_dioxide' WHEN 2 THEN 'ozone' ELSE 'other' END AS field
FROM events
""")
def select_lenient_enrich(spark, sf):
    """Missing columns ignored, constants added, codes mapped."""
    e = table(spark, sf, "events")
    short = F.element_at(F.array(F.lit("PM25"), F.lit("no2"), F.lit("O3"), F.lit("Other")), (F.col("user_id") % 4 + 1).cast("int"))
    df = project.select_lenient(e.withColumn("p", short), ["event_id", "nothing", "value", "event_type", "p"])
    df = project.rename(df, {"value": "reading", "event_type": "code", "p": "field"})
    df = df.withColumns({"code": text.map_code(F.col("code")), "field": text.map_code(F.col("field"))})
    return project.enrich(df, {"origin": "events", "version": 1})


@query("cast_replace", f"""
WITH {SQL_NOISY_EVENTS}
SELECT TRY_CAST(id_raw AS BIGINT) AS id_raw, strftime(TRY_CAST(ts_raw AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS ts_raw,
       TRY_CAST(value_raw AS INTEGER) AS value_int,
       CASE WHEN isnan(TRY_CAST(value_raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(value_raw AS DOUBLE) END AS value_raw,
       isnan(TRY_CAST(value_raw AS DOUBLE)) AS value_is_nan, TRY_CAST(value AS INTEGER) AS value
FROM noisy
""")
def cast_replace(spark, sf):
    """TRY_CAST of some columns in place."""
    df = noisy_events(spark, sf).select("id_raw", "ts_raw", F.col("value_raw").alias("value_int"), "value_raw", "value")
    df = casts.cast_columns(df, {
        "id_raw": "BIGINT", "ts_raw": "TIMESTAMP", "value_int": "INTEGER", "value_raw": "DOUBLE", "value": "INTEGER",
    })
    return df.select(
        "id_raw", ts_text("ts_raw").alias("ts_raw"), "value_int",
        casts.nan_to_null(F.col("value_raw")).alias("value_raw"),
        F.when(F.col("value_raw").isNotNull(), F.isnan("value_raw")).alias("value_is_nan"), "value",
    )


@query("coerce_numeric", f"""
WITH {SQL_NOISY_EVENTS}
SELECT TRY_CAST(id_raw AS BIGINT) AS id_raw,
       CASE WHEN isnan(TRY_CAST(value_raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(value_raw AS DOUBLE) END AS as_float,
       CASE WHEN TRY_CAST(value_raw AS DOUBLE) = floor(TRY_CAST(value_raw AS DOUBLE)) AND NOT isnan(TRY_CAST(value_raw AS DOUBLE))
            THEN CAST(TRY_CAST(value_raw AS DOUBLE) AS BIGINT) END AS as_int,
       CAST(user_id AS VARCHAR) AS as_text
FROM noisy
WHERE id_raw IS NOT NULL AND id_raw <> 'INVALID'
""")
def coerce_numeric(spark, sf):
    """Coercion with bad text to NULL, then rows without a key dropped."""
    df = noisy_events(spark, sf).select(
        "id_raw", F.col("value_raw").alias("as_float"), F.col("value_raw").alias("as_int"), F.col("user_id").alias("as_text")
    )
    post = {"cast": {"id_raw": "int", "as_float": "float", "as_int": "int", "as_text": "str"}, "dropna_any": ["id_raw"]}
    return project.postprocess(df, post)


@query("cast_failures", f"""
WITH {SQL_NOISY_EVENTS}
SELECT count(*) FILTER (WHERE id_raw IS NOT NULL AND TRY_CAST(id_raw AS BIGINT) IS NULL) AS id_raw_cast_failed,
       count(*) FILTER (WHERE ts_raw IS NOT NULL AND TRY_CAST(ts_raw AS TIMESTAMP) IS NULL) AS ts_raw_cast_failed,
       count(*) FILTER (WHERE value_raw IN ('NaN', 'BAD')) AS value_raw_cast_failed
FROM noisy
""")
def cast_failures(spark, sf):
    """How many values each coercion loses, in one aggregation."""
    df = noisy_events(spark, sf)
    return df.agg(*casts.cast_failures(df, {"id_raw": "int", "ts_raw": "datetime", "value_raw": "float"}))


@query("coerce_datetime", f"""
WITH {SQL_NOISY_EVENTS}
SELECT event_id, strftime(TRY_CAST(ts_raw AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS ts_raw,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:00') END AS slashed
FROM noisy
""")
def coerce_datetime(spark, sf):
    """T5: each value on its own; slash dates are dates, a bare year is not."""
    slashed = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy")).otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm"))
    df = noisy_events(spark, sf).select("event_id", "ts_raw", slashed.alias("slashed"))
    df = project.transform(df, {"parse_dates": ["ts_raw", "slashed", "absent"]})
    return df.select("event_id", ts_text("ts_raw").alias("ts_raw"), F.date_format("slashed", "yyyy-MM-dd HH:mm:ss").alias("slashed"))


@query("coerce_declared_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS mixed, strftime(o_orderdate, '%Y-%m-%d') AS compact,
       o_orderkey % 4 = 3 AS other
FROM orders
""")
def coerce_declared_dates(spark, sf):
    """T5, T4: dates in declared formats, several to a column; other text is NULL, ISO dates too."""
    day, way = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 4
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(day, "yyyyMMdd").alias("compact"), F.when(way == 3, "2025-08-20").alias("iso"),
        F.when(way == 0, F.date_format(day, "MM/dd/yyyy")).when(way == 1, F.date_format(day, "dd MMM yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd hh:mm a")).alias("mixed"),
    )
    df = project.transform(df, {
        "parse_dates": {"mixed": ["MM/dd/yyyy", "dd MMM yyyy", "yyyy-MM-dd hh:mm a"]},
        "derive": ["was = iso IS NOT NULL"], "dtypes": {"iso": {"type": "datetime", "format": "yyyyMMdd"}},
    })
    df = casts.cast_columns(df, {"compact": {"type": "DATE", "format": "yyyyMMdd"}})
    return df.select(
        "o_orderkey", F.date_format("mixed", "yyyy-MM-dd HH:mm:ss").alias("mixed"), F.col("compact").cast("string").alias("compact"),
        (F.col("was") & F.col("iso").isNull()).alias("other"),
    )


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS mm, strftime(o_orderdate, '%Y') AS y_text,
       strftime(o_orderdate, '%m') AS m_text, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start
FROM orders
""")
def date_parts(spark, sf):
    """T7, T8, T9."""
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", times.year_of(d).alias("y"), F.month(d).alias("m"), times.month_padded(d).alias("mm"),
        F.date_format(d, "yyyy").alias("y_text"), F.date_format(d, "MM").alias("m_text"),
        F.date_format(F.date_trunc("month", d), "yyyy-MM-dd").alias("month_start"),
    )


@query("text_functions", """
SELECT c_custkey, lower(c_name) AS lowered, starts_with(c_name, 'Customer') AS is_customer,
       regexp_replace(lower(c_mktsegment || '_' || c_name), '[^a-z0-9_]+', '_', 'g') AS slug,
       'customer_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS normal
FROM customer
""")
def text_functions(spark, sf):
    """T10, P9 as column functions."""
    return table(spark, sf, "customer").select(
        "c_custkey", F.lower("c_name").alias("lowered"), F.startswith("c_name", F.lit("Customer")).alias("is_customer"),
        text.slug(F.col("c_mktsegment"), F.col("c_name")).alias("slug"),
        text.normal_text(F.concat(F.lit("#"), "c_name", F.lit("!"))).alias("normal"),
    )


@query("records_json", """
SELECT '{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       || '","o_orderstatus":"' || o_orderstatus || '","note":' || CASE WHEN o_orderstatus = 'F' THEN '"f"' ELSE 'null' END || '}' AS record
FROM orders
""")
def records_json(spark, sf):
    """Rows as JSON texts, times as text, NULL fields kept."""
    o = table(spark, sf, "orders")
    return text.json_records(
        o.select("o_orderkey", "o_orderdate", "o_orderstatus", F.when(F.col("o_orderstatus") == "F", "f").alias("note"))
    )


@query("dedupe_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice DESC, l_quantity) AS r FROM lineitem)
WHERE r = 1
""")
def dedupe_first(spark, sf):
    """The first row per key in a total order."""
    df = project.dedupe(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice desc", "l_quantity"],
    )
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("dedupe_null_keys", f"""
WITH {SQL_NOISY_EVENTS}
SELECT count(*) AS n, count(*) FILTER (WHERE k IS NULL) AS null_groups FROM (
  SELECT DISTINCT TRY_CAST(id_raw AS BIGINT) AS k, event_type FROM noisy)
""")
def dedupe_null_keys(spark, sf):
    """NULL keys form one group; no order, so only the groups are compared."""
    df = casts.cast_columns(noisy_events(spark, sf).select("id_raw", "event_type", "value"), {"id_raw": "BIGINT"})
    kept = aggregate.distinct_by(aggregate.union_all(df, df), ["id_raw", "event_type"])
    return kept.agg(F.count("*").alias("n"), F.count_if(F.col("id_raw").isNull()).alias("null_groups"))


@query("period_filters", """
SELECT 'month' AS period, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
WHERE date_trunc('month', ts) = date_trunc('month', TIMESTAMP '2024-01-31')
UNION ALL SELECT 'last_10_days', count(*), CAST(sum(event_id) AS BIGINT) FROM events
WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY
""")
def period_filters(spark, sf):
    """This month and the last days, as ranges that reach the scan."""
    e = table(spark, sf, "events")

    def summed(df, period):
        return df.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).select(F.lit(period).alias("period"), "n", "ids")

    return aggregate.union_all(
        summed(times.same_month(e, "ts", AS_OF), "month"), summed(times.last_days(e, "ts", AS_OF, 10), "last_10_days")
    )
