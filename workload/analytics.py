"""Queries over aggregation, top-k and automatic summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators import aggregate, analytics
from millrace.sources import storage
from workload import AS_OF, query, table


@query("topk_sum", "SELECT l_partkey AS key, sum(l_quantity) AS total FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def topk_sum(spark, sf):
    """A2, O1: the groups with the largest sums."""
    return aggregate.top_groups(aggregate.totals(table(spark, sf, "lineitem"), "l_partkey", "l_quantity"), 10)


@query("topk_count", """
SELECT k AS key, count(*) AS total FROM (SELECT CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS k FROM events)
GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10
""")
def topk_count(spark, sf):
    """A3, O1: the groups with the most rows; NULL is a group."""
    e = table(spark, sf, "events").select(F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("k"))
    return aggregate.top_groups(aggregate.totals(e, "k"), 10)


@query("topn_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 25
""")
def topn_rows(spark, sf):
    """O2: the rows with the largest value."""
    top = aggregate.top_rows(table(spark, sf, "lineitem"), "l_extendedprice", 25, ["l_orderkey", "l_linenumber", "l_partkey"])
    return top.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("recent_rows", """
SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY ORDER BY ts DESC LIMIT 100
""")
def recent_rows(spark, sf):
    """The latest rows of a period."""
    recent = times.last_days(table(spark, sf, "events"), "ts", AS_OF, 7)
    return aggregate.top_rows(recent, "ts", 100, ["event_id"]).select("event_id", "event_type", "value")


@query("row_counts", """
SELECT count(*) AS filas FROM events WHERE date_trunc('month', ts) = date_trunc('month', TIMESTAMP '2024-01-31')
""")
def row_counts(spark, sf):
    """Rows of the month."""
    return aggregate.count_rows(times.same_month(table(spark, sf, "events"), "ts", AS_OF))


@query("ordered_nulls_last", """
SELECT row_number() OVER (ORDER BY seen DESC NULLS LAST, event_id DESC) AS position, event_id
FROM (SELECT CASE WHEN event_id % 10 <> 9 THEN ts END AS seen, event_id FROM events)
""")
def ordered_nulls_last(spark, sf):
    """O3: explicit NULL placement with a second key."""
    e = table(spark, sf, "events").select(F.when(F.col("event_id") % 10 != 9, F.col("ts")).alias("seen"), "event_id")
    return aggregate.positions(e, F.col("seen").desc_nulls_last(), F.col("event_id").desc()).select("position", "event_id")


@query("auto_axes_topk", """
SELECT o_orderstatus AS key, CAST(sum(o_orderkey) AS DOUBLE) AS total FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def auto_axes_topk(spark, sf):
    """B1, B2: axes from the schema, then the top groups."""
    return analytics.summarize(table(spark, sf, "orders"), 10).withColumn("total", F.col("total").cast("double"))


@query("auto_summary_all", """
SELECT * FROM (SELECT 'orders' AS table_name, CAST(o_orderstatus AS VARCHAR) AS key, CAST(sum(o_orderkey) AS DOUBLE) AS total FROM orders GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'events', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), CAST(sum(event_id) AS DOUBLE) FROM events GROUP BY ts ORDER BY 3 DESC, ts LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'customer', c_name, CAST(sum(c_custkey) AS DOUBLE) FROM customer GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'part', p_name, CAST(sum(p_partkey) AS DOUBLE) FROM part GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'lineitem', l_returnflag, CAST(sum(l_orderkey) AS DOUBLE) FROM lineitem GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'labels', CAST(doc_id AS VARCHAR), CAST(sum(quality) AS DOUBLE) FROM labels GROUP BY doc_id ORDER BY 3 DESC, doc_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'benchmark', text, CAST(sum(item_id) AS DOUBLE) FROM benchmark GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'documents', text, CAST(sum(doc_id) AS DOUBLE) FROM documents GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'region', r_name, CAST(sum(r_regionkey) AS DOUBLE) FROM region GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'nation', n_name, CAST(sum(n_nationkey) AS DOUBLE) FROM nation GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'supplier', s_name, CAST(sum(s_suppkey) AS DOUBLE) FROM supplier GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'pages', url, CAST(sum(page_id) AS DOUBLE) FROM pages GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'conversations', role, CAST(sum(conv_id) AS DOUBLE) FROM conversations GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'embeddings', array_to_string(list_transform(embedding, lambda x: CAST(round(x * 1000.0::DOUBLE) AS BIGINT)), ','), total
    FROM (SELECT embedding, CAST(sum(vec_id) AS DOUBLE) AS total FROM embeddings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10))
""")
def auto_summary_all(spark, sf):
    """A summary of every table of the folder that has rows and two columns.

    Array keys are shown as their numbers in thousandths.
    """
    names = [f.removesuffix(".parquet") for f in storage.glob_sizes(spark, f"{sf}/*.parquet")]
    tables = {name: table(spark, sf, name) for name in names}
    tables["single_column"] = tables["customer"].select("c_name")
    tables["no_rows"] = tables["customer"].filter("c_custkey IS NULL")
    parts = analytics.summarize_all(tables, 10)

    def key_text(df):
        if df.schema["key"].dataType.typeName() == "array":
            return F.array_join(F.transform("key", lambda x: F.round(x * F.lit(1000.0)).cast("bigint").cast("string")), ",")
        is_time = df.schema["key"].dataType.typeName().startswith("timestamp")
        return F.date_format("key", "yyyy-MM-dd HH:mm:ss.SSSSSS") if is_time else F.col("key").cast("string")

    return aggregate.union_all(*[
        df.select(F.lit(name).alias("table_name"), key_text(df).alias("key"), F.col("total").cast("double").alias("total"))
        for name, df in parts.items()
    ])


@query("series_prep", """
SELECT 'dated' AS series, strftime(date_trunc('day', ts), '%Y-%m-%d') AS x, round(sum(value), 2) AS y FROM events GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'ranked', l_returnflag || l_linestatus, round(sum(l_quantity), 2) FROM lineitem GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
""")
def series_prep(spark, sf):
    """Text that mostly parses as dates gives a series, other keys the top rows."""
    day = F.date_format("ts", "yyyy-MM-dd")
    days = table(spark, sf, "events").groupBy(day.alias("x")).agg(F.round(F.sum("value"), 2).alias("y"))
    odd = days.select(F.lit("not a date").alias("x"), F.lit(None).cast("double").alias("y")).distinct()
    flags = table(spark, sf, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("x")).agg(
        F.round(F.sum("l_quantity"), 2).alias("y")
    )
    dated = analytics.series(days.unionByName(odd))
    ranked = analytics.series(flags, 10)
    return dated.select(F.lit("dated").alias("series"), F.date_format("x", "yyyy-MM-dd").alias("x"), "y").unionByName(
        ranked.select(F.lit("ranked").alias("series"), "x", "y")
    )
