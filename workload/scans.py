"""Queries over scans and sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.text import normalize_columns
from millrace.functions.times import month_padded
from millrace.operators.aggregate import partition_counts
from millrace.operators.shaping import indicator_records
from millrace.plans.export import export_csv, export_frame
from millrace.session import scratch_dir
from millrace.sources import files, payload, storage, windows
from workload import AS_OF, query, table, ts_text

PAGE_ROWS = 50  # records per landed page


@query("csv_roundtrip_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip_scan(spark, sf):
    """Write a CSV snapshot, scan it with inferred types."""
    path = export_csv(table(spark, sf, "customer"), f"{scratch_dir(spark, 'csv')}/customer")
    back = files.read_csv(spark, path)
    return back.select(
        F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("int"), "c_acctbal", "c_mktsegment"
    )


@query("csv_multi_header_union", """
SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
UNION ALL SELECT c_custkey, NULL, c_acctbal, c_mktsegment FROM customer
""")
def csv_multi_header_union(spark, sf):
    """Files with swapped and missing columns, united by name."""
    root, c = scratch_dir(spark, "csv"), table(spark, sf, "customer")
    export_csv(c.select("c_custkey", "c_name", "c_acctbal"), f"{root}/a")
    export_csv(c.select("c_mktsegment", "c_acctbal", "c_custkey"), f"{root}/b")
    back = files.read_csv_files(spark, f"{root}/*", dtype={"c_custkey": "int", "c_acctbal": "float"})
    return back.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("csv_skip_lines", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_skip_lines(spark, sf):
    """Comment lines before the header of every file are skipped."""
    root = scratch_dir(spark, "csv")
    line = F.concat_ws(";", F.col("s_suppkey"), F.col("s_name"), F.col("s_acctbal"))
    # A bounded number of rows per file, the header lines first within each file.
    part = F.floor(F.col("s_suppkey") / 100_000).alias("part")
    body = table(spark, sf, "supplier").select(part, F.lit(2).alias("pos"), line.alias("value"))
    head = body.select("part").distinct().select(
        "part",
        F.posexplode(F.array(F.lit("# exported rows"), F.lit("s_suppkey;s_name;s_acctbal"))).alias("pos", "value"),
    )
    lines = head.unionByName(body).repartition("part").sortWithinPartitions("part", "pos")
    lines.select("part", "value").write.partitionBy("part").text(f"{root}/files")
    back = files.read_csv_files(
        spark, f"{root}/files/*", sep=";", skiprows=1, dtype={"s_suppkey": "int", "s_acctbal": "float"}
    )
    return back.select("s_suppkey", "s_name", "s_acctbal")


@query("csv_normalized_names", """
SELECT c_custkey AS cust_key_no, c_name AS customer_name, c_acctbal AS acct_bal FROM customer
""")
def csv_normalized_names(spark, sf):
    """Whole-file type inference and normalised column names."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust-Key (No)"), F.col("c_name").alias("Customer Name"), F.col("c_acctbal").alias("_Acct__Bal_")
    )
    path = export_csv(c, f"{scratch_dir(spark, 'csv')}/c")
    return files.read_csv_normalized(spark, path).withColumn("cust_key_no", F.col("cust_key_no").cast("bigint"))


def order_documents(spark, sf):
    """Orders as nested documents of a bounded number of records."""
    o = table(spark, sf, "orders")
    record = F.struct(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("priority")).alias("customer"),
        "o_totalprice",
    )
    return o.groupBy(F.floor(F.col("o_orderkey") / PAGE_ROWS).alias("page")).agg(F.collect_list(record).alias("items"))


@query("json_records_path", """
SELECT o_orderkey, o_custkey AS "customer.key", o_orderpriority AS "customer.priority", o_totalprice FROM orders
""")
def json_records_path(spark, sf):
    """Nested documents, records under a dotted path."""
    docs = order_documents(spark, sf).select("page", F.struct("items").alias("data"))
    path = f"{scratch_dir(spark, 'json')}/orders"
    docs.write.json(path)
    schema = (
        "page bigint, data struct<items: array<struct<o_orderkey: bigint, "
        "customer: struct<key: bigint, priority: string>, o_totalprice: double>>>"
    )
    return files.read_json(spark, path, "data.items", schema=schema, per_line=True)


def event_pages(spark, sf):
    """Events as JSON texts ``[meta, rows]``, one page per line."""
    e = table(spark, sf, "events")
    record = F.struct("event_id", "event_type", "value", ts_text("ts").alias("ts"), F.struct(F.col("user_id").alias("id")).alias("user"))
    pages = e.groupBy(F.floor(F.col("event_id") / PAGE_ROWS).alias("page")).agg(F.collect_list(record).alias("rows"))
    return pages.select(
        "page",
        F.format_string(
            "[%s,%s]", F.to_json(F.struct("page", F.size("rows").alias("total"))), F.to_json("rows")
        ).alias("value"),
    )


@query("payload_dig_records", """
SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id FROM events
""")
def payload_dig_records(spark, sf):
    """Undeclared payloads, records at index 1 of the root list."""
    path = f"{scratch_dir(spark, 'pages')}/events"
    event_pages(spark, sf).select("value").write.text(path)
    records = payload.explode_records(payload.read_payloads(spark, path, per_line=True), ["1"])
    df = payload.typed_records(
        records, "event_id bigint, event_type string, value double, ts string, user struct<id: bigint>"
    )
    return df.select("event_id", "event_type", "value", "ts", F.col("user.id").alias("user_id"))


@query("payload_autodetect", """
SELECT event_id % 4 AS shape, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1
""")
def payload_autodetect(spark, sf):
    """Records in the root list, under a known key, or the root itself as the record."""
    e = table(spark, sf, "events")
    one = F.to_json(F.struct("event_id"))
    shape = F.col("event_id") % 4
    text = (
        F.when(shape == 0, F.format_string("[%s]", one))
        .when(shape == 1, F.format_string('{"results": [%s], "items": 1}', one))
        .when(shape == 2, F.format_string('{"data": {}, "items": [%s]}', one))
        .otherwise(one)
    )
    path = f"{scratch_dir(spark, 'payloads')}/events"
    e.select(text.alias("value")).write.text(path)
    records = payload.explode_records(payload.read_payloads(spark, path, per_line=True))
    ids = payload.typed_records(records, "event_id bigint")
    return ids.groupBy((F.col("event_id") % 4).alias("shape")).agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )


@query("payload_inferred_shape", """
SELECT event_id, event_type, value, user_id AS "user.id", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
""")
def payload_inferred_shape(spark, sf):
    """The record shape found by an aggregation over the payloads, then flattened."""
    path = f"{scratch_dir(spark, 'pages')}/events"
    event_pages(spark, sf).select("value").write.text(path)
    df = payload.payload_frame(payload.read_payloads(spark, path, per_line=True), ["1"])
    return df.withColumn("value", F.col("value").cast("double"))


@query("paged_payload_union", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_totalprice AS value, o_orderpriority AS indicator_id,
       'Priority ' || o_orderpriority AS indicator,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS country_id,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS country
FROM orders
""")
def paged_payload_union(spark, sf):
    """Indicator pages ``[meta, rows]``; a page with null rows yields nothing."""
    o = table(spark, sf, "orders")
    country = F.struct(F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("C"), "o_custkey").alias("value"))
    record = F.struct(
        F.date_format("o_orderdate", "yyyy").alias("date"),
        F.col("o_totalprice").alias("value"),
        F.struct(F.col("o_orderpriority").alias("id"), F.concat(F.lit("Priority "), "o_orderpriority").alias("value")).alias("indicator"),
        F.when(F.col("o_custkey") % 7 != 0, country).alias("country"),
    )
    pages = o.groupBy(F.floor(F.col("o_orderkey") / PAGE_ROWS).alias("page")).agg(F.collect_list(record).alias("rows"))
    meta = F.to_json(F.struct("page"))
    texts = pages.select(F.format_string("[%s,%s]", meta, F.to_json("rows")).alias("value")).unionByName(
        pages.select(F.format_string("[%s,null]", meta).alias("value"))
    )
    path = f"{scratch_dir(spark, 'pages')}/indicators"
    texts.write.text(path)
    records = payload.explode_pages(payload.read_payloads(spark, path, per_line=True), ["1"])
    shape = "date string, value double, indicator struct<id: string, value: string>, country struct<id: string, value: string>"
    return indicator_records(payload.typed_records(records, shape))


@query("parquet_partition_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month,
       count(*) AS filas
FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY 1, 2
""")
def parquet_partition_counts(spark, sf):
    """Export by year and month, read the tree back, prune, count."""
    o = table(spark, sf, "orders").withColumns(
        {"year": F.year("o_orderdate"), "month": month_padded(F.col("o_orderdate"))}
    )
    path = export_frame(o, f"{scratch_dir(spark, 'export')}/orders", ["year", "month"])
    back = files.read_parquet_tree(spark, path, "year int, month string")
    return partition_counts(back.filter("year >= 1997"), ["year", "month"])


@query("table_preview", "SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100")
def table_preview(spark, sf):
    """The first rows of a table in a fixed order."""
    return files.preview(table(spark, sf, "part"), 100, [F.desc("p_retailprice"), F.asc("p_partkey")])


@query("relative_window_filter", """
SELECT event_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00' AND value >= 4.0
""")
def relative_window_filter(spark, sf):
    """``@now-7d`` to ``@now`` and a minimum magnitude, pushed to the scan."""
    block = {"starttime": "@now-7d", "endtime": "@now", "minmagnitude": 4.0}
    e = windows.window_filter(table(spark, sf, "events"), "ts", block, AS_OF, "value")
    return e.select("event_id", "event_type", "value")


@query("high_water_scan", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'
""")
def high_water_scan(spark, sf):
    """Only rows past the stored mark."""
    e = windows.past(table(spark, sf, "events"), "ts", "2024-01-20 12:00:00")
    return e.select("event_id", ts_text("ts").alias("ts"), "value")


@query("high_water_mark", r"""
SELECT regexp_replace(strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f'), '\.?0+$', '') AS since_value FROM events
""")
def high_water_mark(spark, sf):
    """The new mark as text, taken on the typed column."""
    return windows.high_water_mark(table(spark, sf, "events"), "ts")


@query("normalized_columns", 'SELECT event_id AS event_id, event_type AS event_type, value AS value_eur FROM events')
def normalized_columns(spark, sf):
    """Names to lower case with single underscores."""
    e = table(spark, sf, "events")
    return normalize_columns(
        e.select(F.col("event_id").alias("Event ID"), F.col("event_type").alias("EVENT--type"), F.col("value").alias("Value (EUR)"))
    )


@query("csv_quoted_text", "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def csv_quoted_text(spark, sf):
    """Quotes, separators and line breaks within values survive a CSV file."""
    path = f"{scratch_dir(spark, 'csv')}/quoted"
    schema = "doc_id bigint, text string, lang string"
    export_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    back = files.read_csv(spark, path, schema=schema, multi_line=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("csv_multiline_split", """
SELECT doc_id, md5(text) AS text_md5, lang, length(text) AS n_chars FROM documents
""")
def csv_multiline_split(spark, sf):
    """Texts with line breaks and quotes as CSV, read back from files that are split within their records."""
    path = f"{scratch_dir(spark, 'csv')}/documents"
    d = table(spark, sf, "documents").select("doc_id", F.regexp_replace("text", "the ", 'the "').alias("text"), "lang")
    d.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    sizes = storage.glob_sizes(spark, f"{path}/*.csv")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    # Several splits of a file, however small the table is; a large one keeps splits of a useful size.
    spark.conf.set(name, str(max(sum(sizes.values()) // 128, 1 << 16)))
    try:
        back = files.read_csv_files(spark, f"{path}/*.csv", dtype={"doc_id": "int", "text": "str", "lang": "str"}, multi_line=True)
    finally:
        spark.conf.set(name, before)
    text = F.regexp_replace("text", 'the "', "the ")
    return back.select("doc_id", F.md5(text.cast("binary")).alias("text_md5"), "lang", F.length(text).cast("bigint").alias("n_chars"))


SQL_PAGES = """
pages AS (SELECT event_id, event_type, value,
                 (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 50 + 1 AS page,
                 (count(*) OVER (PARTITION BY event_type) - 1) // 50 + 1 AS pages FROM events)
"""


def event_type_pages(spark, sf):
    """Payloads ``[{page, pages}, rows]`` of each event type, as one text per page."""
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    numbered = e.withColumn("n", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")))
    size = e.groupBy("event_type").agg(F.ceil(F.count("*") / PAGE_ROWS).cast("bigint").alias("pages"))
    pages = numbered.withColumn("page", F.floor((F.col("n") - 1) / PAGE_ROWS) + 1).groupBy("event_type", "page").agg(
        F.collect_list(F.struct("event_id", "value")).alias("rows")).join(size, "event_type")
    return pages.select("event_type", "page", F.format_string("[%s,%s]", F.to_json(F.struct("page", "pages")), F.to_json("rows")).alias("value"))


@query("paged_payload_gaps", f"""
WITH {SQL_PAGES}
SELECT DISTINCT event_type, CAST(page AS BIGINT) AS page FROM pages WHERE page % 7 = 3
""")
def paged_payload_gaps(spark, sf):
    """Pages that others of their set promise and that have not landed; some landed twice."""
    root = f"{scratch_dir(spark, 'json')}/pages"
    pages = event_type_pages(spark, sf)
    landed = pages.filter("page % 7 <> 3")
    landed.unionByName(landed.filter("page % 5 = 0")).select("event_type", "value").write.partitionBy("event_type").text(root)
    docs = payload.read_payloads(spark, root, per_line=True)
    docs = docs.withColumn("event_type", F.regexp_extract("file", "event_type=([^/]*)", 1))
    return payload.missing_pages(payload.numbered_pages(docs, [0, "page"], [0, "pages"], ["event_type"]), ["event_type"])


@query("paged_payload_once", f"""
WITH {SQL_PAGES}
SELECT event_type, event_id, value FROM pages WHERE page % 7 <> 3
""")
def paged_payload_once(spark, sf):
    """The records of pages that landed once or twice, each once."""
    pages = event_type_pages(spark, sf).filter("page % 7 <> 3")
    root = f"{scratch_dir(spark, 'json')}/pages"
    pages.unionByName(pages.filter("page % 5 = 0")).select("event_type", "value").write.partitionBy("event_type").text(root)
    docs = payload.read_payloads(spark, root, per_line=True).withColumn("event_type", F.regexp_extract("file", "event_type=([^/]*)", 1))
    once = payload.complete_pages(docs, [0, "page"], [0, "pages"], ["event_type"], on_gap="ignore")
    rows = F.try_variant_get("payload", "$[1]", "array<struct<event_id: bigint, value: double>>")
    return once.select("event_type", F.inline(rows))
