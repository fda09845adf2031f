"""Projections, cleaning and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators import cleaning, filters, joins, projection
from starmart_demo.registry import query, table


def _customer_events(spark, sf):
    """Customers with the total of their events; customers without events have nulls."""
    totals = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("n_events"), F.max("value").alias("top_value"),
        F.max_by("event_type", F.struct("value", "event_id")).alias("last_type"))
    return joins.enrich(table(spark, sf, "customer"), totals, "c_custkey")


EVENTS_CTE = """WITH ce AS (
  SELECT c.*, n_events, top_value, last_type
  FROM customer c LEFT JOIN (
    SELECT user_id, count(*) AS n_events, max(value) AS top_value,
           arg_max(event_type, (value, event_id)) AS last_type
    FROM events GROUP BY user_id) ON c_custkey = user_id)
"""


@query("""
SELECT c_custkey AS vehicle_id, c_name AS name, CAST(c_nationkey AS DOUBLE) AS zone,
       CAST(c_acctbal AS DOUBLE) AS capacity
FROM customer
""")
def project_rename_cast(spark, sf):
    df = projection.rename(table(spark, sf, "customer"),
                           {"c_custkey": "vehicle_id", "c_name": "name", "absent": "x"})
    df = projection.cast_cols(df, {"c_nationkey": "double", "c_acctbal": "double"})
    df = projection.drop_if_present(df, "c_mktsegment", "absent")
    return projection.project(df, {"vehicle_id": "vehicle_id", "name": "name",
                                   "zone": "c_nationkey", "capacity": "c_acctbal"})


@query("""
SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS quality,
       CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS toxic
FROM documents LEFT JOIN labels USING (doc_id)
""")
def flag_to_int(spark, sf):
    """A flag as text in mixed case and a flag as boolean, both with nulls."""
    labels = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "True").otherwise("False").alias("quality"),
        (F.col("toxic") == 1).alias("toxic"))
    docs = joins.enrich(table(spark, sf, "documents").select("doc_id"), labels, "doc_id")
    return projection.flag_to_int(docs, "quality", "toxic")


@query("""
SELECT doc_id, coalesce(quality = 1, false) AS quality FROM documents LEFT JOIN labels USING (doc_id)
""")
def flag_to_bool(spark, sf):
    labels = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "True").otherwise("False").alias("quality"))
    docs = joins.enrich(table(spark, sf, "documents").select("doc_id"), labels, "doc_id")
    return projection.flag_to_bool(docs, "quality")


@query("""
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS vehicle_id, CAST(NULL AS VARCHAR) AS passager_id
FROM orders
""")
def typed_null(spark, sf):
    return projection.add_typed_null(table(spark, sf, "orders").select("o_orderkey"),
                                     {"vehicle_id": "string", "passager_id": "string"})


@query("""
SELECT event_id, try_cast(CASE WHEN event_id % 7 = 0 THEN 'no date ' || event_id
                          ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS TIMESTAMP) AS ts
FROM events
""")
def parse_ts(spark, sf):
    texts = table(spark, sf, "events").select("event_id", F.when(
        F.col("event_id") % 7 == 0, F.concat(F.lit("no date "), F.col("event_id").cast("string")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"))
    out = projection.parse_ts(texts, "ts", lenient=True)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT s_suppkey AS id, s_name AS operator_name, s_nationkey AS country, s_acctbal FROM supplier
""")
def rename_headers(spark, sf):
    scraped = table(spark, sf, "supplier").withColumnsRenamed({
        "s_suppkey": "ID ", "s_name": "Operator Name (Short Name)", "s_nationkey": "Country"})
    return projection.rename_headers(scraped, {
        "Id": "id", "Operator Name (Short Name)": "operator_name", "Country": "country"})


@query("""
SELECT page_id, coalesce(nullif(trim(regexp_extract(url, 'ref=(\\w+)', 1)), ''), 'Unknown') AS ref,
       trim(url) AS url
FROM pages
""")
def clean_strings(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", F.concat(F.lit("  "), F.regexp_extract("url", r"ref=(\w+)", 1)).alias("ref"),
        F.concat("url", F.lit(" ")).alias("url"))
    return cleaning.fill_strings(pages, "Unknown")


@query("SELECT DISTINCT trim(p_brand) AS p_brand, trim(p_type) AS p_type FROM part")
def trim_strings(spark, sf):
    padded = table(spark, sf, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), "p_brand"))
        .otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat("p_type", F.lit("  ")))
        .otherwise(F.col("p_type")).alias("p_type"))
    return cleaning.trim_strings(padded)


@query(EVENTS_CTE + """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       coalesce(n_events, 0) AS n_events, coalesce(top_value, 0) AS top_value, last_type
FROM ce
""")
def fill_numeric(spark, sf):
    return cleaning.fill_numeric(_customer_events(spark, sf))


@query(EVENTS_CTE + """
SELECT c_custkey, coalesce(n_events, -1) AS n_events, coalesce(top_value, 0.5) AS top_value,
       coalesce(last_type, 'Unknown') AS last_type
FROM ce
""")
def fill_map(spark, sf):
    df = _customer_events(spark, sf).select("c_custkey", "n_events", "top_value", "last_type")
    return cleaning.fill_map(df, {"n_events": -1, "top_value": 0.5, "last_type": "Unknown"})


@query(EVENTS_CTE + """
SELECT c_custkey, coalesce(n_events, 0) AS n_events, round(coalesce(top_value, 0.0), 1) AS top_value
FROM ce
""")
def fill_round(spark, sf):
    df = _customer_events(spark, sf).select("c_custkey", "n_events", "top_value")
    return cleaning.fill_round(df, {"n_events": 0, "top_value": 0.0}, 1)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 1) AS l_extendedprice,
       round(l_tax, 1) AS l_tax
FROM lineitem
""")
def round1(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax")
    return cleaning.round_floats(lines, 1)


@query("SELECT min(doc_id) AS doc_id, text, lang, source FROM documents GROUP BY text, lang, source")
def dedupe_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return cleaning.dedupe(docs, ignore=["doc_id"])


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def dedupe_pairs(spark, sf):
    return cleaning.dedupe(table(spark, sf, "orders").select("o_custkey", "o_orderpriority"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value FROM events
""")
def nan_to_null(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.when(
        F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return cleaning.nan_to_null(events)


@query(EVENTS_CTE + """
SELECT c_custkey, n_events, last_type FROM ce WHERE n_events IS NOT NULL AND last_type IS NOT NULL
""")
def keys_not_null(spark, sf):
    df = _customer_events(spark, sf).select("c_custkey", "n_events", "last_type")
    return filters.require_keys(df, "n_events", "last_type")


@query(EVENTS_CTE + "SELECT c_custkey, last_type FROM ce WHERE last_type <> 'view'")
def exclude_status(spark, sf):
    df = _customer_events(spark, sf).select("c_custkey", "last_type")
    return filters.exclude_status(df, "last_type", "view")


@query(EVENTS_CTE + "SELECT c_custkey, c_name FROM ce WHERE n_events IS NULL")
def null_rows(spark, sf):
    return filters.null_rows(_customer_events(spark, sf), "n_events").select("c_custkey", "c_name")


@query(EVENTS_CTE + """
SELECT c_custkey, c_mktsegment, n_events, last_type FROM ce
WHERE NOT (n_events IS NOT NULL AND (c_mktsegment = 'MACHINERY' OR nullif(last_type, 'view') IS NULL))
""")
def negated_filter(spark, sf):
    df = _customer_events(spark, sf).withColumn("detail", F.nullif("last_type", F.lit("view")))
    return filters.keep_valid_detail(df, "n_events", "c_mktsegment", "MACHINERY", ["detail"]) \
        .select("c_custkey", "c_mktsegment", "n_events", "last_type")


@query("""
SELECT * FROM part WHERE contains(p_name, 'ring') OR contains(p_brand, 'ring') OR contains(p_type, 'ring')
""")
def search_all(spark, sf):
    return filters.search(table(spark, sf, "part"), "ring")


@query("""
SELECT doc_id FROM documents
WHERE contains(text, 'sch') OR contains(lang, 'sch') OR contains(source, 'sch')
""")
def search_documents(spark, sf):
    return filters.search(table(spark, sf, "documents"), "sch").select("doc_id")
