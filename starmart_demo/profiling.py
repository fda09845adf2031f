"""Profiles, counts and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators import profiling
from starmart.plans import reports
from starmart_demo.cleaning import EVENTS_CTE, _customer_events
from starmart_demo.registry import query, table

ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax"]


def _describe(col):
    # Exact decimal sums on the oracle side; the engines add doubles in different orders.
    return f"""SELECT '{col}' AS column, count({col}) AS count,
  round(CAST(sum(CAST({col} AS DECIMAL(28,4))) AS DOUBLE) / count({col}), 6) AS mean,
  round(stddev_samp({col}), 6) AS stddev, CAST(min({col}) AS DOUBLE) AS min,
  CAST(max({col}) AS DOUBLE) AS max FROM lineitem"""


@query(" UNION ALL ".join(_describe(c) for c in LINE_NUMBERS))
def describe_numeric(spark, sf):
    out = profiling.describe_numeric(table(spark, sf, "lineitem"))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(EVENTS_CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls, "
    f"(count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_pct FROM ce"
    for c in ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
              "n_events", "top_value", "last_type"]))
def null_profile(spark, sf):
    return profiling.null_profile(_customer_events(spark, sf))


def _distinct(col, frm):
    return (f"SELECT '{col}' AS column, count(DISTINCT {col}) + coalesce(max(CASE WHEN {col} IS NULL "
            f"THEN 1 ELSE 0 END), 0) AS distinct_values FROM {frm}")


@query(" UNION ALL ".join(_distinct(c, "documents") for c in ("text", "lang", "source")))
def distinct_profile(spark, sf):
    return profiling.distinct_profile(table(spark, sf, "documents"), by_column=True)


@query(EVENTS_CTE + " UNION ALL ".join(_distinct(c, "ce") for c in
                                       ("c_name", "c_mktsegment", "last_type")))
def distinct_with_nulls(spark, sf):
    return profiling.distinct_profile(_customer_events(spark, sf))


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(DISTINCT {k}) AS distinct_keys FROM {t}"
    for t, k in (("orders", "o_custkey"), ("events", "user_id"), ("customer", "c_custkey"))))
def distinct_keys(spark, sf):
    return profiling.distinct_keys({
        "orders": table(spark, sf, "orders").withColumnRenamed("o_custkey", "k"),
        "events": table(spark, sf, "events").withColumnRenamed("user_id", "k"),
        "customer": table(spark, sf, "customer").withColumnRenamed("c_custkey", "k")}, "k")


COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
           "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
           "benchmark": 2, "labels": 3, "conversations": 4}


@query("SELECT table_name, rows, columns, round(rows * 100.0::DOUBLE / sum(rows) OVER (), 6) AS share_pct"
       " FROM (" + " UNION ALL ".join(
           f"SELECT '{t}' AS table_name, count(*) AS rows, {n} AS columns FROM {t}"
           for t, n in COLUMNS.items()) + ")")
def table_counts_share(spark, sf):
    out = reports.warehouse_summary({t: table(spark, sf, t) for t in ALL_TABLES})
    return out.withColumn("share_pct", F.round("share_pct", 6))


@query("""
SELECT 'lineitem' AS table_name, least(count(*), 1000) AS n, count(*) < 1000 AS is_exact FROM lineitem
UNION ALL SELECT 'region', least(count(*), 1000), count(*) < 1000 FROM region
""")
def bounded_count(spark, sf):
    one = lambda t: profiling.bounded_count(table(spark, sf, t), 1000).select(
        F.lit(t).alias("table_name"), "*")
    return one("lineitem").unionByName(one("region"))


def _profile(col, kind, position):
    numeric = kind != "string" and kind != "timestamp_ntz"
    number = lambda e: f"CAST({e} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    distinct = f"count(DISTINCT {col})" if kind == "string" else "CAST(NULL AS BIGINT)"
    return f"""SELECT {position} AS position, '{col}' AS column, '{kind}' AS type, count(*) AS rows,
  count(*) - count({col}) AS nulls, round({number(f'avg({col})')}, 6) AS mean,
  round({number(f'stddev_samp({col})')}, 6) AS stddev, {number(f'min({col})')} AS min,
  {number(f'max({col})')} AS max, 0.0::DOUBLE AS null_pct, {distinct} AS distinct_values FROM orders"""


ORDER_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
              ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
              ("o_orderpriority", "string")]


@query(" UNION ALL ".join(_profile(c, k, i) for i, (c, k) in enumerate(ORDER_COLS)))
def table_profile(spark, sf):
    out = reports.profile(table(spark, sf, "orders"), stored=True)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})
