"""Checks against declarations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import quality
from starmart.schemas import column, text
from starmart_demo.cleaning import EVENTS_CTE, _customer_events
from starmart_demo.registry import query, table


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def pk_violations(spark, sf):
    return quality.check_pk(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def unique_pair(spark, sf):
    return quality.check_unique(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query("""
SELECT user_id, ts, count(*) AS n
FROM (SELECT user_id, ts FROM events UNION ALL SELECT user_id, ts FROM events WHERE event_type = 'error')
GROUP BY 1, 2 HAVING count(*) > 1
""")
def one_place_at_a_time(spark, sf):
    """Errors are reported twice here."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_type")
    return quality.check_unique(events.unionByName(events.filter("event_type = 'error'")), ["user_id", "ts"])


@query("""
SELECT doc_id AS key, count(*) AS n FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY doc_id
""")
def fk_orphans(spark, sf):
    return quality.check_fk(table(spark, sf, "documents"), "doc_id",
                            table(spark, sf, "labels"), "doc_id")


LINE_FIT = T.StructType([
    column("l_quantity", T.DecimalType(5, 2)),
    column("l_extendedprice", T.DecimalType(6, 2)),
    column("l_discount", T.DecimalType(5, 2)),
    text("l_returnflag", 1),
    column("l_orderkey", T.ShortType()),
])


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {bad}) AS violations FROM lineitem"
    for c, bad in (
        ("l_quantity", "try_cast(l_quantity AS DECIMAL(5,2)) IS NULL"),
        ("l_extendedprice", "try_cast(l_extendedprice AS DECIMAL(6,2)) IS NULL"),
        ("l_discount", "try_cast(l_discount AS DECIMAL(5,2)) IS NULL"),
        ("l_returnflag", "length(l_returnflag) > 1"),
        ("l_orderkey", "try_cast(l_orderkey AS SMALLINT) IS NULL"))))
def fit_check(spark, sf):
    return quality.check_fit(table(spark, sf, "lineitem"), LINE_FIT)


SIZES = {"STANDARD": [1, 2, 3, 4, 5], "LARGE": [40, 41, 42], "ECONOMY": [10, 20, 30],
         "SMALL": [1, 2], "PROMO": [25], "MEDIUM": [20, 21, 22]}


@query("""
SELECT 'size_range' AS rule, count(*) FILTER (WHERE p_size NOT BETWEEN 5 AND 45) AS violations FROM part
UNION ALL SELECT 'type', count(*) FILTER (WHERE p_type NOT IN ('STANDARD', 'LARGE', 'SMALL')) FROM part
UNION ALL SELECT 'size_of_type', count(*) FILTER (WHERE NOT (
""" + " OR ".join(f"(p_type = '{t}' AND p_size IN ({', '.join(map(str, v))}))"
                  for t, v in SIZES.items()) + ")) FROM part")
def domain_check(spark, sf):
    return quality.check_domain(table(spark, sf, "part"), {
        "size_range": F.col("p_size").between(5, 45),
        "type": F.col("p_type").isin("STANDARD", "LARGE", "SMALL"),
        "size_of_type": quality.allowed_by_type("p_type", "p_size", SIZES),
    })


TARGET = T.StructType([
    text("c_custkey"),
    column("n_events", T.IntegerType(), default=0),
    column("top_value", T.DoubleType(), default=0.0),
    text("last_type", default="Unknown"),
    text("zone"),
])


@query(EVENTS_CTE + """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(n_events AS INT) AS n_events, top_value, last_type,
       CAST(NULL AS VARCHAR) AS zone
FROM ce
""")
def conform(spark, sf):
    return quality.conform(_customer_events(spark, sf), TARGET, extra="drop")


@query(EVENTS_CTE + """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(coalesce(n_events, 0) AS INT) AS n_events,
       coalesce(top_value, 0.0) AS top_value, coalesce(last_type, 'Unknown') AS last_type,
       CAST(NULL AS VARCHAR) AS zone
FROM ce
""")
def defaults(spark, sf):
    return quality.apply_defaults(
        quality.conform(_customer_events(spark, sf), TARGET, extra="drop"), TARGET)


@query("""
SELECT 'events' AS table_name, count(*) = 0 AS is_empty FROM events
UNION ALL SELECT 'late', count(*) = 0 FROM events WHERE value > 100000
""")
def is_empty(spark, sf):
    events = table(spark, sf, "events")
    return quality.is_empty(events).select(F.lit("events").alias("table_name"), "*").unionByName(
        quality.is_empty(events.filter("value > 100000")).select(F.lit("late").alias("table_name"), "*"))
