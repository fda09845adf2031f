"""Sequence ids and cyclic assignment."""

from __future__ import annotations

from starmart.operators import keys
from starmart_demo.registry import query, table


@query("""
SELECT o_orderkey, 'pa_' || row_number() OVER (ORDER BY o_orderkey) AS passager_id FROM orders
""")
def sequence_ids(spark, sf):
    return keys.add_sequence(table(spark, sf, "orders").select("o_orderkey"),
                             "passager_id", "pa_", "o_orderkey")


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders
""")
def serial_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return keys.add_sequence(orders, "id", order_by=["o_orderdate", "o_orderkey"]) \
        .drop("o_orderdate")


@query("""
WITH l AS (SELECT p_partkey, p_name, (row_number() OVER (ORDER BY p_partkey) - 1)
             % (SELECT count(*) FROM supplier) AS k FROM part),
r AS (SELECT s_name, row_number() OVER (ORDER BY s_name) - 1 AS k FROM supplier)
SELECT p_partkey, p_name, s_name FROM l JOIN r USING (k)
""")
def round_robin(spark, sf):
    return keys.assign_round_robin(
        table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey",
        table(spark, sf, "supplier"), "s_name")
