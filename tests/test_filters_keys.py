import os
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.operators import filters, keys
from tests.conftest import plan, rows


def test_require_keys(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "x string, y string")
    assert rows(filters.require_keys(df, "x", "y")) == [("a", "b")]
    assert filters.require_keys(df, "x").count() == 2


def test_exclude_status_drops_nulls(spark):
    df = spark.createDataFrame([("actif",), ("hors service",), (None,)], "status string")
    assert rows(filters.exclude_status(df, "status", "hors service")) == [("actif",)]


def test_keep_valid_detail(spark):
    df = spark.createDataFrame([
        (1, "p", "actif", "s"),          # kept
        (2, "p", "hors service", "s"),   # out of service
        (3, "p", "actif", None),         # no stop details
        (4, None, "hors service", None),  # no passenger: kept
        (5, "p", None, "s"),             # status unknown: test unknown, dropped
    ], "id int, passager_id string, status string, stop_name string")
    out = filters.keep_valid_detail(df, "passager_id", "status", "hors service", ["stop_name"])
    assert rows(out, "id") == [(1,), (4,)]


def test_search_all_text_columns(spark):
    df = spark.createDataFrame([("Bus", "ring", 1), ("RING", "x", 2), ("xringx", None, 3)],
                               "a string, b string, n int")
    assert rows(filters.search(df, "ring"), "n") == [(1,), (3,)]
    assert rows(filters.search(df, "ring", ["a"]), "n") == [(3,)]
    assert filters.search(df.select("n"), "1") is None
    assert filters.search(df, "") is None


def test_null_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "n int, s string")
    assert rows(filters.null_rows(df, "s"), "n") == [(1,)]


def test_first_per_key_limits_each_task_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    out = filters.first_per_key(df, "k", [F.asc("v")])
    assert rows(out) == [("a", 1), ("b", 5)]
    text = plan(out)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_sequence_is_dense_ordered_and_stable(spark):
    df = spark.range(0, 5000, 1, 13).select(
        (F.col("id") * 7919 % 5000).alias("k"), F.concat(F.lit("k"), "id").alias("s"))
    expected = {k: f"pa_{k + 1}" for k in range(5000)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out = keys.add_sequence(df.repartition(int(n)), "id", "pa_", "k")
            assert {r["k"]: r["id"] for r in out.collect()} == expected
            assert out.columns == ["k", "s", "id"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sequence_by_several_columns_with_a_hot_key_and_nulls(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("a"),
        F.col("id").alias("b"))
    out = [tuple(r) for r in keys.add_sequence(df, "n", order_by=["a", "b"]).collect()]
    want = sorted(((r["a"], r["b"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sorted((n, a, b) for a, b, n in out) == [(i + 1, a, b) for i, (a, b) in enumerate(want)]


def test_sequence_is_written_not_windowed(spark):
    text = plan(keys.add_sequence(spark.range(1000).repartition(8), "n", order_by="id"))
    assert "Window" not in text and "SinglePartition" not in text and "Scan parquet" in text


def test_sequence_of_an_empty_frame(spark):
    out = keys.add_sequence(spark.range(0), "n", order_by="id")
    assert out.count() == 0 and dict(out.dtypes)["n"] == "bigint"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(alphabet="aZé_0 ", max_size=4), min_size=1, max_size=60))
def test_sequence_orders_text_by_code_point(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string").repartition(5)
    out = {r["s"]: r["n"] for r in keys.add_sequence(df, "n", order_by="s").collect()}
    assert out == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_round_robin_is_cyclic_in_text_order(spark):
    stops = spark.createDataFrame([(f"SENGAR_{i}",) for i in range(1, 41)], "stop_id string")
    cars = spark.createDataFrame([(f"NUM_{i}",) for i in (1002, 1000, 1001, 1000)] + [(None,)],
                                 "vehicle_id string")
    out = dict(rows(keys.assign_round_robin(stops, "stop_id", cars, "vehicle_id")))
    ids = sorted(f"SENGAR_{i}" for i in range(1, 41))
    assert out == {s: f"NUM_{1000 + i % 3}" for i, s in enumerate(ids)}
    assert max(Counter(out.values()).values()) - min(Counter(out.values()).values()) <= 1


def test_round_robin_without_takers(spark):
    stops = spark.createDataFrame([("s",)], "stop_id string")
    out = keys.assign_round_robin(stops, "stop_id", stops.filter("false").selectExpr("stop_id v"), "v")
    assert rows(out) == [("s", None)]


def test_round_robin_repeats_for_rows_of_one_key(spark):
    stops = spark.createDataFrame([("s", i) for i in range(30)], "stop_id string, n int")
    cars = spark.range(7).selectExpr("concat('c', id) AS v")
    first = rows(keys.assign_round_robin(stops, "stop_id", cars, "v"))
    assert first == rows(keys.assign_round_robin(stops.repartition(5), "stop_id", cars, "v"))
    assert [r[2] for r in first] == [f"c{i % 7}" for i in range(30)]


def test_round_robin_sorts_only_the_takers_that_can_be_hit(spark, monkeypatch):
    numbered = []
    number = keys._number
    monkeypatch.setattr(keys, "_number", lambda df, *a: (numbered.append(df.columns), number(df, *a))[1])
    stops = spark.createDataFrame([(f"s{i}",) for i in range(5)], "stop_id string")
    out = keys.assign_round_robin(stops, "stop_id", spark.range(1000).selectExpr("lpad(id, 4, '0') AS v"), "v")
    assert rows(out) == [(f"s{i}", f"000{i}") for i in range(5)] and numbered == [["stop_id"]]


def test_a_cluster_needs_the_shared_folder():
    from starmart.session import scratch_root

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf()

    for master in ("spark://host", "local-cluster[2,1,1024]", "yarn", None):
        Session.conf = Conf({"spark.master": master} if master else {})
        with pytest.raises(ValueError):
            scratch_root(Session())
    for master in ("local", "local[2]", "local[*]"):
        Session.conf = Conf({"spark.master": master})
        assert scratch_root(Session()) == scratch_root(Session()) and os.path.isdir(scratch_root(Session()))
    Session.conf = Conf({"spark.master": "spark://host", "spark.checkpoint.dir": "hdfs:///cp/"})
    assert scratch_root(Session()) == "hdfs:///cp"


def test_written_tables_can_be_cleared_away(spark):
    from starmart import session

    df = session.materialise(spark.range(3), "x")
    path = df.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path) and session.clean_up(spark) >= 1
    assert not os.path.exists(path) and session.clean_up(spark) == 0
