from datetime import datetime


from starmart.operators import aggregates, joins
from tests.conftest import plan, rows


def test_enrich_keeps_every_row(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("x", 9)], "k string, w int")
    want = [(None, 3, None), ("x", 1, 9), ("y", 2, None)]
    assert rows(joins.enrich(a, b, "k")) == want


def test_attach_many_equals_left_join(spark):
    parent = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    child = spark.createDataFrame([("a", "p"), ("a", "q"), ("z", "r"), (None, "s")], "k string, w string")
    out = joins.attach_many(parent, child, "k")
    assert rows(out) == rows(parent.join(child, "k", "left"))
    assert out.columns == ["k", "v", "w"]


def test_a_hot_key_is_split_between_tasks(spark):
    """A third of the children under one key: the join splits that partition at run time."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        parent = spark.range(3000).selectExpr("id AS k", "id AS v")
        child = spark.range(0, 60_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 4000 END AS k", "id AS w", "sha2(string(id), 256) AS s")
        out = joins.attach_many(parent, child, "k")
        assert out.select("w").count() == parent.join(child, "k", "left").count()
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bridge_join_and_pairs(spark):
    passes = spark.createDataFrame([("v1", "s1"), ("v1", "s1"), ("v1", "s2"), ("v2", "s9")],
                                   "vehicle_id string, stop_id string")
    cars = spark.createDataFrame([("v1",), ("v2",), ("v3",)], "vehicle_id string")
    stops = spark.createDataFrame([("s1", "A"), ("s2", "B")], "stop_id string, name string")
    pairs = joins.vehicle_stops(passes, "vehicle_id", "stop_id")
    assert pairs.count() == 3
    out = joins.bridge_join(cars, pairs, stops, "vehicle_id", "stop_id")
    assert rows(out, "vehicle_id", "stop_id", "name") == [
        ("v1", "s1", "A"), ("v1", "s2", "B"), ("v2", "s9", None), ("v3", None, None)]


def test_stop_passager_bridge_multiplies_stops(spark):
    stops = spark.createDataFrame([("s1", "v1"), ("s2", "v2")], "stop_id string, vehicle_id string")
    people = spark.createDataFrame([("p1", "s1"), ("p2", "s1"), ("p2", "s1"), ("p3", None), ("p4", "s7")],
                                   "passager_id string, stop_id string")
    assert rows(joins.stop_passager_bridge(stops, people)) == [
        ("s1", "v1", "p1"), ("s1", "v1", "p2"), ("s2", "v2", None)]


def test_relationships_counts_null_as_a_value(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), ("z",), (None,), (None,)], "k string")
    out = joins.relationships({"a": a, "b": b, "none": a.filter("false")}, "k", "a")
    assert rows(out) == [("a", 2, 2, 0), ("b", 3, 1, 1), ("none", 0, 0, 0)]


def test_summarise_sums_and_counts(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, None), ("b", None, "y")], "k string, v int, c string")
    out = aggregates.summarise(df, "k", {"total": "v"}, {"c_count": "c"}, "n")
    assert rows(out) == [("a", 1, 1, 2), ("b", None, 1, 1)]
    assert dict(out.dtypes)["total"] == "bigint"


def test_summarise_adds_up_before_the_shuffle(spark):
    text = plan(aggregates.summarise(
        spark.range(10).selectExpr("id % 3 AS k", "id"), "k", {"s": "id"}))
    assert text.index("Exchange") < text.index("partial_sum")


def test_latest_breaks_ties_and_ignores_null_times(spark):
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    df = spark.createDataFrame([
        ("a", "1", t1, "old"), ("a", "2", t2, "low"), ("a", "3", t2, "high"), ("a", "9", None, "null"),
        ("b", "4", None, "only"), ("b", "5", None, "last")], "k string, id string, ts timestamp, v string")
    want = [("a", "3", t2, "high"), ("b", "5", None, "last")]
    assert rows(aggregates.latest_per_key(df, "k", "ts", "id")) == want
    assert rows(aggregates.latest_max_by(df, "k", "ts", "id", df.columns)) == want
    assert aggregates.latest_max_by(df, "k", "ts", "id", ["k", "v"]).columns == ["k", "v"]


def test_stop_counts_without_building_pairs(spark):
    stops = spark.createDataFrame([("s1", "v1"), ("s2", "v1"), ("s3", "v2")], "stop_id string, vehicle_id string")
    people = spark.createDataFrame([("p1", "s1"), ("p2", "s1"), ("p3", "s1"), ("p4", "s9")],
                                   "passager_id string, stop_id string")
    assert rows(aggregates.stop_counts(stops, people)) == [("v1", 2, 4), ("v2", 1, 1)]


def test_kpis_of_an_empty_fact_are_null(spark):
    fact = spark.createDataFrame([], "incident_count long, total_delay_minutes long, total_passengers long")
    assert set(aggregates.global_kpis(fact).first()) == {None}


def test_kpis(spark):
    fact = spark.createDataFrame([(1, 10, 5, 2), (3, 20, None, 0), (None, 99, 1, 1)],
                                 "incident_count long, total_delay_minutes long, total_passengers long, stops_count long")
    r = aggregates.global_kpis(fact).first()
    assert (r["total_incidents"], r["avg_incidents_per_vehicle"], r["max_incidents"]) == (4, 2.0, 3)
    assert (r["total_delay"], r["avg_delay_per_vehicle"]) == (30, 15.0)  # only rows with incidents known
    assert (r["total_passengers"], r["avg_passengers"], r["max_passengers"], r["total_stops"]) == (6, 3.0, 5, 3)


def test_frequencies_top_k_and_previews(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacd"], "c string")
    assert [tuple(r) for r in aggregates.frequencies(df, "c").collect()] == [
        ("a", 2), ("b", 2), ("c", 1), ("d", 1)]
    assert [r["c"] for r in aggregates.top_k(df, "c", 3).collect()] == ["a", "b", "c"]
    nums = spark.range(100).repartition(7)
    assert [r["id"] for r in aggregates.preview(nums, 3, "id").collect()] == [0, 1, 2]
    assert aggregates.preview(nums, 40).count() == 40
    assert aggregates.head(nums, 5, "id").count() == 5
    assert "TakeOrderedAndProject" in plan(aggregates.preview(nums, 3, "id"))


def test_bridge_join_refuses_repeated_keys(spark):
    import pytest

    df = spark.createDataFrame([("a",), ("a",)], "k1 string")
    bridge = spark.createDataFrame([("a", 1)], "k1 string, k2 int")
    dim = spark.createDataFrame([(1, "x")], "k2 int, n string")
    out = joins.bridge_join(df, bridge, dim, "k1", "k2")  # nothing is computed yet
    for action in (out.collect, out.count):
        with pytest.raises(Exception, match="k1 is repeated"):
            action()
    assert joins.bridge_join(df, bridge, dim, "k1", "k2", fan_out=True).count() == 2
    assert rows(joins.bridge_join(df.distinct(), bridge, dim, "k1", "k2")) == [("a", 1, "x")]
