"""Tables in buckets: no exchange, hot keys aside, versions."""

import os

import pytest
from pyspark.sql import functions as F

from starmart.plans import colocated, star
from starmart.sources import bucketed, filesystem, warehouse
from tests.conftest import plan
from tests.conftest import rows as plain_rows
from tests.test_star import inputs  # noqa: F401

N = 8


def rows(df, *columns):
    """NaN equals itself as text."""
    return [tuple(map(str, r)) for r in plain_rows(df, *columns)]


def skewed(spark, inputs):  # noqa: F811
    """One vehicle, and rows without one, hold a third of the records each."""
    more = spark.range(3000).select(
        F.concat(F.lit("q"), "id").alias("_id"), (F.col("id") % 90).cast("int").alias("passenger_count"),
        F.lit("2025-07-01").cast("timestamp").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "V1").when(F.col("id") % 3 == 1, F.concat(F.lit("W"), F.col("id") % 500)).alias("vehicle_id"),
        F.lit("S1").alias("stop_id"), F.lit("True").alias("boarding"), F.lit("True").alias("alighting"))
    cars = spark.range(500).select(
        F.concat(F.lit("W"), "id").alias("vehicle_id"), *[F.lit("x").alias(c) for c in ("type_transport", "company_name")],
        F.lit(4).alias("capacity"), *[F.lit("y").alias(c) for c in ("fuel_type", "status")])
    return {**inputs, "passagers": inputs["passagers"].unionByName(more),
            "transport": inputs["transport"].unionByName(cars, allowMissingColumns=True)}


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_same_fact_without_an_exchange(spark, inputs, folder, no_broadcast):  # noqa: F811
    colocated.store(spark, folder("w"), inputs, N, hot=100)
    df = colocated.fact(spark, folder("w"))
    text = plan(df)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 3
    assert text.count(f"SelectedBucketsCount: {N} out of {N}") == 4
    assert rows(df, *sorted(df.columns)) == rows(star.fact_summary(inputs), *sorted(df.columns))


def test_hot_keys_and_rows_without_a_key(spark, inputs, folder, no_broadcast):  # noqa: F811
    data = skewed(spark, inputs)
    colocated.store(spark, folder("w"), data, N, hot=2)
    stored = warehouse.snapshot(spark, folder("w")).tables["passagers"]
    assert stored.notes == {"key": "vehicle_id", "buckets": N, "hot": 1}
    parts = bucketed.read(spark, folder("w"), "passagers")
    assert rows(parts.aside.groupBy("vehicle_id").count()) == [("None", "1000"), ("V1", "1003")]
    df = colocated.fact(spark, folder("w"))
    # the rows aside are summed up in each task before their exchange; all others are not exchanged
    text = plan(df)
    aside = [n for n in colocated.INPUTS if bucketed.read(spark, folder("w"), n).aside is not None]
    assert aside == ["passagers", "gps", "incident"]
    assert text.count("Exchange hashpartitioning(") == text.count("BroadcastExchange") == len(aside)
    assert all("partial_" in part.split("FileScan")[0] for part in text.split("Exchange hashpartitioning(")[1:])
    assert rows(df, *sorted(df.columns)) == rows(star.fact_summary(data), *sorted(df.columns))
    assert warehouse.read(spark, folder("w"), "passagers").count() == data["passagers"].count() == parts.all().count()


def test_one_file_a_bucket(spark, folder):
    df = spark.range(10_000).select(F.concat(F.lit("k"), F.col("id") % 700).alias("k"), "id")
    warehouse.in_one_run(spark, folder("w"), lambda run: {"t": bucketed.store(spark, folder("w"), run, "t", df, "k", N)})
    stored = warehouse.snapshot(spark, folder("w")).tables["t"]
    found = [f for f in os.listdir(f"{folder('w')}/{stored.paths[0]}") if f.endswith(".parquet")]
    assert len(found) == N and len(stored.paths) == 1
    assert rows(bucketed.read(spark, folder("w"), "t").all()) == rows(df)


def test_another_session_and_an_older_version(spark, inputs, folder):  # noqa: F811
    first = colocated.store(spark, folder("w"), inputs, N)
    want = rows(colocated.fact(spark, folder("w")))
    colocated.store(spark, folder("w"), {**inputs, "passagers": inputs["passagers"].limit(0)}, 4)
    assert bucketed.forget(spark) >= 8 and bucketed.forget(spark) == 0
    assert rows(colocated.fact(spark, folder("w"), first)) == want  # names made anew, data still there
    now = colocated.fact(spark, folder("w"))
    assert now.agg(F.sum("total_passengers")).first()[0] == 0
    bucketed.forget(spark)


def test_edges(spark, inputs, folder):  # noqa: F811
    nobody = inputs["transport"].limit(1).withColumn("vehicle_id", F.lit(None).cast("string"))
    data = {**inputs, "transport": inputs["transport"].unionByName(nobody),
            "passagers": inputs["passagers"].withColumn("vehicle_id", F.lit(None).cast("string"))}
    colocated.store(spark, folder("w"), data, N)
    df = colocated.fact(spark, folder("w"))
    assert rows(df, *sorted(df.columns)) == rows(star.fact_summary(data), *sorted(df.columns))
    colocated.store(spark, folder("e"), {n: d.limit(0) for n, d in inputs.items()}, N)
    assert colocated.fact(spark, folder("e")).count() == 0


def test_a_failure_leaves_no_version(spark, inputs, folder, monkeypatch):  # noqa: F811
    inner = bucketed.store

    def broken(spark, root, run, name, *rest):
        if name == "gps":
            raise OSError("lost")
        return inner(spark, root, run, name, *rest)
    monkeypatch.setattr(bucketed, "store", broken)
    with pytest.raises(OSError):
        colocated.store(spark, folder("w"), inputs, N)
    assert warehouse.snapshot(spark, folder("w")).version == 0
    assert filesystem.names(spark, f"{folder('w')}/data") == []


def test_fewer_hot_keys_than_buckets(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert len(bucketed.hot_keys(df, "k", 8, 1)) <= 8 and sorted(bucketed.hot_keys(df, "k", 40, 2)) == list(range(10))
    assert bucketed.hot_keys(df, "k", 8, 4) == [] and bucketed.hot_keys(df.limit(0), "k", 8) == []
