"""The fact kept up batch by batch equals the fact of all rows."""

import os

import pytest
from pyspark.sql import functions as F

from starmart.plans import incremental, star
from starmart.sources import warehouse
from starmart_demo.inputs import star_inputs
from starmart_demo.star import _batches
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return star_inputs(spark, SF)


def one_vehicle(inputs, vehicle):
    return {n: inputs[n].where(F.col("vehicle_id") == vehicle) for n in ("transport", "passagers", "gps", "incident")}


def without_count(df):
    return rows(df.drop("stops_count"))


def test_three_batches_equal_the_full_build(spark, inputs, folder):
    want = star.fact_summary(inputs)
    for number, batch in enumerate(_batches(inputs), 1):
        incremental.merge(spark, folder("w"), batch, number, buckets=8)
    got = incremental.fact(spark, folder("w"))
    assert got.columns == want.columns and without_count(got) == without_count(want)


def test_only_touched_buckets_are_read_and_written(spark, inputs, folder, monkeypatch):
    root = folder("w")
    incremental.merge(spark, root, {n: inputs[n] for n in ("transport", "passagers")}, 1, buckets=16)
    first = warehouse.snapshot(spark, root).tables[incremental.STATE]
    assert len(first.paths) == 16
    read = []
    parquet = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: (read.extend(p), parquet(self, *p, **k))[1])
    done = incremental.merge(spark, root, one_vehicle(inputs, "7"), 2)
    assert done["of"] == 16 and len(done["touched"]) == 1
    bucket = str(done["touched"][0])
    assert [p for p in read if incremental.BUCKET in p] == [f"{root}/{first.notes['files'][bucket]}"]
    second = warehouse.snapshot(spark, root).tables[incremental.STATE]
    changed = {b for b in second.notes["files"] if second.notes["files"][b] != first.notes["files"][b]}
    assert changed == {bucket} and os.listdir(f"{root}/{second.paths[0].split('/' + incremental.STATE)[0]}")
    run = second.notes["files"][bucket].rsplit("/", 1)[0]
    assert [n for n in os.listdir(f"{root}/{run}") if n.startswith(incremental.BUCKET)] == [f"{incremental.BUCKET}={bucket}"]


def test_a_batch_counts_once(spark, inputs, folder):
    batch = _batches(inputs)[0]
    incremental.merge(spark, folder("w"), batch, 1, buckets=4)
    before = without_count(incremental.fact(spark, folder("w")))
    assert incremental.merge(spark, folder("w"), batch, 1)["touched"] == []
    assert without_count(incremental.fact(spark, folder("w"))) == before
    assert warehouse.snapshot(spark, folder("w")).version == 1


def test_a_batch_that_fails_can_be_loaded_again(spark, inputs, folder, monkeypatch):
    batches = _batches(inputs, 2)
    incremental.merge(spark, folder("w"), batches[0], 1, buckets=4)
    before = without_count(incremental.fact(spark, folder("w")))
    broken = {**batches[1], "passagers": inputs["passagers"].withColumn(
        "passenger_count", F.raise_error(F.lit("lost")).cast("int"))}
    with pytest.raises(Exception, match="lost"):
        incremental.merge(spark, folder("w"), broken, 2)
    assert without_count(incremental.fact(spark, folder("w"))) == before
    incremental.merge(spark, folder("w"), batches[1], 2)
    assert without_count(incremental.fact(spark, folder("w"))) == without_count(star.fact_summary(inputs))


def test_two_loads_at_once_conflict(spark, inputs, folder, monkeypatch):
    batches = _batches(inputs, 2)
    incremental.merge(spark, folder("w"), batches[0], 1, buckets=4)
    commit = warehouse.commit

    def late(*a, **k):
        monkeypatch.setattr(warehouse, "commit", commit)
        incremental.merge(spark, folder("w"), batches[1], 2)  # by another run
        return commit(*a, **k)
    monkeypatch.setattr(warehouse, "commit", late)
    with pytest.raises(warehouse.Conflict):
        incremental.merge(spark, folder("w"), batches[1], 3)
    assert without_count(incremental.fact(spark, folder("w"))) == without_count(star.fact_summary(inputs))


def test_late_vehicles_new_attributes_and_nulls(spark, folder):
    root = folder("w")
    people = spark.createDataFrame([("A", 3), ("A", None), (None, 5)], "vehicle_id string, passenger_count int")
    incremental.merge(spark, root, {"passagers": people}, 1, buckets=2)
    assert incremental.fact(spark, root).count() == 0  # the vehicle has not come yet
    vehicle = lambda kind, size: spark.createDataFrame(
        [("A", kind, "C", size, None, "on")],
        "vehicle_id string, type_transport string, company_name string, capacity int, fuel_type string, status string")
    incremental.merge(spark, root, {"transport": vehicle("Bus", 50)}, 2)
    incremental.merge(spark, root, {"transport": vehicle("Autobus", 10), "passagers": people}, 3)
    r = incremental.fact(spark, root).collect()
    assert [(x["type_transport"], x["capacity"], x["total_passengers"], x["passenger_records"]) for x in r] == [
        ("Autobus", 10, 6, 4)]
    assert incremental.merge(spark, root, {"passagers": people.limit(0)}, 4)["touched"] == []
