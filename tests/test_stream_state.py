"""A stream of payloads into the states of the fact: replays, restarts, expiry."""

import json
import os

import pytest
from pyspark.sql import types as T

from starmart.plans import incremental
from starmart.sources import warehouse
from starmart.streaming.payload import stream_into_fact

RECORD = T.StructType([T.StructField("_id", T.StringType()), T.StructField("vehicle_id", T.StringType()),
                       T.StructField("passenger_count", T.IntegerType())])


@pytest.fixture
def source(spark, folder):
    """Land files of records, take them up, and see the totals per vehicle."""
    os.makedirs(folder("landing"))

    class Source:
        root = folder("w")

        def land(self, name, records, status=200, at=None, text=None):
            path = folder(f"landing/{name}.json")
            rows = [dict(zip(RECORD.names, r)) for r in records]
            with open(path, "w") as f:
                f.write(text or json.dumps({"status": status, "records": rows}))
            if at is not None:
                os.utime(path, (at, at))

        def run(self, within="1 day", max_files=None):
            stream_into_fact(spark, folder("landing"), RECORD, "records", "passagers", self.root, folder("checkpoint"),
                             within=within, max_files=max_files).awaitTermination()
            return self.totals()

        def totals(self):
            states = warehouse.read(spark, self.root, incremental.STATE).collect()
            return {r["vehicle_id"]: (r["total_passengers"], r["passenger_records"]) for r in states}
    return Source()


def test_replays_count_once_even_after_a_restart(source):
    source.land("a", [("1", "V", 5), ("2", "V", 7), ("1", "V", 5)])
    source.land("b", [("2", "V", 7), ("3", "W", 1)])
    assert source.run() == {"V": (12, 2), "W": (1, 1)}
    source.land("c", [("1", "V", 5), ("3", "W", 1), ("4", "W", 2)])
    assert source.run(max_files=1) == {"V": (12, 2), "W": (3, 2)}
    assert source.run() == {"V": (12, 2), "W": (3, 2)}  # nothing new


def test_refused_payloads_and_records_without_a_key(source):
    source.land("a", [("1", "V", 5)], status=503)
    source.land("b", [], text='{"status": 200, "records": [{"_id"')
    source.land("c", [(None, "V", 2), (None, "V", 2), ("1", "V", 5), ("2", None, 9)])
    assert source.run() == {"V": (9, 3), None: (9, 1)}


def test_a_batch_that_fails_is_taken_up_again(source, monkeypatch):
    source.land("a", [("1", "V", 5)])
    source.run()
    source.land("b", [("1", "V", 5), ("2", "V", 1)])
    merge = incremental.merge

    def lost(*a, **k):
        merge(*a, **k)
        raise OSError("lost after the commit")
    monkeypatch.setattr(incremental, "merge", lost)
    with pytest.raises(Exception, match="lost after the commit"):
        source.run()
    assert source.totals() == {"V": (6, 2)}
    monkeypatch.undo()
    assert source.run() == {"V": (6, 2)}  # the same batch again


def test_keys_are_forgotten_in_time(source):
    day = 86_400
    source.land("a", [("1", "V", 5)], at=1_700_000_000)
    source.land("b", [("1", "V", 5)], at=1_700_000_000 + day // 2)
    assert source.run(max_files=1) == {"V": (5, 1)}
    source.land("c", [("9", "W", 1)], at=1_700_000_000 + 3 * day)
    source.run(max_files=1)
    source.land("d", [("1", "V", 5)], at=1_700_000_000 + 3 * day + 60)
    assert source.run(max_files=1) == {"V": (10, 2), "W": (1, 1)}  # more than a day later it is another record


def test_streams_and_loads_count_their_batches_apart(spark, source):
    people = spark.createDataFrame([("V", 100)], "vehicle_id string, passenger_count int")
    incremental.merge(spark, source.root, {"passagers": people}, 7)
    source.land("a", [("1", "V", 5)])
    assert source.run() == {"V": (105, 2)}
    incremental.merge(spark, source.root, {"passagers": people}, 7)
    assert source.totals() == {"V": (105, 2)}
    incremental.merge(spark, source.root, {"passagers": people}, 8)
    assert source.totals() == {"V": (205, 3)}
