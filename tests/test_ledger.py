"""Each key once, and what an append reads for it."""

import pytest
from pyspark.sql import functions as F

from starmart.sources import files, ledger, warehouse
from tests.conftest import rows


def keyed(spark, low, high, step=1):
    return spark.range(low, high, step).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))


@pytest.fixture
def reads(spark, monkeypatch):
    """Paths that are read."""
    seen = []
    parquet = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: (seen.extend(p), parquet(self, *p, **k))[1])
    return seen


def test_loads_that_overlap_or_repeat(spark, folder):
    root = folder("w")
    counts = [ledger.append_once(df, root, "t", "k") for df in (
        keyed(spark, 0, 500), keyed(spark, 400, 600), keyed(spark, 0, 600), keyed(spark, 600, 601), keyed(spark, 5, 5))]
    assert [(c["appended"], c["known"]) for c in counts] == [(500, 0), (100, 100), (0, 600), (1, 0), (0, 0)]
    assert rows(files.read_table(spark, root, "t")) == rows(keyed(spark, 0, 601))
    assert warehouse.snapshot(spark, root).version == 3  # nothing new, no version


def test_new_keys_open_next_to_nothing(spark, folder, reads):
    root = folder("w")
    ledger.append_once(keyed(spark, 0, 20_000), root, "t", "k")
    first = warehouse.snapshot(spark, root).tables["t"]
    reads.clear()
    done = ledger.append_once(keyed(spark, 50_000, 50_060), root, "t", "k")
    assert done["folders"] == ledger.BUCKETS and len(done["opened"]) <= 8 and done["appended"] == 60
    assert not any(p.startswith(f"{root}/{path}") for p in reads for path in first.paths)  # no row stored before
    assert len([p for p in reads if "/keys/" in p]) == len(done["opened"])
    # two known keys: their buckets at most, and those hit by chance
    done = ledger.append_once(keyed(spark, 10, 12), root, "t", "k")
    assert (done["appended"], done["known"]) == (0, 2) and 1 <= len(done["opened"]) <= 4


def test_bits_hit_by_chance_are_few(spark, folder):
    root = folder("w")
    ledger.append_once(keyed(spark, 0, 30_000), root, "t", "k")
    notes = warehouse.snapshot(spark, root).tables["t"].notes
    hits = sum(bool(ledger._maybe_known(keyed(spark, i, i + 1), root, notes)) for i in range(100_000, 100_040))
    assert hits <= 5


def test_null_keys_and_repeats(spark, folder):
    root = folder("w")
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 2), (None, None, 3), (None, None, 4), ("a", 1, 5)],
                               "x string, y int, v int")
    assert ledger.append_once(df, root, "t", ["x", "y"])["appended"] == 3
    assert ledger.append_once(df, root, "t", ["x", "y"]) == {
        "appended": 0, "known": 3, "opened": ledger.append_once(df, root, "t", ["x", "y"])["opened"], "folders": 3}
    with pytest.raises(ValueError):
        ledger.append_once(df, root, "t", "x")


def test_many_appends_are_put_together(spark, folder, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_RUNS", 3)
    root = folder("w")
    for i in range(6):
        ledger.append_once(keyed(spark, i * 50, i * 50 + 60), root, "t", "k")
    assert len(warehouse.snapshot(spark, root).tables["t"].notes["runs"]) <= 3
    assert rows(files.read_table(spark, root, "t")) == rows(keyed(spark, 0, 310))


def test_ids_stay_and_are_dense(spark, folder):
    root = folder("w")
    ledger.append_once(keyed(spark, 100, 200), root, "t", "k", id_col="id")
    before = {r["k"]: r["id"] for r in files.read_table(spark, root, "t").collect()}
    for df in (keyed(spark, 0, 150), keyed(spark, 0, 300), keyed(spark, 7, 8)):
        ledger.append_once(df, root, "t", "k", id_col="id")
    after = {r["k"]: r["id"] for r in files.read_table(spark, root, "t").collect()}
    assert before.items() <= after.items() and sorted(after.values()) == list(range(1, 301))
    new = sorted((k for k in after if k not in before and int(k) < 150))
    assert [after[k] for k in new] == list(range(101, 201))


def test_a_failure_and_another_run_in_between(spark, folder, monkeypatch):
    root = folder("w")
    ledger.append_once(keyed(spark, 0, 10), root, "t", "k")
    commit = warehouse.commit

    def lost(*a, **k):
        raise OSError("lost")
    monkeypatch.setattr(warehouse, "commit", lost)
    with pytest.raises(OSError):
        ledger.append_once(keyed(spark, 5, 20), root, "t", "k")

    def late(*a, **k):
        monkeypatch.setattr(warehouse, "commit", commit)
        ledger.append_once(keyed(spark, 8, 15), root, "t", "k")  # by another run
        return commit(*a, **k)
    monkeypatch.setattr(warehouse, "commit", late)
    assert ledger.append_once(keyed(spark, 5, 20), root, "t", "k")["appended"] == 5
    assert rows(files.read_table(spark, root, "t")) == rows(keyed(spark, 0, 20))
