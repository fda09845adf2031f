"""All tables of a version or all of another, whatever fails."""

import os

import pytest
from pyspark.sql import functions as F

from starmart.plans import star
from starmart.sources import files, filesystem, warehouse


def tables(spark, value, broken=None):
    """Three tables without a declaration; one of them may fail in the middle."""
    out = {}
    for name in ("a", "b", "c"):
        x = F.raise_error(F.lit("broken on purpose")).cast("long") if name == broken else F.lit(value)
        out[name] = spark.range(50).select("id", F.when(F.col("id") < 40, F.lit(value)).otherwise(x).cast("long").alias("v"))
    return out


def seen(spark, root):
    return {n: {r["v"] for r in files.read_table(spark, root, n).select("v").distinct().collect()} for n in ("a", "b", "c")}


@pytest.fixture
def root(spark, folder):
    star.publish(tables(spark, 1), folder("w"))
    return folder("w")


@pytest.mark.parametrize("broken", ["a", "b", "c"])
def test_a_table_that_fails_changes_nothing(spark, root, broken):
    before = set(os.listdir(f"{root}/data"))
    with pytest.raises(Exception, match="broken on purpose"):
        star.publish(tables(spark, 2, broken), root)
    assert seen(spark, root) == {n: {1} for n in "abc"}
    assert set(os.listdir(f"{root}/data")) == before
    star.publish(tables(spark, 3), root)
    assert seen(spark, root) == {n: {3} for n in "abc"}


@pytest.mark.parametrize("step", ["count", "draft", "rename"])
def test_a_step_that_fails_changes_nothing(spark, root, monkeypatch, step):
    def fail(*_, **__):
        raise OSError("lost")
    if step == "count":
        monkeypatch.setattr(warehouse.Stored, "read", fail)
    elif step == "draft":
        monkeypatch.setattr(filesystem, "put_if_absent", fail)
    else:
        # the driver dies with its draft written and nothing tidied up
        monkeypatch.setattr(filesystem, "put_if_absent", lambda spark, path, text: fail(
            open(f"{os.path.dirname(path)}/.draft-x", "w").write(text[:20])))
        monkeypatch.setattr(filesystem, "delete", lambda *_: True)
    with pytest.raises(OSError):
        star.publish(tables(spark, 2), root)
    monkeypatch.undo()
    assert seen(spark, root) == {n: {1} for n in "abc"} and warehouse.snapshot(spark, root).version == 1
    star.publish(tables(spark, 3), root)
    assert seen(spark, root) == {n: {3} for n in "abc"} and warehouse.snapshot(spark, root).version == 2


def test_a_reader_keeps_its_version(spark, root):
    old = files.read_table(spark, root, "a")
    star.publish({"a": tables(spark, 2)["a"]}, root)
    assert {r["v"] for r in old.collect()} == {1}
    assert seen(spark, root) == {"a": {2}, "b": {1}, "c": {1}}
    assert {r["v"] for r in warehouse.read(spark, root, "a", version=1).collect()} == {1}


def test_each_table_is_computed_once(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b
    df = spark.range(1000).repartition(3).mapInArrow(counted, "id long")
    report = star.publish({"n": df}, folder("w")).first()
    assert calls.value == 1000 and tuple(report) == ("n", 1000, 1000, 0)


def test_two_runs_from_one_version(spark, root):
    base = warehouse.snapshot(spark, root).version
    own = warehouse.snapshot(spark, root).tables
    warehouse.commit(spark, root, {"a": own["b"]}, base)
    with pytest.raises(warehouse.Conflict):
        warehouse.commit(spark, root, {"b": own["a"]}, base)
    # a run that replaces whatever is there goes on top of a commit it has not seen
    first = filesystem.put_if_absent

    def late(spark, path, text):
        filesystem.put_if_absent = first
        warehouse.commit(spark, root, {"d": own["c"]})
        return first(spark, path, text)
    filesystem.put_if_absent = late
    try:
        assert warehouse.commit(spark, root, {"e": own["c"]}) == base + 3
    finally:
        filesystem.put_if_absent = first
    assert set(warehouse.snapshot(spark, root).tables) == {*"abcde", "quarantine"}


def test_put_if_absent(spark, folder):
    os.makedirs(folder("x"))
    path = folder("x/1.json")
    assert filesystem.put_if_absent(spark, path, "first ü") and not filesystem.put_if_absent(spark, path, "second")
    assert filesystem.read_text(spark, path) == "first ü"
    assert [n for n in os.listdir(folder("x")) if not n.startswith(".")] == ["1.json"]


def test_empty_tables_and_vacuum(spark, root):
    star.publish({"a": tables(spark, 2)["a"].limit(0)}, root)
    empty = files.read_table(spark, root, "a")
    assert empty.count() == 0 and empty.columns == ["id", "v"]
    assert warehouse.vacuum(spark, root) == 1
    assert files.read_table(spark, root, "b").count() == 50
    with pytest.raises(KeyError):
        files.read_table(spark, root, "nothing")
