"""Distinct values out of stored sketches."""

from pyspark.sql import functions as F

from starmart.operators.profiling import distinct_profile
from starmart.sources import distinct_index


def frame(spark, low, high):
    return spark.range(low, high).select(
        "id", F.col("id").cast("string").alias("text"), (F.col("id") % 5000).cast("double").alias("num"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("few"), F.lit(None).cast("string").alias("none"),
        F.array(F.col("id") % 11).alias("list"), F.struct((F.col("id") % 13).alias("x")).alias("obj"),
        F.expr("date_add(date'2025-01-01', cast(id % 365 as int))").alias("day"))


def test_error_and_only_new_files_are_read(spark, folder, monkeypatch):
    path, index = folder("t"), folder("i")
    frame(spark, 0, 60_000).write.parquet(path)
    assert distinct_index.update(spark, path, index) > 0 and distinct_index.update(spark, path, index) == 0
    frame(spark, 40_000, 100_000).write.mode("append").parquet(path)
    before = set(spark.read.parquet(index).select("path").distinct().toPandas()["path"])
    opened = []
    inner = distinct_index.file_index.opened
    monkeypatch.setattr(distinct_index.file_index, "opened", lambda s, t, paths, k: (opened.extend(paths), inner(s, t, paths, k))[1])
    n = distinct_index.update(spark, path, index)
    places = set(map(distinct_index.file_index.place, before))
    assert len(opened) == n and not places & set(map(distinct_index.file_index.place, opened))
    whole = spark.read.parquet(path)
    plain = [c for c in whole.columns if c not in ("list", "obj")]
    exact = {r["column"]: r["distinct_values"] for r in distinct_profile(whole, plain).collect()}
    exact |= {"list": 11, "obj": 13}
    found = {r["column"]: r["distinct_values"] for r in distinct_index.estimates(spark, path, index).collect()}
    assert exact["id"] == 100_000 and list(found) == whole.columns
    assert all(abs(found[c] - n) <= 0.02 * n for c, n in exact.items())
    assert found["few"] == 8 and found["none"] == 1


def test_days_and_files_that_are_gone(spark, folder):
    path, index = folder("t"), folder("i")
    for day, low in ((1, 0), (2, 100)):
        spark.range(low, low + 150).coalesce(1).write.parquet(f"{path}/day={day}")
    distinct_index.update(spark, path, index)
    of = lambda **k: {r["column"]: r["distinct_values"] for r in distinct_index.estimates(spark, path, index, **k).collect()}
    assert of() == {"id": 250, "day": 2} and of(path_like="%day=1/%") == {"id": 150, "day": 1}
    spark.range(0, 10).coalesce(1).write.mode("overwrite").parquet(f"{path}/day=2")
    distinct_index.update(spark, path, index)
    assert of() == {"id": 150, "day": 2}
