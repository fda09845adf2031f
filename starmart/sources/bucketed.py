"""Tables stored in buckets by a key, so that joins and sums by that key need no shuffle.

Rows are hashed into buckets once, when they are written; each bucket is one file, and a scan knows
that a key is in one bucket only. Several tables with the same key and number of buckets are then
joined, and summed up by the key, bucket by bucket. A bucket is read by one task, which a key with
very many rows would spoil: such keys, and rows without a key, are kept aside, in files that are
split like any others. A key with more than ``HOT`` times the rows of a mean bucket is one, so there
are fewer of them than buckets, and what is summed up by key over the rows kept aside is small.

The folders are part of a warehouse version like other tables. Spark reads buckets through its catalog
only, so reading registers an external table under a name made from the folder; ``forget`` drops
these names again. The data belong to the warehouse.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources import filesystem, warehouse

HOT = 4
NAME = "starmart_buckets_"


@dataclass(frozen=True)
class Parts:
    """The rows of a table: those in buckets, and those of hot keys and without a key, if there are any."""
    even: DataFrame
    aside: DataFrame | None
    key: str

    def all(self) -> DataFrame:
        return self.even if self.aside is None else self.even.unionByName(self.aside)


def _name(place: str) -> str:
    return NAME + hashlib.sha256(place.encode()).hexdigest()[:24]


def _qualified(spark: SparkSession, path: str) -> str:
    fs, place = filesystem._at(spark, path)
    return fs.makeQualified(place).toString()


def hot_keys(df: DataFrame, key: str, buckets: int, hot: float = HOT) -> list:
    """Keys with more rows than ``hot`` mean buckets: fewer than ``buckets / hot``. Of the table only the
    key is read, and counted in each task first."""
    most = hot * df.count() / buckets
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    return [r[0] for r in counts.where(F.col("__n") > F.lit(most)).select(key).collect()]


def store(spark: SparkSession, root: str, run: str, name: str, df: DataFrame, key: str, buckets: int,
          hot: float | None = HOT) -> warehouse.Stored:
    """Write a table into buckets below the folder of a run, for ``warehouse.in_one_run``.

    ``df`` is evaluated twice and should be a stored table; with ``hot=None`` it is only once: then the
    keys are known to be unique, or nearly so, and only rows without a key go aside. One shuffle;
    every bucket is one file of rows in the order of the key. Repeated rows are kept.
    """
    keys = [] if hot is None else hot_keys(df, key, buckets, hot)
    away = F.col(key).isNull() | F.col(key).isin(keys) if keys else F.col(key).isNull()
    even, aside = f"{run}/{name}/even", f"{run}/{name}/aside"
    place = _qualified(spark, f"{root}/{even}")
    # as buckets are found by the same hash, each task has one of them
    (df.where(~away).repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", place).saveAsTable(_name(place)))
    df.where(away).write.parquet(f"{root}/{aside}")
    some = not spark.read.schema(df.schema).parquet(f"{root}/{aside}").isEmpty()
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return warehouse.Stored([even, *([aside] if some else [])], plain.json(),
                            {"key": key, "buckets": buckets, "hot": len(keys)})


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> Parts:
    """A table that ``store`` has written, its parts apart; ``warehouse.read`` gives them as one frame
    that does not know of its buckets."""
    stored = warehouse.snapshot(spark, root, version).tables[name]
    key, buckets = stored.notes["key"], stored.notes["buckets"]
    schema = T.StructType.fromJson(json.loads(stored.schema))
    place = _qualified(spark, f"{root}/{stored.paths[0]}")
    if not spark.catalog.tableExists(_name(place)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {_name(place)} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    aside = spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in stored.paths[1:]]) if stored.paths[1:] else None
    return Parts(spark.table(_name(place)), aside, key)


def attach(df: DataFrame, parts: Parts, summary: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Left join of rows in buckets to a summary with one row per key of a table in as many buckets.

    A key's rows are all in buckets or all aside, so its summary comes from one of the two. That of
    the rows aside has one row per hot key, fewer than buckets, and one without a key, so it is
    broadcast; the other needs no shuffle.
    """
    even = summary(parts.even)
    values = [c for c in even.columns if c != parts.key]
    found = df.join(even, parts.key, "left")
    if parts.aside is None:
        return found
    few = summary(parts.aside).where(F.col(parts.key).isNotNull()).select(
        parts.key, F.struct(*values).alias("__aside"))
    both = found.join(F.broadcast(few), parts.key, "left")
    hot = F.col("__aside").isNotNull()
    return both.select(*df.columns, *[F.when(hot, F.col(f"__aside.{c}")).otherwise(F.col(c)).alias(c) for c in values])


def forget(spark: SparkSession) -> int:
    """Drop the names of bucketed tables from the catalog, not their data; how many there were."""
    names = [t.name for t in spark.catalog.listTables(pattern=f"{NAME}*")]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    return len(names)
