"""The fact per vehicle, kept up batch by batch.

What the fact says of a vehicle can be put together from parts: sums and counts add up, and of the
latest positions and attributes the greater one stays. So a table of such states, in buckets by
vehicle, stands for everything that has been loaded. A batch is reduced to the same form, which
sends one row per vehicle and task, and merged with the states of the buckets it touches; the
files of the other buckets are neither read nor written, the next version of the warehouse just
names them again. Earlier batches are never read.

A batch has a number. It is kept with the states and committed with them, so a batch that is
loaded again after a failure, or twice, changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import cleaning, projection
from starmart.plans.star import COORDINATES, ID
from starmart.schemas import SCHEMAS, defaults
from starmart.sources import filesystem, warehouse

STATE, BUCKET, BUCKETS = "vehicle_state", "__bucket", 64
VEHICLE = [c for c in SCHEMAS["dim_transport"].names if c != "vehicle_id"]
POSITION = [*COORDINATES, "speed_kmh", "traffic_level"]
SUMS = ("total_passengers", "passenger_records", "total_delay_minutes", "incident_count")
STATE_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("vehicle", T.StructType([T.StructField("batch", T.LongType()), *[
        T.StructField(c, T.IntegerType() if c == "capacity" else T.StringType()) for c in VEHICLE]])),
    *[T.StructField(c, T.LongType()) for c in SUMS],
    T.StructField("position", T.StructType([
        T.StructField("timestamp", T.TimestampType()), T.StructField("tie", T.StringType()),
        *[T.StructField(c, T.StringType() if c == "traffic_level" else T.DoubleType()) for c in POSITION]])),
])


def _merged(parts: DataFrame) -> DataFrame:
    """One state per vehicle out of any number of parts."""
    return parts.groupBy("vehicle_id").agg(
        F.max("vehicle").alias("vehicle"), *[F.sum(c).alias(c) for c in SUMS], F.max("position").alias("position"))


def _part(df: DataFrame, **values: Column) -> DataFrame:
    """Rows as states in which only some of the fields say anything."""
    key = F.col("vehicle_id").cast("string").alias("vehicle_id")
    return df.select(key, *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in STATE_SCHEMA.fields[1:]])


def batch_state(batch: dict[str, DataFrame], number: int) -> DataFrame:
    """A batch in the form of states, one per vehicle that occurs in it.

    ``batch`` has some of the five inputs of the star; stops have no part in this fact. Of a vehicle's
    attributes those of the greatest batch count, and within one batch the greatest; of positions
    the latest, of equally late ones the one with the greatest id.
    """
    parts = []
    if "transport" in batch:
        own = F.struct(F.lit(number).cast("long").alias("batch"), *VEHICLE)
        parts.append(_part(batch["transport"], vehicle=own))
    if "passagers" in batch:
        parts.append(_part(batch["passagers"], total_passengers=F.col("passenger_count"), passenger_records=F.lit(1)))
    if "incident" in batch:
        parts.append(_part(batch["incident"], total_delay_minutes=F.col("delay_minutes"), incident_count=F.lit(1)))
    if "gps" in batch:
        gps = projection.parse_ts(batch["gps"], "timestamp")
        tie = F.col(ID if ID in gps.columns else "route_id").cast("string").alias("tie")
        parts.append(_part(gps, position=F.struct("timestamp", tie, *POSITION)))
    return _merged(reduce(DataFrame.unionByName, [_merged(p) for p in parts]))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("vehicle_id"), F.lit(buckets)).cast("int")


def merge(spark: SparkSession, root: str, batch: dict[str, DataFrame], number: int, buckets: int = BUCKETS,
          source: str = "load") -> dict:
    """Take a batch up into the states of the warehouse ``root``.

    Returns the ``version`` now committed, the buckets that were ``touched`` (those files of the states that
    were read and written anew) and their number ``of`` all. Every ``source`` of batches counts them
    on its own; a batch whose number is not greater than the last one's of its source has been taken
    up before: nothing is touched. A commit by another run in between is a ``warehouse.Conflict``;
    merge again then.
    """
    now = warehouse.snapshot(spark, root)
    stored = now.tables.get(STATE)
    notes = stored.notes if stored else {"last": {}, "buckets": buckets, "files": {}}
    buckets, files, last = notes["buckets"], notes["files"], notes["last"]
    if number <= last.get(source, 0):
        return {"version": now.version, "touched": [], "of": buckets}
    touched: list[int] = []

    def write(run: str) -> dict[str, warehouse.Stored]:
        # one row per vehicle of the batch; written, as its buckets have to be known first
        delta = f"{run}/delta"
        batch_state(batch, number).write.parquet(f"{root}/{delta}")
        new = spark.read.schema(STATE_SCHEMA).parquet(f"{root}/{delta}")
        touched.extend(sorted(r[0] for r in new.select(_bucket(buckets)).distinct().collect()))
        old = [f"{root}/{files[str(b)]}" for b in touched if str(b) in files]
        if old:
            new = _merged(new.unionByName(spark.read.schema(STATE_SCHEMA).parquet(*old)))
        path = f"{run}/{STATE}"
        (new.withColumn(BUCKET, _bucket(buckets)).hint("rebalance", BUCKET)
         .write.partitionBy(BUCKET).parquet(f"{root}/{path}"))
        filesystem.delete(spark, f"{root}/{delta}")
        own = {**files, **{str(b): f"{path}/{BUCKET}={b}" for b in touched}}
        return {STATE: warehouse.Stored(sorted(own.values()), STATE_SCHEMA.json(),
                                        {"last": {**last, source: number}, "buckets": buckets, "files": own})}

    version = warehouse.in_one_run(spark, root, write, base=now.version)
    return {"version": version, "touched": touched, "of": buckets}


def fact(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The fact out of the states: one row per vehicle whose attributes have been loaded. What came
    for other vehicles waits in their states."""
    states = warehouse.read(spark, root, STATE, version).where("vehicle IS NOT NULL")
    flat = states.select("vehicle_id", *[F.col(f"vehicle.{c}") for c in VEHICLE], *SUMS,
                         *[F.col(f"position.{c}") for c in POSITION])
    declared = SCHEMAS["fact_transport"]
    values = {c: v for c, v in defaults(declared).items() if c in flat.columns}
    return cleaning.fill_map(flat, values).select(*[c for c in declared.names if c in flat.columns])
