"""Appending each key once, without reading what has been appended before.

Beside the rows of a table in a warehouse lie its keys, a folder per run and bucket of their hash,
and for each of these a bit array with a bit set for every key (32 bits a key, so three in a
hundred unknown keys hit a set bit). An append looks its keys up in the bit arrays. A key whose bit
is not set is new for certain. Of the others the buckets that they may be in are opened, and
the keys compared exactly, nulls equal to nulls. Rows stored earlier are never read; a second load
of the same rows reads their keys, an ordinary load of new rows next to none.

After ``MOST_RUNS`` appends the keys are written together once more, so that an append has few
bit arrays to look at.

The same serves as a registry of ids: rows that are new get the numbers that follow the greatest
one given so far, and no number ever changes.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.cleaning import dedupe
from starmart.operators.keys import add_sequence
from starmart.sources import filesystem, warehouse

BUCKETS, BITS_PER_KEY, BITMAP, MOST_RUNS = 32, 32, 32_768, 8
BUCKET = "__bucket"
FILTER = "run int, bucket int, slice long, bits binary"


def _hashed(on: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in on])


def _bucket(on: list[str], buckets: int) -> Column:
    return F.pmod(_hashed(on), F.lit(buckets)).cast("int")


def _position(on: list[str], slices: Column) -> Column:
    """The bit of a key; another hash than that of its bucket."""
    return F.pmod(F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in on]), slices * BITMAP)


def _same(a: str, b: str, on: list[str]) -> Column:
    return reduce(and_, [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in on])


def _maybe_known(batch: DataFrame, root: str, notes: dict) -> list[tuple[int, int]]:
    """Runs and buckets that may hold a key of the batch: those with its bit set. There are at most
    ``MOST_RUNS`` × buckets of them."""
    spark, on = batch.sparkSession, notes["on"]
    runs = F.array(*[F.struct(F.lit(i).alias("run"), F.lit(r["slices"]).cast("long").alias("slices"))
                     for i, r in enumerate(notes["runs"])])
    asked = (batch.select(*map(_quoted, on), _bucket(on, notes["buckets"]).alias("bucket"), F.explode(runs).alias("r"))
             .select("bucket", F.col("r.run").alias("run"), _position(on, F.col("r.slices")).alias("at"))
             .select("run", "bucket", F.floor(F.col("at") / BITMAP).alias("slice"), (F.col("at") % BITMAP).alias("bit"))
             .distinct())
    filters = reduce(DataFrame.unionByName, [
        spark.read.schema("bucket int, slice long, bits binary").parquet(f"{root}/{r['path']}/filters")
        .select(F.lit(i).alias("run"), "bucket", "slice", "bits") for i, r in enumerate(notes["runs"])])
    byte = F.conv(F.hex(F.substr("bits", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(byte, cast(bit % 8 as int)) & 1") == 1
    found = asked.join(filters, ["run", "bucket", "slice"]).withColumn("byte", byte).where(hit)
    return sorted(tuple(r) for r in found.select("run", "bucket").distinct().collect())


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _write_keys(keys: DataFrame, root: str, path: str, on: list[str], buckets: int, n: int) -> dict:
    """Keys by bucket, and their bit arrays."""
    slices = max(1, -(-n * BITS_PER_KEY // (buckets * BITMAP)))
    bucketed = keys.withColumn(BUCKET, _bucket(on, buckets))
    bucketed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/{path}/keys")
    at = _position(on, F.lit(slices).cast("long"))
    (bucketed.select(F.col(BUCKET).alias("bucket"), at.alias("at"))
     .groupBy("bucket", F.floor(F.col("at") / BITMAP).alias("slice"))
     .agg(F.bitmap_construct_agg(F.col("at") % BITMAP).alias("bits")).write.parquet(f"{root}/{path}/filters"))
    present = [int(p.split("=")[1]) for p in filesystem.names(keys.sparkSession, f"{root}/{path}/keys") if "=" in p]
    return {"path": path, "slices": slices, "buckets": sorted(present)}


def append_once(df: DataFrame, root: str, name: str, on, id_col: str | None = None) -> dict:
    """Add the rows whose values of ``on`` are not in the table ``name`` of the warehouse ``root`` yet.

    Of rows of the batch with the same key one is taken. With ``id_col`` every new row gets a dense
    number in the order of its key, after those given before; the first is 1. Returns how many rows were
    ``appended`` and how many ``known``, and which folders of keys were ``opened`` out of ``folders``.
    A failure changes nothing, and the same load can simply be repeated. If another run commits in
    between, the batch is looked at again.
    """
    spark = df.sparkSession
    on = [on] if isinstance(on, str) else list(on)
    while True:
        try:
            return _append(spark, df, root, name, on, id_col)
        except warehouse.Conflict:
            continue


def _append(spark: SparkSession, df: DataFrame, root: str, name: str, on: list[str], id_col: str | None) -> dict:
    now = warehouse.snapshot(spark, root)
    stored = now.tables.get(name)
    notes = stored.notes if stored else {"on": on, "buckets": BUCKETS, "runs": [], "greatest": 0}
    if notes["on"] != on:
        raise ValueError(f"the keys of {name} are {notes['on']}, not {on}")
    folders = sum(len(r["buckets"]) for r in notes["runs"])
    done = {"appended": 0, "known": 0, "opened": [], "folders": folders}
    key_schema = T.StructType([df.schema[c] for c in on])

    def write(run: str) -> dict[str, warehouse.Stored]:
        path = f"{run}/{name}"
        rows, opened = f"{path}/rows", []
        dedupe(df, on).write.parquet(f"{root}/{rows}")
        batch = spark.read.schema(df.schema).parquet(f"{root}/{rows}")
        given = batch.count()
        if notes["runs"] and given:
            held = [set(r["buckets"]) for r in notes["runs"]]
            opened = [f"{notes['runs'][i]['path']}/keys/{BUCKET}={b}" for i, b in _maybe_known(batch, root, notes)
                      if b in held[i]]
        new, n = batch, given
        if opened:
            keys = spark.read.schema(key_schema).parquet(*[f"{root}/{p}" for p in opened])
            new = batch.alias("b").join(keys.alias("k"), _same("b", "k", on), "left_anti")
        if id_col is not None:
            new = add_sequence(new, id_col, order_by=on, start=notes["greatest"] + 1)
        schema = new.schema
        if opened or id_col is not None:  # else all rows are new, and written already
            rows = f"{path}/new"
            new.write.parquet(f"{root}/{rows}")
            filesystem.delete(spark, f"{root}/{path}/rows")
            new = spark.read.schema(schema).parquet(f"{root}/{rows}")
            n = new.count()
        done.update(appended=n, known=given - n, opened=opened)
        if not n:
            raise _Nothing
        own, runs, total = new.select(*map(_quoted, on)), notes["runs"], notes["greatest"] + n
        if len(runs) >= MOST_RUNS:
            before = [f"{root}/{r['path']}/keys/{BUCKET}={b}" for r in runs for b in r["buckets"]]
            own = own.unionByName(spark.read.schema(key_schema).parquet(*before))
            entry = [_write_keys(own, root, path, on, notes["buckets"], total)]
        else:
            entry = [*runs, _write_keys(own, root, path, on, notes["buckets"], n)]
        paths = [*(stored.paths if stored else []), rows]
        return {name: warehouse.Stored(paths, schema.json(), {**notes, "runs": entry, "greatest": total})}

    try:
        warehouse.in_one_run(spark, root, write, base=now.version)
    except _Nothing:
        pass
    return done


class _Nothing(Exception):
    """There is nothing new; nothing is committed."""
