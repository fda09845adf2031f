"""Dense numbering at scale, and cyclic assignment built on it.

A global ``row_number`` sorts the whole table in one task. Here the table is sorted by
range over all tasks and written once, each row with the number of its sorted partition
and its place in it. Counting the written rows per partition gives the number of rows
before each partition, and

    id = rows before the partition + place in the partition.

That is one shuffle, one write and no window. The written places are final: a task that
is run again, or a later query on the result, sees the same ids. The driver holds one
counter per partition, nothing that grows with the rows.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import materialise

# monotonically_increasing_id: partition number above bit 33, place in the partition below.
PLACE_BITS = 33
#: So many keys may come to the driver to be numbered there.
FEW = 10_000


def _number(df: DataFrame, name: str, order_by, start: int) -> tuple[DataFrame, int]:
    """The frame with a dense long column, and its number of rows."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    placed = materialise(
        df.orderBy(*order_by).withColumn("__pos", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__pos", PLACE_BITS)
    sizes = dict(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    parts = sorted(sizes)
    before = [0, *accumulate(sizes[p] for p in parts)]
    offsets = df.sparkSession.createDataFrame(
        list(zip(parts, before)), "__part long, __before long")
    place = F.col("__pos").bitwiseAND((1 << PLACE_BITS) - 1)
    numbered = (placed.withColumn("__part", part)
                .join(F.broadcast(offsets), "__part")  # one row per sorted partition
                .select(*df.columns, (F.col("__before") + place + start).alias(name)))
    return numbered, before[-1]


def add_sequence(df: DataFrame, name: str, prefix: str = "", order_by=(),
                 start: int = 1) -> DataFrame:
    """Dense ids ``start, start+1, …`` in the order of ``order_by``, as text behind ``prefix``
    or as long without one.

    ``order_by`` must identify a row; then the ids depend on the data alone, not on how
    it is partitioned.
    """
    out, _ = _number(df, name, order_by, start)
    if not prefix:
        return out
    return out.withColumn(name, F.concat(F.lit(prefix), F.col(name).cast("string")))


def assign_round_robin(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                       out: str | None = None) -> DataFrame:
    """Give the i-th row of ``left`` the (i mod n)-th of the n distinct keys of ``right``.

    Both sides are numbered by key, then joined on the remainder: an equi-join in which
    every key of ``right`` meets the same number of rows, give or take one. Rows of one
    ``left_key`` follow in the order of their other columns, so the result repeats.

    Where ``left`` has fewer rows than there are takers, only the first as many of these can be
    hit; up to ``FEW`` they are picked by a top-k, and the others are never sorted or written.
    """
    out = out or right_key
    takers = right.select(F.col(right_key).alias(out)).filter(F.col(out).isNotNull()).distinct()
    left = left.drop(out)
    order = [left_key, *[f.name for f in left.schema.fields if f.name != left_key
                         and not isinstance(f.dataType, (T.MapType, T.VariantType))]]
    rows, m = _number(left, "__idx", order, 0)
    if m <= FEW:
        first = [r[0] for r in takers.orderBy(out).limit(m).collect()]  # at most FEW keys
        n = len(first)
        if n == m:  # no remainder is needed
            takers = takers.sparkSession.createDataFrame(
                list(enumerate(first)), T.StructType([T.StructField("__slot", T.LongType()), takers.schema[out]]))
        else:
            takers, n = _number(takers, "__slot", out, 0)
    else:
        takers, n = _number(takers, "__slot", out, 0)
    if n == 0:
        return rows.drop("__idx").withColumn(out, F.lit(None).cast(takers.schema[out].dataType))
    slotted = rows.withColumn("__slot", F.col("__idx") % n).drop("__idx")
    return slotted.join(takers, "__slot", "left").drop("__slot")
