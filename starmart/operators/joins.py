"""Joins of the mart. All are equi-joins without size hints: adaptive execution sees the
real size of each side and picks broadcast or sort-merge, and splits a hot partition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, other: DataFrame, key) -> DataFrame:
    """Left join to a frame with one row per key."""
    return df.join(other, key, "left")


def attach_many(parent: DataFrame, child: DataFrame, key: str,
                child_keys: DataFrame | None = None) -> DataFrame:
    """Left join to a frame with any number of rows per key.

    Written as matching rows plus childless parents. A left outer join cannot split the
    right side, so a key holding a third of the children would land in one task; in the
    inner join the children are on the left and can be split. ``child_keys`` is a cheaper
    way to the keys of ``child`` than the child itself.
    """
    matched = child.join(parent, key)
    present = (child if child_keys is None else child_keys).select(key).distinct()
    childless = parent.join(present, key, "left_anti")
    order = [*parent.columns, *[c for c in child.columns if c not in parent.columns]]
    return matched.unionByName(childless, allowMissingColumns=True).select(*order)


def vehicle_stops(df: DataFrame, k1: str, k2: str) -> DataFrame:
    """Distinct pairs that link two keys: the bridge of ``bridge_join``."""
    return df.select(k1, k2).distinct()


def bridge_join(df: DataFrame, bridge: DataFrame, dim: DataFrame, k1: str, k2: str,
                fan_out: bool = False) -> DataFrame:
    """Rows → linked keys → their details, through a bridge of distinct ``(k1, k2)`` pairs.

    The bridge is looked up first (one row of ``dim`` per ``k2``), then attached to the
    rows by ``k1``. ``df`` must have one row per ``k1``; then the result is as long as the
    bridge, plus the rows without a link. Several rows per ``k1`` would come out once for each
    link, so the job that computes the result fails unless ``fan_out`` says that it is wanted. The
    rows are counted in that job, beside the joins; nothing runs while the plan is built.
    """
    pairs = bridge.select(k1, k2).distinct()
    out = attach_many(df, pairs.join(dim, k2, "left"), k1, child_keys=pairs)
    return out if fan_out else out.unionByName(_none_if_unique(df, k1, out))


def _none_if_unique(df: DataFrame, key: str, like: DataFrame) -> DataFrame:
    """No rows, in the columns of another frame; an error if a key occurs twice."""
    wrong = F.raise_error(F.lit(f"{key} is repeated: reduce the rows to one per {key} first")).cast("boolean")
    seen = df.groupBy(key).agg(F.count("*").alias("__n"))
    none = seen.where(F.when(F.col("__n") > 1, wrong).otherwise(F.lit(False)))
    return none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema])


def stop_passager_bridge(stops: DataFrame, passagers: DataFrame,
                         unique_ids: bool = False) -> DataFrame:
    """Every stop with the ids of the passenger records made there; unused stops once.

    ``unique_ids`` says that no passager_id occurs twice, which saves the shuffle that
    would look for repeated pairs.
    """
    pairs = passagers.select("passager_id", "stop_id").filter(F.col("stop_id").isNotNull())
    if not unique_ids:
        pairs = pairs.distinct()
    return attach_many(stops.drop("passager_id"), pairs, "stop_id")


def relationships(tables: dict[str, DataFrame], key: str, parent: str) -> DataFrame:
    """Per table: distinct keys (null counts as one), how many of them ``parent`` has too,
    and how many it lacks.

    All key columns are tagged with their table and grouped by key once; each task first
    reduces its keys, so a frequent one costs no more than a rare one.
    """
    tagged = reduce(DataFrame.unionByName, [
        df.select(F.col(key).alias("k"), F.lit(name).alias("t")) for name, df in tables.items()])
    names = list(tables)
    seen = tagged.groupBy("k").agg(*[
        F.max(F.when(F.col("t") == n, 1)).alias(f"in_{i}") for i, n in enumerate(names)])
    known = F.col(f"in_{names.index(parent)}").isNotNull()
    real = F.col("k").isNotNull()
    return seen.agg(F.array(*[
        F.struct(
            F.lit(n).alias("table_name"),
            F.count(f"in_{i}").alias("distinct_keys"),
            F.count(F.when(real & known, F.col(f"in_{i}"))).alias("in_parent"),
            F.count(F.when(real & ~known, F.col(f"in_{i}"))).alias("orphans"))
        for i, n in enumerate(names)]).alias("rows")).select(F.inline("rows"))
