"""The fact per vehicle out of inputs that are stored in buckets by vehicle.

The inputs are shuffled once, when they are stored. The fact can then be built as often as it is wanted,
and with other summaries, without an exchange between the scans and the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.operators import projection
from starmart.plans import star
from starmart.sources import bucketed, warehouse

KEY, INPUTS = "vehicle_id", ("transport", "passagers", "gps", "incident")


def store(spark: SparkSession, root: str, inputs: dict[str, DataFrame], buckets: int, hot: float = bucketed.HOT) -> int:
    """Store the inputs of the fact in buckets, all in one commit, whose version is returned.

    ``buckets`` should leave some 200 MB of the largest input to each. Vehicles are taken to have
    few rows in ``transport``; in the other inputs hot ones are kept aside. All rows are kept.
    """
    def write(run: str) -> dict[str, warehouse.Stored]:
        out = {}
        for name in INPUTS:
            df = inputs[name]
            if name == "gps":
                df = projection.parse_ts(df, "timestamp")
            out[name] = bucketed.store(spark, root, run, name, df, KEY, buckets, None if name == "transport" else hot)
        return out
    return warehouse.in_one_run(spark, root, write)


def fact(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The same rows as ``star.fact_summary`` of the inputs. Vehicles without an id have no summaries."""
    t = {n: bucketed.read(spark, root, n, version) for n in INPUTS}
    tie = star.ID if star.ID in t["gps"].even.columns else "route_id"
    made = star.summary_fact(star.dim_transport(t["transport"].even),
                             t["passagers"], t["gps"], t["incident"], tie, attach=bucketed.attach)
    if t["transport"].aside is None:
        return made
    nobody = {n: t[n].even.limit(0) for n in INPUTS[1:]}
    return made.unionByName(star.summary_fact(star.dim_transport(t["transport"].aside), *nobody.values(), tie))
