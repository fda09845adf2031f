"""Reports on the mart, each a DataFrame (or a few) instead of printed text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators import aggregates, joins, profiling, quality


def profile(df: DataFrame, approx: bool = False, stored: bool = False) -> DataFrame:
    """One row per column: type, rows, nulls and their share, distinct values of text
    columns, and count, mean, deviation and range of numeric ones. ``stored`` says that the frame is
    a table of column files, whose columns can be read one by one."""
    types = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column string, type string")
    measures = profiling.column_measures(df)
    distinct = profiling.distinct_profile(df, approx=approx, by_column=stored)
    return (types.join(measures, "column", "left").join(distinct, "column", "left")
            .orderBy("position"))


def relationship_report(star: dict[str, DataFrame]) -> DataFrame:
    """Distinct vehicles and stops per table, set against the dimension that owns them."""
    vehicles = {n: star[n] for n in
                ("dim_transport", "dim_passager", "dim_incident", "fact_transport")}
    stops = {n: star[n] for n in ("dim_stop", "dim_passager")}
    out = joins.relationships(vehicles, "vehicle_id", "dim_transport").select(
        F.lit("vehicle_id").alias("key"), "*")
    return out.unionByName(joins.relationships(stops, "stop_id", "dim_stop").select(
        F.lit("stop_id").alias("key"), "*"))


def kpis(fact: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Vehicles by type, largest companies, capacity statistics, totals.

    Each of the four reads the fact: give the published table, not one still to be computed.
    """
    return {
        "by_type": aggregates.frequencies(fact, "type_transport"),
        "top_companies": aggregates.top_k(fact, "company_name", k),
        "capacity": profiling.describe_numeric(fact, ["capacity"]),
        "totals": aggregates.global_kpis(fact),
    }


def warehouse_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and share of all rows per table."""
    return profiling.row_share(tables)


def quality_report(star: dict[str, DataFrame]) -> DataFrame:
    """What stands against publishing: per table and column the keys that are repeated or
    missing (``key``), the values that do not fit (``fit``), and the keys that refer to nothing
    (``reference``). Lines without findings are there too.

    Each table is read once for its keys and types, and once for all its references; frames that
    are costly to compute should be materialised before.
    """
    order = ["check", "table_name", "column", "findings"]
    parts = []
    for name, df in star.items():
        if name not in schemas.SCHEMAS:
            continue
        found = quality.key_and_fit(df, schemas.SCHEMAS[name])
        parts.append(found.select("check", F.lit(name).alias("table_name"), "column", "findings"))
    references = [r for r in schemas.FOREIGN_KEYS if r[0] in star and r[2] in star]
    if references:
        parts.append(quality.check_references(star, references).select(F.lit("reference").alias("check"), "*"))
    return reduce(DataFrame.unionByName, [p.select(order) for p in parts])


def domain_report(star: dict[str, DataFrame]) -> DataFrame:
    """Rows outside the domains the extracts are expected to stay within (``domain``), and
    vehicles that are said to be at several places at once (``unique``)."""
    parts = []
    for name, df in star.items():
        rules = {c: ok for c, ok in schemas.domain_rules(name).items() if c in df.columns}
        if rules:
            parts.append(quality.check_domain(df, rules).select(
                F.lit("domain").alias("check"), F.lit(name).alias("table_name"),
                F.col("rule").alias("column"), F.col("violations").alias("findings")))
    if "dim_gps" in star:
        pair = ["vehicle_id", "timestamp"]
        parts.append(quality.check_unique(star["dim_gps"], pair).agg(F.count("*").alias("findings")).select(
            F.lit("unique").alias("check"), F.lit("dim_gps").alias("table_name"),
            F.lit(", ".join(pair)).alias("column"), "findings"))
    return reduce(DataFrame.unionByName, parts)
