"""File sinks. Every task writes its own part; nothing is gathered on the driver."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.cleaning import dedupe


def write_table(df: DataFrame, root: str, name: str, partition_by=()) -> None:
    """Replace the Parquet directory of a table, split into folders by ``partition_by``.

    Rows are first brought together by folder, or every task would leave a small file in
    each; adaptive execution cuts a folder that holds much of the data into several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{name}")


def save(df: DataFrame, path: str, fmt: str, empty_as_null: bool = False) -> None:
    """Replace ``path`` with the frame as ``csv`` (header, quotes doubled), ``text`` (comma
    separated, no header), ``json`` (lines; null fields left out) or ``parquet``.

    In csv and text an empty string is written as ``""`` and a null as nothing; with
    ``empty_as_null`` both as nothing. Spark reads either back as null, other readers may not.
    """
    writer = df.write.mode("overwrite")
    fmt = fmt.lower()
    if fmt in ("csv", "text"):
        (writer.option("header", fmt == "csv").option("escape", '"')
         .option("emptyValue", "" if empty_as_null else '""').csv(path))
    elif fmt == "json":
        writer.json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"format not supported: {fmt}")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append(df: DataFrame, path: str, dedupe_on=None) -> None:
    """Add rows to a Parquet directory.

    Plain append repeats the rows when a load is repeated. With ``dedupe_on`` only rows
    whose values of those columns (null equal to null) are not stored yet are added.
    """
    if dedupe_on is not None:
        df = dedupe(df, dedupe_on)
        stored = _existing(df.sparkSession, path)
        if stored is not None:
            s, d = stored.select(*dedupe_on).alias("s"), df.alias("d")
            same = reduce(and_, [F.col(f"d.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
                                 for c in dedupe_on])
            df = d.join(s, same, "left_anti")
    df.write.mode("append").parquet(path)


def export_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per collection its documents and whether it was exported (empty ones are not)."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("documents")).select(
            F.lit(n).alias("collection"), "documents",
            (F.col("documents") > 0).alias("exported"))
        for n, df in tables.items()])


def export_totals(report: DataFrame) -> DataFrame:
    """Collections exported, collections in all, documents in all."""
    return report.agg(F.count_if("exported").alias("exported"),
                      F.count("*").alias("collections"),
                      F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"))
