"""Profiles of a table. One aggregation gives all columns at once; its single wide row is
then turned into one row per column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _per_column(df: DataFrame, cols, measures: dict, schema: str, totals: dict | None = None):
    """Aggregate ``measures`` (name → function of a column) for all columns in one pass."""
    if not cols:
        return df.sparkSession.createDataFrame([], f"column string, {schema}")
    aggs = [F.struct(F.lit(c).alias("column"),
                     *[fn(F.col(f"`{c}`")).alias(m) for m, fn in measures.items()],
                     *[e.alias(n) for n, e in (totals or {}).items()])
            for c in cols]
    return df.agg(F.array(*aggs).alias("rows")).select(F.inline("rows"))


def describe_numeric(df: DataFrame, cols=None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per numeric column."""
    measures = {
        "count": F.count,
        "mean": lambda c: F.avg(c.cast("double")),
        "stddev": lambda c: F.stddev_samp(c.cast("double")),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    return _per_column(df, cols or _numeric(df), measures,
                       "count long, mean double, stddev double, min double, max double")


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, and their share of the rows in percent (0 for an empty table)."""
    out = _per_column(df, df.columns, {"nulls": lambda c: F.count_if(c.isNull())},
                      "nulls long, rows long", {"rows": F.count("*")})
    share = F.when(F.col("rows") > 0, F.col("nulls") * 100.0 / F.col("rows")).otherwise(0.0)
    return out.select("column", "nulls", share.cast("double").alias("null_pct"))


def distinct_profile(df: DataFrame, cols=None, approx: bool = False, by_column: bool = False) -> DataFrame:
    """Distinct values per text column (or ``cols``), a null counting as one value.

    Exact form: values are grouped by column and value, first inside each task, so a value that
    fills the table is one row per task. Texts travel as the SHA-256 digest of the whole text.
    The frame is computed once for all columns. For one that is read straight from column files
    ``by_column`` makes a branch per column instead, which reads that column alone.
    ``approx`` keeps a sketch per column in a single scan and shuffles no values.
    """
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if approx or not cols:
        return _per_column(df, cols, {
            "distinct_values": lambda c: F.approx_count_distinct(c)
            + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))}, "distinct_values long")

    def value(c):
        v = F.col(f"`{c}`")
        return F.sha2(v, 256) if isinstance(df.schema[c].dataType, T.StringType) else v

    if not by_column:
        # every column's value as text; a null stays one
        entries = F.array(*[F.struct(F.lit(i).alias("i"), value(c).cast("string").alias("value"))
                            for i, c in enumerate(cols)])
        counted = (df.select(F.explode(entries).alias("e")).select("e.i", "e.value")
                   .groupBy("i", "value").agg(F.lit(1).alias("one"))
                   .groupBy("i").agg(F.count("*").alias("distinct_values")))
        names = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, column string")
        return names.join(counted, "i", "left").select(
            "column", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"))
    return reduce(DataFrame.unionByName, [
        df.groupBy(value(c).alias("value")).agg(F.lit(1).alias("one"))
        .agg(F.count("*").alias("distinct_values"))
        .select(F.lit(c).alias("column"), "distinct_values") for c in cols])


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def bounded_count(df: DataFrame, k: int = 1000) -> DataFrame:
    """Rows up to ``k``; the number is exact only below ``k``.

    Counted here and now: a few partitions first, more only while ``k`` is not reached.
    """
    n = len(df.select(F.lit(1)).head(k)) if k else 0
    return df.sparkSession.createDataFrame([(n, n < k)], "n long, is_exact boolean")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        shape(df).select(F.lit(name).alias("table_name"), "rows", "columns")
        for name, df in tables.items()])


def row_share(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table and their share of all rows in percent. The window sees one row
    per table."""
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("rows").over(everything)
    return table_counts(tables).withColumn(
        "share_pct", F.when(total > 0, F.col("rows") * 100.0 / total).otherwise(0.0)
        .cast("double"))


def distinct_keys(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Distinct values of a key in each table; a null counts as one."""
    return reduce(DataFrame.unionByName, [
        df.select(key).distinct().agg(F.count("*").alias("distinct_keys"))
        .select(F.lit(name).alias("table_name"), "distinct_keys")
        for name, df in tables.items()])


def column_measures(df: DataFrame) -> DataFrame:
    """Rows, nulls and, for numeric columns, mean, deviation and range: all columns at once."""
    numeric = set(_numeric(df))

    def number(c, fn):
        value = fn(F.col(f"`{c}`").cast("double")) if c in numeric else F.lit(None)
        return value.cast("double")

    rows = [F.struct(
        F.lit(c).alias("column"), F.count("*").alias("rows"),
        F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"),
        number(c, F.avg).alias("mean"), number(c, F.stddev_samp).alias("stddev"),
        number(c, F.min).alias("min"), number(c, F.max).alias("max"))
        for c in df.columns]
    share = F.when(F.col("rows") > 0, F.col("nulls") * 100.0 / F.col("rows")).otherwise(0.0)
    return (df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
            .withColumn("null_pct", share.cast("double")))
