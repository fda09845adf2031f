"""Relational tables over JDBC. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.session import materialise


def read_options(opts: dict[str, str], table: str, partition=None) -> dict[str, str]:
    """Reader options. ``partition`` is (column, lower, upper, number of tasks): without it
    the whole table comes through a single connection. The bounds only place the cuts;
    rows outside them are read as well."""
    out = {**opts, "dbtable": table}
    if partition:
        col, lower, upper, n = partition
        out |= {"partitionColumn": col, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(n)}
    return out


def write_options(opts: dict[str, str], table: str, batchsize: int = 1000,
                  truncate: bool = True, connections: int = 8) -> dict[str, str]:
    """Writer options. ``truncate`` empties an overwritten table instead of dropping it, so
    its declared keys and types stay. No more than ``connections`` tasks write at a time."""
    return {**opts, "dbtable": table, "batchsize": str(batchsize),
            "truncate": str(truncate).lower(), "numPartitions": str(connections)}


def read_jdbc(spark: SparkSession, opts: dict[str, str], table: str, partition=None) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(opts, table, partition)).load()


def write_jdbc(df: DataFrame, opts: dict[str, str], table: str, mode: str = "overwrite",
               batchsize: int = 1000, truncate: bool = True) -> None:
    (df.write.format("jdbc").options(**write_options(opts, table, batchsize, truncate))
     .mode(mode).save())


def count_rows(spark: SparkSession, opts: dict[str, str], table: str) -> int:
    """Rows of a table, counted by the database."""
    counted = {**opts, "dbtable": f"(SELECT count(*) AS n FROM {table}) q"}
    return int(spark.read.format("jdbc").options(**counted).load().first()[0])


def load_jdbc(df: DataFrame, opts: dict[str, str], table: str, batchsize: int = 1000,
              swap: Callable[[str, str], None] | None = None) -> DataFrame:
    """Insert into an existing table in batches and report rows sent and found.

    A JDBC write is one transaction per task, not one for the table. For all or nothing,
    give ``swap(staging, table)``: the rows go to ``<table>_staging``, are counted there,
    and only a complete staging table is handed to ``swap``, which puts it in place in one
    transaction of its own. A table that is missing fails before anything is written; an
    empty frame writes nothing. The frame is computed once and written to the scratch folder
    first, so what is counted is what is sent. Without ``swap`` the rows found are the growth of
    the table, which is theirs only while nobody else writes to it.
    """
    spark = df.sparkSession
    before = count_rows(spark, opts, table)  # fails if there is no table
    df = materialise(df, "jdbc")
    sent = df.count()

    def report(loaded: int) -> DataFrame:
        return spark.createDataFrame([(table, sent, loaded, sent == loaded)],
                                     "table_name string, sent long, loaded long, ok boolean")
    if not sent:
        return report(0)
    if swap is None:
        write_jdbc(df, opts, table, "append", batchsize)
        return report(count_rows(spark, opts, table) - before)
    staging = f"{table}_staging"
    write_jdbc(df, opts, staging, "overwrite", batchsize)
    if count_rows(spark, opts, staging) != sent:
        raise RuntimeError(f"{staging} is incomplete, {table} was left as it was")
    swap(staging, table)
    return report(count_rows(spark, opts, table))
