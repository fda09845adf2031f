"""Registry of demo queries and of the SQL each must agree with."""

from __future__ import annotations

from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(spark, sf_dir)`` under its name together with its SQL."""
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = dedent(sql).strip()
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
