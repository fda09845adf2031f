"""What indexes kept per file share: which files a table has, and reading some of them."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmart.sources import filesystem


def place(path: str) -> str:
    """A file's path as one name, however the scheme before it is written."""
    return unquote(urlparse(path).path)


def stored(spark: SparkSession, index: str, schema: str) -> DataFrame:
    """The rows of an index, none if there is no such folder yet."""
    if not filesystem.exists(spark, index):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(index)


def known(rows: DataFrame) -> set[str]:
    """Files that an index has rows of; one name per file comes to the driver."""
    return {place(r[0]) for r in rows.select("path").distinct().collect()}


def opened(spark: SparkSession, table: str, paths: list[str], schema: T.StructType) -> DataFrame:
    """Some files of a Parquet folder, with the columns of its partitions."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*[unquote(p) for p in paths])
