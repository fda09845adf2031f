"""Ad-hoc SQL over registered frames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from starmart.schemas import SCHEMAS
from starmart.sources import filesystem


def register(df: DataFrame, collection: str) -> str:
    """Make a frame queryable as ``table_<collection>``; returns the view name."""
    if not re.fullmatch(r"\w+", collection, re.ASCII):
        raise ValueError(f"not usable in a view name: {collection!r}")
    name = f"table_{collection}"
    df.createOrReplaceTempView(name)
    return name


def query(spark: SparkSession, sql: str, limit: int | None = None) -> DataFrame:
    out = spark.sql(sql)
    return out if limit is None else out.limit(limit)


def recreate(spark: SparkSession, names=tuple(SCHEMAS), root: str | None = None) -> None:
    """Drop the tables and create them empty, as declared.

    With ``root`` a table lives in ``<root>/<name>``, whose contents are deleted; without it in the
    warehouse, where a folder that the catalog does not know is an error.
    """
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if root is not None:
            filesystem.delete(spark, f"{root}/{name}")
        cols = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" + (" NOT NULL" if not f.nullable else "")
            for f in SCHEMAS[name].fields)
        where = "" if root is None else f" LOCATION '{root}/{name}'"
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{where}")
