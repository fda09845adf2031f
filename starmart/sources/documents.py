"""JSON documents, API payloads and HTML pages as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.columns import document_text
from starmart.functions.html import html_rows


def read_documents(spark: SparkSession, path, schema: T.StructType | None = None,
                   multiline: bool = False) -> DataFrame:
    """JSON documents; without a schema the columns are the union of all keys found."""
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def flatten_documents(df: DataFrame, as_text: bool = True) -> DataFrame:
    """Flat table with the columns in code-point order.

    As text every field is a string: timestamps in ISO form, objects and lists as JSON,
    anything missing the empty string.
    """
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    if not as_text:
        return df.select(*[F.col(f"`{f.name}`") for f in fields])
    return df.select(*[
        document_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])


def union_ragged(*dfs: DataFrame) -> DataFrame:
    """Batches under the union of their columns; a column a batch lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def explode_payload(df: DataFrame, list_field: str, status: str | None = None) -> DataFrame:
    """The records listed under a field of each payload, one row each.

    With ``status`` only payloads that were answered with 200 count.
    """
    if status is not None:
        df = df.filter(F.col(status) == 200)
    return df.select(F.inline(list_field))


def extract_html_rows(pages: DataFrame, key: str = "page_id", html: str = "html",
                      container="div", css_class: str | None = "table-container", row="tr",
                      cells=("th", "td"), sep: str = "") -> DataFrame:
    """``(key, table_no, row_no, cells)`` for each row in each container, counted from 1."""
    found = pages.select(key, F.posexplode(
        html_rows(F.col(html), container, css_class, row, cells, sep)).alias("t", "rows"))
    return found.select(key, (F.col("t") + 1).alias("table_no"),
                        F.posexplode("rows").alias("r", "cells")).select(
        key, "table_no", (F.col("r") + 1).alias("row_no"), "cells")
