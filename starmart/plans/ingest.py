"""Landing extracts as canonical CSV, and the catalogue of operators from scraped pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.operators.keys import add_sequence
from starmart.schemas import OPERATOR_HEADERS
from starmart.session import together
from starmart.sources.documents import extract_html_rows, flatten_documents
from starmart.sources.files import load_directory
from starmart.sources.sinks import save


#: So many copies of a row get their numbers in one task.
BLOCK = 10_000


def as_documents(df: DataFrame) -> DataFrame:
    """Rows with a unique technical ``_id`` made from their content: 24 hexadecimal digits of a
    digest of all fields and, among equal rows, of their number. The ids do not depend on how
    the files are split. Equal rows are counted per task first; where there are more than a ``BLOCK``
    of them, their numbers are dealt out in blocks, so that no task has all of them.
    """
    if "_id" in df.columns:
        return df
    columns = [F.col(f"`{c}`") for c in df.columns]
    one, n, first = F.lit(1).cast("long"), F.col("__n"), F.col("__first")
    counted = df.groupBy(*columns).agg(F.count("*").alias("__n"))
    few = counted.where(n <= BLOCK).select(*columns, F.explode(F.sequence(one, n)).alias("__n"))
    many = (counted.where(n > BLOCK).withColumn("__first", F.explode(F.sequence(one, n, F.lit(BLOCK).cast("long"))))
            .repartition("__first", "__n"))
    numbered = few.unionByName(many.select(
        *columns, F.explode(F.sequence(first, F.least(n, first + BLOCK - 1))).alias("__n")))
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return numbered.select(*columns, F.substring(F.sha2(F.concat_ws("|", "__n", content), 256), 1, 24).alias("_id"))


def ingest(spark: SparkSession, directory: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Every CSV of a directory → documents → one canonical CSV per collection below ``out``:
    all fields text, columns in code-point order, missing values empty.

    Returns the export report and the per-file load report. Several collections are written at a time.
    """
    datasets, loaded = load_directory(spark, directory)

    def export(name: str) -> tuple[str, int, bool]:
        seen = Observation()
        save(flatten_documents(as_documents(datasets[name])).observe(seen, F.count("*").alias("n")), f"{out}/{name}",
             "csv", empty_as_null=True)
        return name, seen.get["n"], seen.get["n"] > 0
    counts = together(spark, export, datasets)
    return spark.createDataFrame(counts, "collection string, documents long, exported boolean"), loaded


def build_operators(pages: DataFrame, headers: dict[str, str] = OPERATOR_HEADERS,
                    **layout) -> DataFrame:
    """Numbered table of the rows scraped from pages, in page, table and row order.

    Cells are taken in the order of ``headers``; rows repeating the headers are dropped,
    and a cell a row does not have is null.
    """
    found = extract_html_rows(pages, **layout)
    titles = F.array(*[F.lit(h) for h in headers])
    rows = found.filter(F.col("cells") != titles).select(
        *[c for c in found.columns if c != "cells"],
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(headers.values())])
    order = [c for c in found.columns if c != "cells"]
    numbered = add_sequence(rows, "id", order_by=order)
    return numbered.select("id", *headers.values())


