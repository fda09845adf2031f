"""Types of all columns of many CSV files, found in one job.

Every value belongs to a class: boolean, int, bigint, decimal (a whole number beyond bigint), double,
date, timestamp or text; missing and empty values belong to none. The values of each file, column and
class are counted, added up in each task first, and the type of a column is the least one that holds
all classes that occur: int < bigint < decimal < double, date < timestamp, and text above
everything else. Counts add up, so the types of files that come later, or of several files
together, follow from stored counts without reading the earlier files again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources import quoted

CLASSES = ("boolean", "int", "bigint", "decimal(38,0)", "double", "date", "timestamp", "string")
NUMBERS = CLASSES[1:5]
TIMES = CLASSES[5:7]
WHOLE = "^[+-]?[0-9]+$"
REAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
#: Names of doubles that are no numbers.
NO_NUMBERS = ("NaN", "Inf", "-Inf", "Infinity", "-Infinity")
DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = "^[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2}([ T][0-9].*)?)?$"


def value_class(c: Column) -> Column:
    """The number of a text value's class in ``CLASSES``; null for missing and empty values.

    A text that looks like a date but is none (February 30) is text, and a day written with fewer digits
    a timestamp, as for Spark. Numbers with leading zeros are
    numbers, as everywhere in Spark.
    """
    n = {name: F.lit(i) for i, name in enumerate(CLASSES)}
    whole = (F.when(c.try_cast("int").isNotNull(), n["int"]).when(c.try_cast("bigint").isNotNull(), n["bigint"])
             .when(c.try_cast("decimal(38,0)").isNotNull(), n["decimal(38,0)"]).otherwise(n["double"]))
    return (F.when(c.isNull() | (c == ""), None).when(c.rlike(WHOLE), whole)
            .when(c.rlike(REAL) | c.isin(*NO_NUMBERS), n["double"])
            .when(c.rlike(DAY) & c.try_cast("date").isNotNull(), n["date"])
            .when(c.rlike(MOMENT) & c.try_cast("timestamp").isNotNull(), n["timestamp"])
            .when(F.lower(c).isin("true", "false"), n["boolean"]).otherwise(n["string"]))


def least_type(count: dict[str, Column]) -> Column:
    """The least type for the counts of classes; text where there is no value at all."""
    some = {name: F.coalesce(c, F.lit(0)) > 0 for name, c in count.items()}

    def only(names) -> Column:
        return ~reduce(Column.__or__, [some[c] for c in CLASSES if c not in names])

    def greatest(names) -> Column:
        return reduce(lambda rest, c: F.when(some[c], c).otherwise(rest), names, F.lit("string"))
    return (F.when(only(("boolean",)), greatest(("boolean",))).when(only(NUMBERS), greatest(NUMBERS))
            .when(only(TIMES), greatest(TIMES)).otherwise("string"))


def _plain_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of files whose values hold no line breaks, those at the beginning of a file numbered."""
    at = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    return spark.read.text(paths).where(F.length(F.rtrim("value")) > 0).select(
        F.col("_metadata.file_path").alias("path"), at.alias("at"), F.col("value").alias("record"))


def _quoted_records(spark: SparkSession, paths: list[str], ends: quoted.Splits) -> DataFrame:
    names = F.array(*[F.lit(f) for f in ends.files])
    return quoted.records(spark, paths, ends).select(
        F.get(names, F.col("file")).alias("path"), F.when(F.col("owner") == 0, F.col("place")).alias("at"), "record")


def class_counts(spark: SparkSession, plain: list[str], several: list[str] = (), ends: quoted.Splits | None = None,
                 width: int = 1) -> DataFrame:
    """Per file and column: how many values of each class there are.

    ``plain`` are files of one record a line, ``several`` those whose values hold line breaks, with the
    states ``ends`` of their splits; ``width`` is the greatest number of columns. Columns of the
    result: ``path``, ``position`` (from 0) and one count per class. Files without a record after the
    header have no counts above 0.
    """
    parts = []
    if plain:
        parts.append(_plain_records(spark, list(plain)))
    if several:
        parts.append(_quoted_records(spark, list(several), ends))
    rows = reduce(DataFrame.unionByName, parts)
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = rows.select("path", "at", F.from_csv("record", schema, quoted.CSV).alias("r"))
    cells = parsed.select("path", "at", F.posexplode(F.array(*[
        F.coalesce(value_class(F.col(f"r.c{i}")), F.lit(-1)) for i in range(width)])).alias("position", "kind"))
    # the header is a record like the others: it is counted with them, and taken off again
    counted = cells.groupBy("path", "position").agg(
        F.min_by("kind", "at").alias("header"),
        *[F.count_if(F.col("kind") == i).alias(c) for i, c in enumerate(CLASSES)])
    return counted.select("path", "position", *[
        (F.col(f"`{c}`") - (F.col("header") == i).cast("long")).alias(c) for i, c in enumerate(CLASSES)])


def types(counts: DataFrame, *by: str) -> DataFrame:
    """The type of each column out of stored counts, added up over all rows with equal ``by``: these,
    ``type`` and ``filled``, the number of values that are there."""
    added = counts.groupBy(*by).agg(*[F.sum(f"`{c}`").alias(c) for c in CLASSES])
    return added.select(*by, least_type({c: F.col(f"`{c}`") for c in CLASSES}).alias("type"),
                        sum((F.col(f"`{c}`") for c in CLASSES), F.lit(0)).cast("long").alias("filled"))


def typed(df: DataFrame, kinds: list[str]) -> DataFrame:
    """Text columns in their types, by position; an empty text is null in all but text columns."""
    plain = df.toDF(*[f"c{i}" for i in range(len(kinds))])
    return plain.select(*[
        (F.col(f"c{i}") if kind == "string" else F.nullif(F.trim(f"c{i}"), F.lit("")).cast(kind)).alias(name)
        for i, (name, kind) in enumerate(zip(df.columns, kinds))])
