"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than these.
WHITE = " \t\n\x0b\x0c\r"


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The frame's columns but for those that the operator is about to write."""
    written = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in written]


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few driver-side records as a frame, made from one literal."""
    data = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(data))


def text_or_empty(name: str) -> Column:
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def per_text(df: DataFrame, text_col: str, out: str, whole: Callable, by_chunks: Callable,
             chunk_chars: int, overlap: int = 0) -> DataFrame:
    """The frame with a column that depends on the text alone, where a long text is not left to
    one task.

    ``whole`` makes the value from a text of at most ``chunk_chars`` characters, null included.
    The longer texts, each different one once, are cut into chunks (columns ``digest``, ``chunk``
    and ``piece``, each piece with ``overlap`` more characters) and dealt out over tasks;
    ``by_chunks`` makes a frame of ``digest`` and ``result`` from those.
    """
    kept = [quoted(c) for c in without(df, [out])]
    length = F.coalesce(F.length(quoted(text_col)), F.lit(0))
    short = df.where(length <= chunk_chars).select(
        *kept, whole(quoted(text_col)).alias(out))
    digest, own, result = (free_name(df, f"__{x}") for x in ("digest", "own", "result"))
    long = df.where(length > chunk_chars).withColumn(digest, F.sha2(quoted(text_col), 256))
    texts = long.groupBy(F.col(digest).alias("digest")).agg(F.first(quoted(text_col)).alias("text"))
    starts = F.posexplode(F.sequence(F.lit(1), F.length("text"), F.lit(chunk_chars)))
    chunks = (texts.select("digest", "text", starts.alias("chunk", "at"))
              .select("digest", "chunk", F.substr("text", F.col("at"), F.lit(chunk_chars + overlap)).alias("piece"))
              .repartition("digest", "chunk"))
    results = by_chunks(chunks).select(F.col("digest").alias(own), F.col("result").alias(result))
    joined = long.join(results, F.col(digest) == F.col(own)).select(*kept, F.col(result).alias(out))
    return short.unionByName(joined)
