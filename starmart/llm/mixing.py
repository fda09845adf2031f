"""Mixing sources to target weights by Poisson replication.

A source with weight w of the sum W is to fill w / W of the mixture. Divided by what the source
holds, that is its repetition rate, and each of its documents appears a Poisson-distributed
number of times with that mean. The number comes from inverting the distribution at a point
between 0 and 1 that a hash of seed and document gives: the same document always gets the same
number, on any machine and after any loss, and no document needs to know of another one.

Rates over ``MAX_RATE`` are divided into equal blocks, each with a point of its own: a sum of
Poisson variables is one again, and the table that is searched stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import free_name, quoted, small_table, text_or_empty, without
from starmart.session import materialise

OUTPUT = ("repetitions", "copy", "position_key")
MAX_RATE = 64
#: The table of one rate goes on to this many terms; beyond, less than 1e-15 is left.
TERMS = 200
#: Up to so many sources, their rates are sent to every executor (a table of under 40 MB).
BROADCAST_SOURCES = 20_000


def repetition_rates(df: DataFrame, weights: dict | None, source_col: str, size_col: str | None,
                     target: float | None) -> DataFrame:
    """One row per source: its size, its rate, the rate of a block and the number of blocks."""
    size = F.lit(1) if size_col is None else F.coalesce(quoted(size_col), F.lit(0))
    sizes = df.groupBy(quoted(source_col).alias("source")).agg(F.sum(size).cast("double").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = small_table(df.sparkSession, [{"source": k, "weight": float(w)}
                                              for k, w in weights.items()], "source string, weight double")
        sizes = (sizes.join(F.broadcast(given), sizes["source"].eqNullSafe(given["source"]), "left")
                 .select(sizes["source"], "size", F.coalesce("weight", F.lit(0.0)).alias("weight")))
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, F.col("weight")).otherwise(0.0))
    sums = sizes.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    whole = F.col("all_size") if target is None else F.lit(float(target))
    # one row; a condition makes the join an ordinary outer one
    rated = sizes.join(F.broadcast(sums), F.col("all_weight") > 0, "left").select(
        "source", "size", F.when((F.col("size") > 0) & (F.col("weight") > 0),
                                 whole * F.col("weight") / F.col("all_weight") / F.col("size"))
        .otherwise(0.0).alias("rate"))
    return (rated.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_RATE)).cast("long"))
            .withColumn("block_rate", F.col("rate") / F.col("blocks")))


def _cumulated(rate):
    """Poisson probabilities summed up to 0, 1, 2, …: what the point is compared with."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def step(s, n):
        p = s["p"] * rate / n
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"),
                        F.concat(s["all"], F.array(s["c"] + p)).alias("all"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step)["all"]


def _point(name):
    """A number from 0 up to 1 out of 52 bits of the name's MD5."""
    digits = F.substring(F.md5(F.encode(name, "utf-8")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(df: DataFrame, weights: dict | None = None, source_col: str = "source", id_col: str = "doc_id",
        text_col: str = "text", size_col: str | None = None, target: float | None = None,
        seed: int = 17) -> DataFrame:
    """The mixture: each document ``repetitions`` times, numbered by ``copy`` from 1, in random order.

    ``weights``: by source; a source that is not named gets none, ``None`` stands for documents
    without a source. Without weights all sources get the same share. ``size_col``: what is
    weighed, for example a column of lengths; without it, documents. ``target``: size of the
    mixture; without it, that of the input. So the expected size of a source in the mixture is
    target × weight / sum of weights; a source without size or weight gives nothing.

    The result is sorted by ``position_key``, a hash over the whole mixture; partitions and the
    rows in them are in that order. Rows equal in id and text get the same number of copies. A
    null id or text counts as empty text. An empty table gives an empty result. Input columns
    with the name of an output column are replaced.
    """
    kept = without(df, OUTPUT)
    spark = df.sparkSession
    rates = materialise(repetition_rates(df, weights, source_col, size_col, target)
                        .where("rate > 0").withColumn("cumulated", _cumulated(F.col("block_rate"))), "rates")
    names = {c: free_name(df, f"__{c}") for c in rates.columns}
    rates = rates.withColumnsRenamed(names)
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    name, block, n = (free_name(df, f"__{x}") for x in ("doc", "block", "n"))
    rate = {c: F.col(names[c]) for c in names}
    named = (df.join(rates, quoted(source_col).eqNullSafe(rate["source"]))
             .withColumn(name, F.concat_ws("|", F.lit(str(seed)), text_or_empty(id_col),
                                           F.md5(F.encode(text_or_empty(text_col), "utf-8")))))
    points = F.transform(F.sequence(F.lit(1).cast("long"), rate["blocks"]),
                         lambda b: _point(F.concat_ws("|", F.col(name), b.cast("string"))))
    drawn = named.withColumn(n, F.aggregate(points, F.lit(0).cast("long"), lambda total, p: total + F.size(
        F.filter(rate["cumulated"], lambda c: c <= p))))
    copies = drawn.withColumn(block, F.explode(
        F.when(F.col(n) > 0, F.sequence(F.lit(1).cast("long"), F.col(n)))))
    return (copies.select(*map(quoted, kept), F.col(n).alias("repetitions"), F.col(block).alias("copy"),
                          F.xxhash64(F.col(name), F.col(block)).alias("position_key"))
            .orderBy("position_key"))
