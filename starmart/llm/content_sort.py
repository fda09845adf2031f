"""Exact deduplication by sorting the texts.

The rows are put in the order of their texts' bytes and cut into ranges of about equal bytes: a
sample gives the splitters, one exchange brings every row to its range, and each range is sorted
there (Spark's sort goes to disk where memory ends). Equal texts then lie side by side, and a row
begins a new group where its whole text differs from its neighbour's.

The order is (first ``HEAD`` bytes, digest of the whole text, text, place of the row). So a
splitter has a bounded size however long the texts are, texts that begin alike are still told
apart, and a splitter can fall inside a group of copies: one that holds a third of all rows is
spread over a third of the ranges. A group that goes over the edge of a range shows in the first or
the last group of the ranges it touches; these, at most two a range, are put together by their
digest and joined back, so nothing that grows with a group meets in one task.

Only built-in functions run on the executors.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import free_name, quoted, text_or_empty, without
from starmart.session import materialise

OUTPUT = ("keep_id", "group_size", "kept", "text_sha256")
HEAD = 32
#: What a row counts besides its text when ranges are made equal.
ROW_BYTES = 64
#: So many ranges at most, which bounds the splitters and the sample; beyond, the ranges grow.
MOST_RANGES = 20_000
KEY = "struct<head:string,digest:string,place:bigint>"


def splitters(keys: DataFrame, range_bytes: int, per_range: int) -> list[dict]:
    """Keys that cut the order into ranges of equal bytes: as many as there are shuffle partitions,
    more if a range would then hold over ``range_bytes``, and ``MOST_RANGES`` at most.

    ``keys`` has ``head``, ``digest``, ``place`` and ``size``. On average ``per_range`` rows a range
    come to the driver, each of a bounded size, and all rows are equally likely to.
    """
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MOST_RANGES, max(tasks, -(-(total or 0) // range_bytes)))
    if not rows or ranges < 2:
        return []
    share = min(1.0, per_range * ranges / rows)
    sample = sorted(keys.sample(share, 7).collect(), key=lambda r: (r["head"], r["digest"], r["place"]))
    step = sum(r["size"] for r in sample) / ranges
    out, held, wanted = [], 0, step
    for r in sample:
        held += r["size"]
        if held >= wanted and len(out) < ranges - 1:
            out.append({k: r[k] for k in ("head", "digest", "place")})
            wanted = (held // step + 1) * step
    return [s for i, s in enumerate(out) if i == 0 or s != out[i - 1]]


def range_of(key: Column, cuts: list[dict]) -> Column:
    """How many of the sorted ``cuts`` are not above the key, found by way of a coarser list."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]

    def literal(value, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(value)), kind)
    coarse = F.size(F.filter(literal([b[0] for b in blocks], f"array<{KEY}>"), lambda c: c <= key))
    block = F.get(literal(blocks, f"array<array<{KEY}>>"), F.greatest(coarse - 1, F.lit(0)))
    inside = F.size(F.filter(block, lambda c: c <= key))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + inside)


def with_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                drop_text: bool = False, range_bytes: int = 32 << 20, per_range: int = 50) -> DataFrame:
    """All rows with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if they are identical; a null text counts as an empty one. Of the rows of a
    group one is ``kept``: the one with the ``largest`` (or ``smallest``) id, which is ``keep_id``. A
    null id comes after every other, so ``keep_id`` is null only where the whole group has no id. Of
    rows with the same id and text the one whose other columns have the least hash stays, and of
    rows equal in everything any one. Long texts are compared as a whole. An empty table gives an
    empty result. Input columns with the name of an output column are replaced.

    The rows are read in the order of the files or the written table they come from, so that a
    task that runs again gives each row the same place.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep!r}")
    kept_cols = [c for c in without(df, OUTPUT) if not (drop_text and c.lower() == text_col.lower())]
    names = ("key", "body", "own", "tie", "range", "new", "group", "first", "n", "best")
    key, body, own, tie, part, new, group, first, n, best = (free_name(df, f"__{x}") for x in names)
    digest = "text_sha256"
    place = F.xxhash64(F.monotonically_increasing_id())  # spreads a group of copies over its ranges

    plain = [quoted(c) for c, t in df.dtypes if "map<" not in t and t != "variant"]
    keyed = df.select(
        *[quoted(c).alias(c) for c in kept_cols], text_or_empty(text_col).alias(body),
        quoted(id_col).cast("long").alias(own), F.xxhash64(*plain).alias(tie), place.alias(key))
    keyed = keyed.withColumn(digest, F.sha2(F.col(body), 256))
    head = F.hex(F.substring(F.col(body).cast("binary"), 1, HEAD))
    parts = (head.alias("head"), F.col(digest).alias("digest"), F.col(key).alias("place"))
    cuts = splitters(keyed.select(*parts, (F.octet_length(body) + ROW_BYTES).cast("long").alias("size")),
                     range_bytes, per_range)

    ranged = keyed.withColumn(part, range_of(F.struct(*parts), cuts)).withColumn(first, head)
    order = Window.partitionBy(part).orderBy(first, digest, body, key)
    differs = F.coalesce(F.lag(body).over(order) != F.col(body), F.lit(True))
    grouped = (ranged.withColumn(new, differs.cast("int"))
               .withColumn(group, F.sum(new).over(order.rowsBetween(Window.unboundedPreceding, 0)))
               .drop(body, first, new))
    up = keep == "largest"
    group_order = Window.partitionBy(part, group)
    row_order = [F.desc_nulls_last(own) if up else F.asc_nulls_last(own), F.col(tie), F.col(key)]
    local = grouped.select(
        *map(quoted, kept_cols), digest, part, group,
        F.row_number().over(group_order.orderBy(*row_order)).alias(first),
        F.count("*").over(group_order).alias(n),
        (F.max if up else F.min)(own).over(group_order).alias(best), tie)
    local = materialise(local, "sorted")

    # the first and the last group of every range, as far as the range beside it has the same text
    heads = local.where(F.col(first) == 1).select(
        F.col(part).alias("p"), F.col(group).alias("g"), F.col(digest).alias("d"), F.col(n).alias("n"),
        F.col(best).alias("best"), F.col(tie).alias("tie"))
    ends = heads.groupBy("p").agg(*[f(F.struct("g", "d", "n", "best", "tie")).alias(f.__name__)
                                    for f in (F.min, F.max)])
    ends = (ends.select("p", F.explode(F.array_distinct(F.array("min", "max"))).alias("e"))
            .select("p", "e.*"))
    rank = F.struct(F.col("best").isNull(), F.bitwise_not("best") if up else F.col("best"), "tie", "p")
    over = ends.groupBy("d").agg(F.sum("n").alias("size"), F.min_by("best", rank).alias("keep"),
                                 F.min_by("p", rank).alias("home"), F.count("*").alias("ranges"))
    over = ends.select("p", "g", "d").join(over.where("ranges > 1"), "d").drop("d", "ranges")
    p, g, size, keep_id, home = (free_name(df, f"__{x}") for x in ("p", "g", "size", "keep", "home"))
    over = over.withColumnsRenamed({"p": p, "g": g, "size": size, "keep": keep_id, "home": home})
    # at most two rows a range
    whole = local.join(F.broadcast(over), (F.col(part) == F.col(p)) & (F.col(group) == F.col(g)), "left")
    return whole.select(
        *map(quoted, kept_cols), F.when(F.col(p).isNull(), F.col(best)).otherwise(F.col(keep_id)).alias("keep_id"),
        F.coalesce(size, n).alias("group_size"),
        ((F.col(first) == 1) & (F.col(home).isNull() | (F.col(home) == F.col(part)))).alias("kept"), digest)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row of every group of equal texts, with its own columns; see ``with_copies``."""
    taken = [c for c in df.columns if c.lower() in OUTPUT]
    aside = {c: free_name(df, f"__own_{c}") for c in taken}
    found = with_copies(df.withColumnsRenamed(aside), id_col, text_col, keep)
    return found.where("kept").drop(*OUTPUT).withColumnsRenamed({v: k for k, v in aside.items()}).select(
        *map(quoted, df.columns))
