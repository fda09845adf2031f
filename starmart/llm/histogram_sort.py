"""Sharding by histogram sort.

The rows are ordered by the key (crc32 of the text, id, hash of the whole row), so that equal
texts lie side by side, and this order is cut into shards of equal bytes. The cuts are found by
counting: every round counts the exact bytes and rows between candidate boundaries over all
partitions, and puts new candidates only inside the cells that still hold a cut, or that hold
too many rows. The first round has 4,096 cells, and each later round as many inside each open
cell, so three or four rounds pin a cut down to one row. A heavy key needs no exception: its
rows are cut by the next part of the key.

The counts also say how many rows lie before each range of the order. So one exchange by range
is enough to number the rows of a shard without gaps: a row's slot is the count before its
range plus its place in it.

The rounds read a written table of keys (three numbers and a size per row). The driver holds
the counted cells. A round makes ``MOST_CELLS`` new ones at most, however many cells are open: many open
cells are divided into few parts each, and there are never more than ``MOST_RANGES`` ranges (beyond,
they grow). Only built-in functions run on the executors.

Rows that are equal in every column have one key. Where a cut falls among such rows, or too many of
them are in one range, all rows are written once with a number of their own as the last part of
the key, and counted again.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import free_name, quoted, small_table, text_or_empty, without
from starmart.session import materialise

OUTPUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
LEAST = -(1 << 63)
TOP_SHIFT, CELLS = 20, 4096
#: Cells that a round may add on the driver, and ranges at most.
MOST_CELLS, MOST_RANGES = 1 << 17, 20_000


@dataclass(frozen=True)
class Cell:
    """Rows whose key begins with ``prefix`` and goes on with a value from low to high."""
    prefix: tuple[int, ...]
    low: int
    high: int
    bytes: int
    rows: int
    before_bytes: int = 0

    @property
    def start(self) -> tuple[int, int, int]:
        return (*self.prefix, self.low, LEAST, LEAST)[:3]

    def shard(self, n: int, total: int) -> int:
        return min(n - 1, self.before_bytes * n // total)

    def holds_cut(self, n: int, total: int) -> bool:
        last = self.before_bytes + self.bytes - 1
        return self.shard(n, total) != min(n - 1, last * n // total)

    def narrowed(self) -> Cell | None:
        """The cell with the next part of the key in view, if this part has only one value."""
        if self.low < self.high:
            return self
        if len(self.prefix) == 2:
            return None
        return replace(self, prefix=(*self.prefix, self.low), low=LEAST, high=-LEAST - 1)


def _count_inside(keys: DataFrame, cells: list[Cell]) -> dict[int, list[Cell]]:
    """Exact bytes and rows of the sub-cells of each cell, by the cell's number."""
    rows, parts = [], max(2, min(CELLS, MOST_CELLS // len(cells)))
    for i, c in enumerate(cells):
        shift = 2 if c.high - c.low >= 1 << 62 else 0
        step = ((c.high >> shift) - (c.low >> shift)) // parts + 1
        rows.append({"i": i, "top": (c.prefix or (c.low,))[0] >> TOP_SHIFT, "depth": len(c.prefix),
                     "p1": (*c.prefix, 0)[0], "p2": (*c.prefix, 0, 0)[1], "low": c.low,
                     "high": c.high, "shift": shift, "step": step})
    wanted = small_table(keys.sparkSession, rows,
                         "i int, top long, depth int, p1 long, p2 long, low long, high long,"
                         " shift int, step long")
    found = (keys.withColumn("top", F.shiftright("k1", TOP_SHIFT))
             .join(F.broadcast(wanted), "top")  # one row per open cell: cuts and heavy ranges
             .withColumn("value", F.expr("CASE depth WHEN 0 THEN k1 WHEN 1 THEN k2 ELSE k3 END"))
             .where("(depth < 1 OR k1 = p1) AND (depth < 2 OR k2 = p2)"
                    " AND value BETWEEN low AND high")
             .groupBy("i", F.expr("(shiftright(value, shift) - shiftright(low, shift)) DIV step")
                      .alias("sub"))
             .agg(F.min("value").alias("low"), F.max("value").alias("high"),
                  F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect())
    out: dict[int, list[Cell]] = {}
    for r in sorted(found, key=lambda r: (r["i"], r["sub"])):
        c = cells[r["i"]]
        out.setdefault(r["i"], []).append(
            Cell(c.prefix, r["low"], r["high"], r["bytes"], r["rows"]))
    return out


def _placed(cells: list[Cell], before: int = 0) -> list[Cell]:
    out = []
    for c in cells:
        out.append(replace(c, before_bytes=before))
        before += c.bytes
    return out


def _most(rows: int, n_shards: int, rows_per_range: int) -> int:
    """Rows that a range may have."""
    return max(min(rows_per_range, -(-rows // (16 * n_shards))), -(-rows // MOST_RANGES))


def count_cells(keys: DataFrame, n_shards: int, tolerance: float, rows_per_range: int) -> list[Cell]:
    """The key order as consecutive cells, none of which holds a cut farther than the tolerance
    from its edge, nor more rows than a range may have, unless all its rows have one key."""
    first = (keys.groupBy(F.shiftright("k1", TOP_SHIFT).alias("top"))
             .agg(F.min("k1").alias("low"), F.max("k1").alias("high"),
                  F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect())
    cells = _placed([Cell((), r["low"], r["high"], r["bytes"], r["rows"])
                     for r in sorted(first, key=lambda r: r["top"])])
    total = sum(c.bytes for c in cells)
    rows = sum(c.rows for c in cells)
    near = tolerance * total / n_shards
    most = _most(rows, n_shards, rows_per_range)
    while True:
        open_cells = {}
        for at, c in enumerate(cells):
            if (c.holds_cut(n_shards, total) and c.bytes > near or c.rows > most) and c.rows > 1:
                if narrower := c.narrowed():
                    open_cells[at] = narrower
        if not open_cells:
            return cells
        order = list(open_cells)
        inside = _count_inside(keys, [open_cells[at] for at in order])
        parts = {at: _placed(inside[i], cells[at].before_bytes) for i, at in enumerate(order)}
        cells = [x for at, c in enumerate(cells) for x in parts.get(at, [c])]


def _one_key(cells: list[Cell], n_shards: int, rows_per_range: int) -> bool:
    """Whether rows with one key would have to be cut."""
    total, most = sum(c.bytes for c in cells), _most(sum(c.rows for c in cells), n_shards, rows_per_range)
    return any(c.rows > 1 and c.narrowed() is None and (c.rows > most or c.holds_cut(n_shards, total)) for c in cells)


def _ranges(cells: list[Cell], n_shards: int, rows_per_range: int) -> list[dict]:
    """Consecutive cells of a shard put together to ranges; each knows the rows before it."""
    total, rows = sum(c.bytes for c in cells), sum(c.rows for c in cells)
    most = _most(rows, n_shards, rows_per_range)
    out, shard, slot, held = [], -1, 0, 0
    for c in cells:
        own = c.shard(n_shards, total)
        if own != shard or held + c.rows > most:
            slot = 0 if own != shard else slot
            out.append({"start": c.start, "id": len(out), "shard": own, "before": slot})
            shard, held = own, 0
        held += c.rows
        slot += c.rows
    return out


def _lookup(ranges: list[dict]) -> list[dict]:
    """For every possible top of a first key part, the ranges that can hold such a key."""
    out, at = [], 0
    for top in range(CELLS):
        first = at
        while at < len(ranges) and ranges[at]["start"][0] >> TOP_SHIFT <= top:
            at += 1
        here = ranges[max(0, first - 1):at] or ranges[:1]
        out.append({"top": top, "ranges": [
            {"start": dict(zip(("k1", "k2", "k3"), r["start"])), "id": r["id"],
             "shard": r["shard"], "before": r["before"]} for r in here]})
    return out


def shard_by_bytes(df: DataFrame, n_shards: int = 16, text_col: str = "text", id_col: str = "doc_id",
                   tolerance: float = 0.0, rows_per_range: int = 250_000) -> DataFrame:
    """All rows with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    The law is ``bytes``: the cuts lie at equal shares of the summed sizes, so that a shard
    differs from its share by less than the size of one row (plus ``tolerance``, a part of a
    share, if one is given). Slots count from 0 in every shard, in key order.

    A null text counts as an empty one: size 1, crc32 0. A null id comes first. Rows that are
    equal in every column are cut like any others, and are in any order. An empty table gives an empty result.
    Input columns with the name of an output column are replaced.
    """
    kept = without(df, OUTPUT)
    k1, k2, k3, size = (free_name(df, f"__{x}") for x in ("k1", "k2", "k3", "size"))
    text = text_or_empty(text_col)
    keyed = df.select(
        *map(quoted, kept), F.crc32(F.encode(text, "utf-8")).alias(k1),
        F.coalesce(quoted(id_col).cast("long"), F.lit(LEAST)).alias(k2),
        # maps have no hash in Spark; their text has
        F.xxhash64(*[F.to_json(F.struct(quoted(c))) if "map<" in t or t == "variant" else quoted(c)
                     for c, t in df.dtypes]).alias(k3),
        (F.octet_length(text).cast("long") + 1).alias(size))
    spark = df.sparkSession
    parts = (F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(k3).alias("k3"), F.col(size).alias("size"))
    cells = count_cells(materialise(keyed.select(*parts), "keys"), n_shards, tolerance, rows_per_range)
    if _one_key(cells, n_shards, rows_per_range):
        keyed = materialise(keyed.withColumn(k3, F.xxhash64(k3, F.monotonically_increasing_id())), "numbered")
        cells = count_cells(keyed.select(*parts), n_shards, tolerance, rows_per_range)
    ranges = _ranges(cells, n_shards, rows_per_range)
    if not ranges:
        ranges = [{"start": (0, LEAST, LEAST), "id": 0, "shard": 0, "before": 0}]
    key = "struct<k1:bigint,k2:bigint,k3:bigint>"
    top, place = free_name(df, "__top"), free_name(df, "__place")
    lookup = small_table(spark, _lookup(ranges),
                         f"top long, ranges array<struct<start:{key},id:int,shard:int,before:bigint>>"
                         ).withColumnsRenamed({"top": top, "ranges": place})
    own = F.struct(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(k3).alias("k3"))
    in_range = (keyed.withColumn(top, F.shiftright(k1, TOP_SHIFT))
                .join(F.broadcast(lookup), top)  # 4,096 rows
                .withColumn(place, F.element_at(F.filter(place, lambda r: r["start"] <= own), -1))
                .withColumn(top, F.col(place)["id"]))
    order = Window.partitionBy(top).orderBy(k1, k2, k3)
    return in_range.select(
        *map(quoted, kept), F.col(size).alias("size"), F.col(k1).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col(place)["shard"].alias("shard"),
        (F.col(place)["before"] + F.row_number().over(order) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
