"""Exact top-k search by inner product with ball trees.

Candidates are dealt into shards of bounded size, and each shard is built into a ball tree: nodes
hold a centre and a radius, leaves a few dozen vectors that lie side by side in memory. For a
query q, no vector of a node can score more than q · centre + |q| · radius.

Queries are dealt into blocks. A task holds one block and is fed tree after tree. In a tree it
opens the node with the highest bound among those still open, for all queries of the block whose
current k-th score the bound reaches, and scores leaves by one matrix product. The k best of a
query, and so its k-th score, go on from leaf to leaf and from tree to tree: the later a tree
comes, the more of it is cut off. Where there are fewer blocks than tasks could run, the trees are
dealt into groups, and the k best of each (query, group) are merged.

Vectors are whole numbers. Products are exact: double precision where the Cauchy bound of the
lengths is below 2^52, Python integers beyond. Bounds are widened by their rounding error, so no
candidate is lost. Of equal scores the smaller id is better.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import quoted

LEAF, SHARD_ROWS, BLOCK_ROWS = 64, 4096, 1024
EXACT = 2.0 ** 52
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def packed(vectors: list, scale: float) -> np.ndarray:
    """floor(scale · x) as a matrix, shorter vectors filled up with zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = np.floor(scale * np.asarray(v, dtype=np.float64))
    return out


def build(matrix: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[tuple]]:
    """An order of the rows, and the nodes: (start, stop, left, right, centre, radius), the root
    first; a leaf has no children."""
    order = np.arange(len(matrix))
    nodes: list[tuple] = []
    open_nodes = [(0, len(matrix), None, 0)]
    while open_nodes:
        start, stop, parent, side = open_nodes.pop()
        rows = matrix[order[start:stop]]
        centre = rows.mean(axis=0)
        away = np.sqrt(((rows - centre) ** 2).sum(axis=1))
        radius = float(away.max())
        number = len(nodes)
        nodes.append([start, stop, -1, -1, centre, radius])
        if parent is not None:
            nodes[parent][2 + side] = number
        if stop - start > leaf and radius > 0:
            # along the line from the farthest row to the one farthest from it
            one = rows[away.argmax()]
            other = rows[((rows - one) ** 2).sum(axis=1).argmax()]
            middle = (stop - start) // 2
            part = np.argpartition(rows @ (other - one), middle)
            order[start:stop] = order[start:stop][part]
            open_nodes += [(start, start + middle, number, 0), (start + middle, stop, number, 1)]
    return order, nodes


class Block:
    """Queries of one task and the k best of each so far."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.length = np.sqrt((matrix ** 2).sum(axis=1))
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def widened(self, width: int) -> None:
        """Room for the components of longer vectors."""
        if width > self.matrix.shape[1]:
            self.matrix = np.pad(self.matrix, ((0, 0), (0, width - self.matrix.shape[1])))

    def search(self, ids: np.ndarray, matrix: np.ndarray, nodes: list[tuple]) -> None:
        """All nodes of a tree, the highest bound first."""
        self.widened(matrix.shape[1])
        width = matrix.shape[1]
        queries = self.matrix[:, :width]
        longest = np.sqrt((matrix ** 2).sum(axis=1).max())
        whole = longest * self.length.max() < EXACT
        if not whole and self.scores.dtype != object:
            self.scores = self.scores.astype(object)

        def bounds(rows: np.ndarray, node: int) -> np.ndarray:
            centre, radius = nodes[node][4:]
            size = self.length[rows] * (np.sqrt((centre ** 2).sum()) + radius)
            bound = queries[rows] @ centre + self.length[rows] * radius + size * 1e-9 + 1e-6
            return np.maximum(np.where(np.isnan(bound), np.inf, bound), float(LEAST))

        everyone = np.arange(len(self.ids))
        first = bounds(everyone, 0)
        heap = [(-first.max(), 0, everyone, first)]
        while heap:
            _, node, rows, bound = heapq.heappop(heap)
            rows = rows[bound >= self.scores[rows, -1]]
            if not len(rows):
                continue
            start, stop, left, right = nodes[node][:4]
            if left < 0:
                self.score(rows, queries[rows], ids[start:stop], matrix[start:stop], whole)
                continue
            for child in (left, right):
                bound = bounds(rows, child)
                reached = bound >= self.scores[rows, -1]
                if reached.any():
                    heapq.heappush(heap, (-bound[reached].max(), child, rows[reached], bound[reached]))

    def score(self, rows: np.ndarray, queries: np.ndarray, ids: np.ndarray, leaf: np.ndarray,
              whole: bool) -> None:
        if whole:
            scores = queries @ leaf.T
        else:
            exact = [[int(x) for x in v] for v in leaf]
            scores = np.array([[max(LEAST, min(MOST, sum(x * int(y) for x, y in zip(v, q)))) for v in exact]
                               for q in queries], dtype=object).reshape(len(rows), len(leaf))
        scores = np.where(ids[None, :] == self.ids[rows][:, None], -np.inf, scores)
        better = (scores >= self.scores[rows, -1:]).any(axis=1)
        rows, scores = rows[better], scores[better]
        if not len(rows):
            return
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        found = np.concatenate([self.found[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        if scores.dtype == object:
            best = np.array([sorted(range(len(s)), key=lambda i, s=s, f=f: (-s[i], f[i]))[:self.k]
                             for s, f in zip(scores, found)])
        else:
            best = np.lexsort((found, -scores), axis=1)[:, :self.k]
        self.scores[rows] = np.take_along_axis(scores, best, axis=1)
        self.found[rows] = np.take_along_axis(found, best, axis=1)

    def result(self) -> pa.RecordBatch:
        seen = self.scores.astype(float) > -np.inf
        which = np.nonzero(seen)
        scores = [int(s) for s in self.scores[seen]]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[which[0]], pa.int64()), pa.array(self.found[seen], pa.int64()),
             pa.array(scores, pa.int64())], names=["query_id", "vec_id", "score"])


def _searcher(scale: float, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell; in each cell the queries first, then the trees."""
        cell, ids, vectors, block = None, [], [], None
        for batch in batches:
            for row in range(batch.num_rows):
                at = {name: batch.column(name)[row] for name in batch.schema.names}
                if (own := (at["block"].as_py(), at["group"].as_py())) != cell:
                    if block is not None:
                        yield block.result()
                    cell, ids, vectors, block = own, [], [], None
                if at["place"].as_py() < 0:
                    ids.append(at["query_id"].as_py())
                    vectors.append(at["vector"].as_py())
                elif ids:
                    if block is None:
                        block = Block(np.array(ids, np.int64), packed(vectors, scale), k)
                    block.search(*planted(at))
        if block is not None:
            yield block.result()
    return search


def planted(row: dict) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Ids, vectors and nodes out of a written tree."""
    ids, ranges = (np.frombuffer(row[c].as_py(), np.int64) for c in ("ids", "ranges"))
    matrix, centres, radii = (np.frombuffer(row[c].as_py()) for c in ("matrix", "centres", "radii"))
    width = row["width"].as_py()
    nodes = [(*r, c, x) for r, c, x in zip(ranges.reshape(-1, 4).tolist(),
                                           centres.reshape(len(radii), width), radii.tolist())]
    return ids, matrix.reshape(len(ids), width), nodes


def _clean(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    vector = quoted(vector_col).cast("array<double>")
    return df.select(quoted(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        "vec_id IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL"
        f" AND NOT isnan(x) AND abs(x * {scale}D) < double('infinity'))")


def top_k(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: float = 64.0, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best.

    Every component is turned into floor(``scale`` · x) first. Queries are the rows whose id is
    divisible by ``every``; candidates are all rows but those with the query's id. Rows with a
    null id, a null vector, or a vector with null or non-finite components (scaled, as doubles) take
    no part. Repeated
    rows (same id, same vector) count once; an id with several vectors is a query with the first
    of them in their order and a candidate with each. Vectors of different lengths are filled up
    with zeros. A score beyond a long counts as the greatest or least long. An empty table gives an
    empty result.
    """
    spark = df.sparkSession
    clean = _clean(df, id_col, vector_col, scale)
    counts = clean.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    shards, blocks = -(-counts["n"] // shard_rows) or 1, -(-counts["q"] // block_rows) or 1
    groups = min(shards, max(1, -(-2 * spark.sparkContext.defaultParallelism // blocks)))

    def plant(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = packed(list(rows["vector"]), scale)
        ids = rows["vec_id"].to_numpy(np.int64)
        order = np.lexsort((*matrix.T[::-1], ids)) if matrix.shape[1] else np.argsort(ids, kind="stable")
        ids, matrix = ids[order], matrix[order]
        own = np.ones(len(ids), dtype=bool)
        own[1:] = (ids[1:] != ids[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)
        ids, matrix = ids[own], matrix[own]
        order, nodes = build(matrix)
        return pd.DataFrame({
            "shard": rows["shard"][:1].to_numpy(), "width": matrix.shape[1],
            "ids": [ids[order].tobytes()], "matrix": [matrix[order].tobytes()],
            "ranges": [np.array([n[:4] for n in nodes], np.int64).tobytes()],
            "centres": [np.array([n[4] for n in nodes]).tobytes()],
            "radii": [np.array([n[5] for n in nodes]).tobytes()]})

    tree = "width int, ids binary, matrix binary, ranges binary, centres binary, radii binary"
    dealt = clean.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    trees = dealt.groupBy("shard").applyInPandas(plant, f"shard int, {tree}")
    cells = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    tree_cells = trees.select(F.col("shard").alias("place"), (F.col("shard") % groups).alias("group"),
                              cells.alias("block"), "width", "ids", "matrix", "ranges", "centres", "radii",
                              F.lit(None).cast("long").alias("query_id"),
                              F.lit(None).cast("array<double>").alias("vector"))
    queries = (clean.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
               .select(F.lit(-1).alias("place"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
                       F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
                       *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in tree.split(", "))],
                       F.col("vec_id").alias("query_id"), "vector"))

    columns = ["place", "group", "block", "width", "ids", "matrix", "ranges", "centres", "radii", "query_id", "vector"]
    cells_of = tree_cells.select(columns).unionByName(queries.select(columns))
    best = (cells_of.repartition(blocks * groups, "block", "group")
            .sortWithinPartitions("block", "group", "place")
            .mapInArrow(_searcher(scale, k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
