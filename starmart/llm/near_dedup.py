"""Near-duplicate classes by DartMinHash.

A text is the set of its five-word shingles, each with a weight (1, or how often it occurs).
Picture for each possible shingle a strip: its width is a weight, its length a rank. Hashed darts
fall on the strips at random, one per unit of area on average, always the same ones for a
shingle; each dart also belongs to one of the k coordinates. A text sees the darts that lie
within its shingles' weights, and its signature keeps, for every coordinate, the dart of least
rank. Two texts agree in a coordinate with a probability equal to their weighted Jaccard
similarity. As only darts up to a rank of about k ln k / (sum of weights) are needed, a signature
costs k ln k darts, however many shingles there are. Darts of a strip come in order of rank, each
a random step after the one before, so they are made one by one until the rank is passed. The
strip is laid in layers of weight (0 to 1, 1 to 2, 2 to 4, …) with darts of their own, so that a
greater weight sees all the darts of a smaller one.

Signatures are cut into bands of 4 coordinates; 20 bands find a pair of similarity 0.8 with
probability 0.99997. Then

1. equal texts become one node, so the rest deals with different texts only;
2. in each bucket (band, hash) every node is paired with the bucket's least node, the hub, so a
   group of a thousand copies has a thousand pairs, and the pairs are tested on their whole texts;
3. the links give components, and components meet again in their buckets: where a bucket still
   holds nodes of different components, its nodes are paired once more with hubs, now the least
   edited node among those that agree in two bands. What is still apart then is tested in all
   pairs across components, but for those that are ruled out. What rules out is exact: the sizes
   of two texts, and the weight of their rare shingles (at most ``RARE`` of these nodes have
   them), for two texts without a rare shingle in common share no more than what is left of
   either without its own. Pairs with a rare shingle in common are found by it, which is a join
   with short groups. So a heavily edited copy, or a text with only a common line in common, meets
   few others, every other pair of a bucket is either tested or already in one component, and no
   link is lost;
4. components of all links are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import WHITE, free_name, quoted, without
from starmart.llm.fingerprints import GOLDEN, PLACE, mix
from starmart.session import bound_batches, materialise

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 4
#: Two bands agree if they are so far apart.
STEPS = (1, 3, 7)
#: A shingle is rare if so many nodes have it at most.
RARE = 32
BATCH_BYTES = 1 << 19
ALL = (1 << 64) - 1
IS_WHITE = np.zeros(256, dtype=bool)
IS_WHITE[[ord(c) for c in WHITE]] = True
WORD_PLACE = mix(np.arange(1, 4097, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def shingles(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, in their order, and how many each text has. A text of
    fewer words than ``width`` has one shingle, all its words; one without words has none."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    white = IS_WHITE[raw]
    start = ~white
    start[1:] &= white[:-1]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    stop = white.copy()
    stop[0] = False
    stop[1:] &= ~white[:-1]
    stops = np.flatnonzero(stop)
    # a word's hash: its bytes times the multipliers of their places, in blocks of 4,096
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))[:len(raw)] \
        if starts[0] == 0 else np.arange(len(raw)) - np.concatenate(
            [np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(starts, append=len(raw)))])
    product = (raw.astype(np.uint64) + np.uint64(1)) * WORD_PLACE[place & 4095]
    if len(place) and place.max() >= 4096:
        product *= mix((place >> 12).astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    product[white] = 0
    words = mix(np.add.reduceat(product, starts) + (stops - starts).astype(np.uint64))
    word_text = np.searchsorted(ends_of_text, starts, side="right")
    n_words = np.bincount(word_text, minlength=len(texts))
    n_shingles = np.where(n_words == 0, 0, np.maximum(1, n_words - width + 1))
    first_word = np.cumsum(n_words) - n_words
    at = np.repeat(first_word - (np.cumsum(n_shingles) - n_shingles), n_shingles) + np.arange(n_shingles.sum())
    here = np.minimum(np.repeat(n_words, n_shingles), width)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    total = here.astype(np.uint64)
    for j in range(width):
        total += np.where(j < here, padded[at + j], np.uint64(0)) * PLACE[j]
    return mix(total), n_shingles


def weighted(hashes: np.ndarray, counts: np.ndarray, by_count: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles per text, their weights, and how many each text has."""
    found, weights, sizes, at = [], [], [], 0
    for n in counts.tolist():
        distinct, times = np.unique(hashes[at:at + n], return_counts=True)
        found.append(distinct)
        weights.append(times if by_count else np.ones(len(distinct)))
        sizes.append(len(distinct))
        at += n
    if not found:
        return np.empty(0, np.uint64), np.empty(0), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(weights).astype(float), np.array(sizes, dtype=np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Above 0, up to 1."""
    return ((x >> np.uint64(11)).astype(float) + 1.0) * 2.0 ** -53


def throw(elements: np.ndarray, weights: np.ndarray, owners: np.ndarray, most_rank: np.ndarray,
          n_owners: int, k: int, seed: int) -> np.ndarray:
    """For every owner and coordinate, the dart of least rank up to the owner's greatest rank:
    the rank in the upper 32 bits, the dart's name in the lower; all ones where there is none."""
    out = np.full(n_owners * k, ALL, np.uint64)
    layer = 0
    alive = np.arange(len(elements))
    while len(alive):
        low, high = (0.0, 1.0) if layer == 0 else (2.0 ** (layer - 1), 2.0 ** layer)
        alive = alive[weights[alive] > low]
        key = mix(elements[alive] ^ np.uint64((seed * int(GOLDEN) + layer * 0xD1342543DE82EF95) & ALL))
        own, limit, weight = owners[alive], most_rank[owners[alive]], weights[alive]
        rank, step = np.zeros(len(alive)), 0
        while len(key):
            step += 1
            dart = mix(key + np.uint64(step * int(GOLDEN) & ALL))
            rank = rank - np.log(_unit(dart)) / (high - low)  # darts of a wider layer come faster
            near = rank < limit
            key, rank, own, limit, weight, dart = (x[near] for x in (key, rank, own, limit, weight, dart))
            name = mix(dart)
            seen = low + _unit(mix(name + GOLDEN)) * (high - low) <= weight
            place = own[seen] * k + (name[seen] % np.uint64(k)).astype(np.int64)
            # 32 bits of the rank as a float keep its order
            packed = rank[seen].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
            np.minimum.at(out, place, packed | (name[seen] >> np.uint64(32)))
        layer += 1
    return out.reshape(n_owners, k)


def signatures(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """The k darts of every text (rows of zeros for texts without shingles)."""
    out = np.zeros((len(sizes), k), np.uint64)
    owners = np.repeat(np.arange(len(sizes)), sizes)
    sums = np.bincount(owners, weights, len(sizes))
    todo = np.flatnonzero(sums > 0)
    rank = (k * math.log(k) + 2 * k) / np.maximum(sums, 1e-300)
    while len(todo):
        number = np.full(len(sizes), -1)
        number[todo] = np.arange(len(todo))
        own = number[owners]
        here = own >= 0
        found = throw(elements[here], weights[here], own[here], rank[todo], len(todo), k, seed)
        full = (found != ALL).all(axis=1)
        out[todo[full]] = found[full]
        todo = todo[~full]
        rank[todo] *= 2
    return out


def band_hashes(texts: list[bytes], bands: int, rows: int, by_count: bool) -> tuple[np.ndarray, np.ndarray]:
    """One hash per text and band, and the summed weight of each text's shingles."""
    hashes, counts = shingles(texts)
    elements, weights, sizes = weighted(hashes, counts, by_count)
    darts = signatures(elements, weights, sizes, bands * rows).reshape(len(texts), bands, rows)
    total = (darts * PLACE[:rows]).sum(axis=2, dtype=np.uint64)
    owners = np.repeat(np.arange(len(texts)), sizes)
    return mix(total + np.arange(bands, dtype=np.uint64) * GOLDEN), np.bincount(owners, weights, len(texts))


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two texts' shingles, each sorted, with their weights."""
    (x, u), (y, v) = a, b
    at = np.searchsorted(y, x)
    same = at < len(y)
    same[same] = y[at[same]] == x[same]
    low = np.minimum(u[same], v[at[same]]).sum()
    whole = u.sum() + v.sum() - low
    return float(low / whole) if whole else 0.0


def _signed(df: DataFrame, bands: int, rows: int, by_count: bool) -> DataFrame:
    """``id``, ``node`` (digest of the text), ``size`` and ``bands`` of each row with words."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held, n = 0, 0, batch.num_rows
            texts = batch.column(2)
            group = []
            for i in range(n):
                group.append(texts[i].as_buffer().to_pybytes())
                held += len(group[-1])
                if held >= BATCH_BYTES or i + 1 == n:
                    hashes, sizes = band_hashes(group, bands, rows, by_count)
                    part = batch.slice(at, len(group))
                    lists = pa.ListArray.from_arrays(np.arange(len(group) + 1) * bands,
                                                     pa.array(hashes.view(np.int64).ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(sizes.astype(np.int64)), lists],
                        names=["id", "node", "size", "bands"])
                    at, held, group = i + 1, 0, []

    return df.select("id", "node", F.encode("text", "utf-8").alias("text")).mapInArrow(
        sign, "id long, node string, size long, bands array<long>")


SET = "node string, s binary, w binary"


def _sets(docs: DataFrame, nodes: DataFrame, needed: DataFrame, by_count: bool) -> DataFrame:
    """Sorted shingles and weights of each needed node, written: from the one row with the node's
    least id where ids are given; any of equal rows."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found, weights, _ = weighted(*shingles([batch.column(1)[i].as_buffer().to_pybytes()]), by_count)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([found.tobytes()], pa.binary()),
                     pa.array([weights.astype(np.float32).tobytes()], pa.binary())], names=["node", "s", "w"])

    chosen = needed.distinct().join(nodes.select("node", F.col("id").alias("own")), "node")
    found = docs.join(chosen, "node").where("own IS NULL OR id = own").select("node", "text").dropDuplicates(["node"])
    return materialise(found.select("node", F.encode("text", "utf-8").alias("text")).mapInArrow(cut, SET), "sets")


def _set(batch: pa.RecordBatch, row: int, s: str, w: str) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(batch.column(s)[row].as_buffer(), np.uint64),
            np.frombuffer(batch.column(w)[row].as_buffer(), np.float32).astype(float))


def _tested(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) of nodes that are as similar as asked, by all their shingles."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similarity(_set(batch, i, "s_a", "w_a"), _set(batch, i, "s_b", "w_b")) >= threshold
                    for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("s").alias(f"s_{name}"), F.col("w").alias(f"w_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return materialise(both.select("a", "b", "s_a", "w_a", "s_b", "w_b").mapInArrow(test, "a string, b string"), "links")


def _rare(sets: DataFrame) -> DataFrame:
    """Shingles that at most ``RARE`` of the nodes have: ``s``, ``node``, weight ``w``, and ``n``,
    how many have it; written."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s, w = _set(batch, i, "s", "w")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([s.view(np.int64)], pa.list_(pa.int64())),
                     pa.array([w], pa.list_(pa.float64()))], names=["node", "s", "w"])

    each = (sets.mapInArrow(listed, "node string, s array<long>, w array<double>")
            .select(F.unhex("node").alias("node"), F.inline(F.arrays_zip("s", "w"))))
    counts = each.groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") <= RARE)
    return materialise(each.join(counts, "s").withColumn("node", F.lower(F.hex("node"))), "rare")


def _pairs_with_hubs(rows: DataFrame, keys: list[str], hub, other=None) -> DataFrame:
    """In each group of rows, every node with the group's hub: pairs ``a`` (hub) and ``b``."""
    hubs = rows.groupBy(*keys).agg(hub.alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    hubs = hubs.select(*keys, *[F.col("hub")[c].alias(f"{c}_a") for c in other or ["node", "size"]])
    return rows.join(hubs, keys).where("node <> node_a")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of all nodes that have a link (``a``, ``b``).

    Alternating large and small stars: every node is joined to the least node it knows, until
    nothing changes; the links never grow in number. Each step is written, so its lineage ends.
    """
    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"))

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = materialise(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, now = None, state(edges)
    while before != now:
        before = now
        # large star: neighbours that are greater go to the least of all neighbours
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        m = least(both).select("u", F.least("u", "m").alias("m"))
        edges = materialise(both.where("v > u").join(m, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                            .distinct(), "large-star")
        # small star: neighbours that are less, and the node itself, go to the least of them
        down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        m = least(down)
        edges = materialise(down.join(m, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                            .unionByName(m.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(),
                            "small-star")
        now = state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select("b", "b").distinct().toDF("node", "component")).distinct()


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "class_id",
                 threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                 by_count: bool = False, component: str | None = None) -> DataFrame:
    """Every row with the class of its text in the column ``out``: the least id in the class.

    A class is a component of the graph whose links are pairs of texts with a similarity of at
    least ``threshold``, measured as (weighted, with ``by_count``) Jaccard similarity of their
    five-word shingles. Words lie between ASCII white space; a text of fewer than five words is one
    shingle. Equal texts are always in one class, also if empty or without words. A row with a
    null text is a class of its own with its own id; a null id is never the least unless the
    class has no other. Repeated rows share a class. An empty table gives an empty result. An input
    column named ``out`` is replaced. As ids may be null or stand for several texts, ``out`` need not
    tell classes apart; the column named ``component``, if asked for, does: the digest of one text of
    the class, null for a null text.
    """
    bound_batches(df.sparkSession)
    kept = without(df, [out] if component is None else [out, component])
    docs = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    docs = docs.where("text IS NOT NULL").withColumn("node", F.md5(F.encode("text", "utf-8")))
    signed = materialise(_signed(docs, bands, rows, by_count), "signatures")
    nodes = materialise(signed.groupBy("node").agg(
        F.min("id").alias("id"), F.first("size").alias("size"), F.first("bands").alias("bands")), "nodes")
    banded = nodes.where("size > 0").select("node", "size", F.posexplode("bands").alias("band", "hash"))

    def similar_size(x: str, y: str):
        return F.least(x, y) >= F.lit(threshold - 1e-9) * F.greatest(x, y)

    def shared_enough(x: str, y: str, size_x: str, size_y: str):
        return F.least(x, y) >= F.lit(threshold / (1 + threshold) - 1e-9) * (F.col(size_x) + F.col(size_y))

    def ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
        return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    def of_several(rows: DataFrame) -> DataFrame:
        """The rows of buckets with nodes of different components."""
        mixed = (rows.groupBy("band", "hash").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .where("low <> high").select("band", "hash"))
        return rows.join(mixed, ["band", "hash"])

    def with_component(rows: DataFrame) -> DataFrame:
        return rows.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))

    # every node with the least node of each of its buckets
    found = _pairs_with_hubs(banded, ["band", "hash"], F.min(F.struct("node", "size")))
    tested = materialise(ordered(found.where(similar_size("size", "size_a")), "node", "node_a"), "pairs")
    sets = _sets(docs, nodes, _ends(tested), by_count)
    links = _tested(tested, sets, threshold)
    parts = components(links)

    # buckets that still hold several components, without the nodes that can be like no other
    mixed = materialise(of_several(with_component(banded)), "mixed")
    sets = _sets(docs, nodes, mixed.select("node"), by_count)
    rare = _rare(sets)
    weights = rare.groupBy("node").agg(F.sum("w").alias("rare"), F.sum(F.when(F.col("n") == 1, F.col("w"))).alias("alone"))
    left_over = (mixed.join(weights, "node", "left")
                 .withColumn("shared", F.col("size") - F.coalesce("alone", F.lit(0.0)))
                 .withColumn("common", F.col("size") - F.coalesce("rare", F.lit(0.0)))
                 .where(F.col("shared") >= F.lit(threshold - 1e-9) * F.col("size")))
    left_over = materialise(of_several(left_over), "left-over")

    # hubs again, now the least edited node of those that agree in two bands
    own = left_over.select("node", "size", "shared", "component").distinct().join(nodes.select("node", "bands"), "node")
    twos = F.array(*[F.struct(F.lit(step * bands + i).alias("two"), F.xxhash64(
        F.col("bands")[i], F.col("bands")[(i + step) % bands]).alias("hash")) for step in STEPS for i in range(bands)])
    found = _pairs_with_hubs(own.select("node", "size", "shared", "component", F.inline(twos)), ["two", "hash"],
                             F.max(F.struct("shared", "node", "size", "component")),
                             ["shared", "node", "size", "component"])
    found = found.where((F.col("component") != F.col("component_a")) & similar_size("size", "size_a")
                        & shared_enough("shared", "shared_a", "size", "size_a"))
    more = materialise(ordered(found, "node", "node_a").join(tested, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(_tested(more, sets, threshold))
    tested = tested.unionByName(more)
    parts = components(links)

    # what is left, across components: pairs that have a rare shingle in common, and pairs of a
    # bucket that are similar enough without one
    left_over = with_component(left_over.drop("component")).join(nodes.select("node", "bands"), "node")
    left_over = materialise(of_several(left_over), "left-over")
    x, y = left_over.alias("x"), left_over.alias("y")
    apart = (F.col("x.component") < F.col("y.component")) & similar_size("x.size", "y.size")
    agree = F.zip_with("x.bands", "y.bands", lambda p, q: p == q)
    plain = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.hash") == F.col("y.hash")) & apart
                   & shared_enough("x.common", "y.common", "x.size", "y.size")
                   & (F.array_position(agree, True) == F.col("x.band") + 1))  # in their first bucket only
    own = left_over.select("node", "size", "shared", "component").distinct()
    holders = rare.where("n > 1").select("s", "node").join(own, "node")
    x, y = holders.alias("x"), holders.alias("y")
    sharing = x.join(y, (F.col("x.s") == F.col("y.s")) & apart  # at most RARE rows per shingle
                     & shared_enough("x.shared", "y.shared", "x.size", "y.size"))
    across = ordered(plain, "x.node", "y.node").unionByName(ordered(sharing, "x.node", "y.node")).distinct()
    across = materialise(across.join(tested, ["a", "b"], "left_anti"), "across")
    if not across.isEmpty():
        links = links.unionByName(_tested(across, sets, threshold))
        parts = components(links)

    classes = nodes.join(parts, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    least = classes.groupBy("component").agg(F.min("id").alias("class"))
    classes = materialise(classes.join(least, "component").select(
        "node", "class", *([] if component is None else ["component"])), "classes")
    digest, own, found, part = (free_name(df, f"__{x}") for x in ("digest", "node", "class", "component"))
    classes = classes.withColumnsRenamed({"node": own, "class": found, "component": part})
    text = quoted(text_col)
    return (df.withColumn(digest, F.md5(F.encode(text.cast("string"), "utf-8")))
            .join(classes, F.col(digest) == F.col(own), "left")
            .select(*map(quoted, kept), F.when(text.isNull(), quoted(id_col).cast("long"))
                    .otherwise(F.col(found)).alias(out),
                    *([] if component is None else [F.col(part).alias(component)])))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of every class: the one with the least id, or any of those that have it.

    Classes are told apart by their texts, so texts without an id or with the id of another text
    stay. Rows with a null text all stay: they are classes of their own.
    """
    cls, part = free_name(df, "__class"), free_name(df, "__part")
    classes = near_classes(df, id_col, text_col, out=cls, component=part, **settings)
    own = quoted(id_col).cast("long")
    first = classes.where(quoted(text_col).isNull() | own.eqNullSafe(F.col(cls))).drop(cls)
    twice = (first.where(quoted(text_col).isNotNull()).groupBy(F.col(part).alias("c")).agg(F.count("*").alias("n"))
             .where("n > 1").select("c"))
    twice = materialise(twice, "twice")
    if twice.isEmpty():
        return first.drop(part)
    c = free_name(df, "__c")
    twice = twice.withColumnRenamed("c", c)
    several = F.col(part) == F.col(c)  # null for null texts, which so are single
    single = first.join(twice, several, "left_anti")
    return single.unionByName(first.join(twice, several, "left_semi").dropDuplicates([part])).drop(part)
