"""Document fingerprints by locally consistent parsing.

A text is parsed into a hierarchy of phrases. At every level
  1. a run of one symbol becomes one symbol (its name and the length of the run), so that
     neighbours differ;
  2. deterministic coin tossing gives each symbol a small label: twice the lowest bit in which
     its name differs from the left neighbour's, plus that bit. Neighbours keep different
     labels, and after three rounds there are at most eight;
  3. a phrase begins at each local minimum of the labels, so it has from two to some fourteen
     symbols, and its name is a hash of the names in it.
A label depends on three symbols to the left, a minimum on one to the right. So wherever a
substring stands, its phrases are the same but for a few at its ends, on every level.

The fingerprint is a bottom-k sketch of the phrase names from ``FIRST_LEVEL`` up: the k least
hashes, 32 bits each, as hexadecimal text in ascending order. The likeness of two fingerprints
estimates the Jaccard similarity of the two sets of phrases.

All texts of a batch are parsed together in numpy, whole; batches are bounded by characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import quoted, small_table, text_or_empty, without
from starmart.session import materialise

FIRST_LEVEL = 2
SKETCH = 32
BATCH_CHARS = 1 << 20
SLAB = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: An odd multiplier for each place in a phrase; a phrase is far shorter than this.
PLACE = mix(np.arange(1, 65, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def _toss_table() -> np.ndarray:
    """For the labels of left neighbour and symbol, both bytes: the next label."""
    left, own = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    differ = left ^ own
    low = np.where(differ == 0, 0, np.bitwise_count((differ & -differ) - 1))
    return (2 * low + (own >> low & 1)).astype(np.uint8).ravel()


TOSS = _toss_table()


def labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Three rounds of coin tossing. ``first`` marks where a text begins: its left neighbour
    counts as 0 there."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = 0
    left[0] = 0
    differ = names ^ left
    low = np.bitwise_count((differ & (~differ + names.dtype.type(1))) - names.dtype.type(1))
    low &= 63
    out = ((names >> low.astype(names.dtype)) & names.dtype.type(1)).astype(np.uint8) + 2 * low
    for _ in range(2):
        pair = out.astype(np.uint16)
        pair[1:] |= out[:-1].astype(np.uint16) << 8
        pair[first] = out[first]
        out = TOSS[pair]
    return out


def phrase_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin: at the start of each text and at the local minima of the labels."""
    n, found = len(names), []
    for at in range(0, n, SLAB):
        left, right = max(0, at - 4), min(n, at + SLAB + 1)
        lab = labels(names[left:right], first[(first >= left) & (first < right)] - left)
        lower = np.zeros(len(lab), dtype=bool)
        lower[1:-1] = (lab[1:-1] < lab[:-2]) & (lab[1:-1] < lab[2:])
        found.append(np.flatnonzero(lower[at - left:at - left + SLAB]) + at)
    is_start = np.zeros(n, dtype=bool)
    is_start[np.concatenate(found)] = True
    is_start[first[1:] - 1] = False  # the last symbol of a text begins nothing
    is_start[first] = True
    return np.flatnonzero(is_start)


def runs_joined(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol as one symbol, and where the texts now begin."""
    change = np.empty(len(names), dtype=bool)
    np.not_equal(names[1:], names[:-1], out=change[1:])
    change[first] = True
    at = np.flatnonzero(change)
    if len(at) == len(names):
        return names, first
    long = np.diff(at, append=len(names))
    out = names[at].astype(np.uint64)
    many = long > 1
    out[many] = mix(out[many] + GOLDEN * long[many].astype(np.uint64))
    return out, np.searchsorted(at, first)


def next_level(names: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases, and where the texts begin among them."""
    names, first = runs_joined(names, first)
    starts = phrase_starts(names, first)
    out = np.empty(len(starts), dtype=np.uint64)
    for a in range(0, len(starts), SLAB):
        b = min(a + SLAB, len(starts))
        low, high = starts[a], starts[b] if b < len(starts) else len(names)
        own = starts[a:b] - low
        place = np.arange(high - low) - np.repeat(own, np.diff(own, append=high - low))
        out[a:b] = np.add.reduceat(names[low:high].astype(np.uint64) * PLACE[place], own)
    own_level = np.uint64(level * int(GOLDEN) & (1 << 64) - 1)
    return mix(out + own_level), np.searchsorted(starts, first)


def sketches(texts: list[str], k: int = SKETCH) -> list[np.ndarray]:
    """The k least phrase hashes of every text, ascending; an empty text has none."""
    out = [np.empty(0, np.uint32)] * len(texts)
    own = [i for i, t in enumerate(texts) if t]
    if not own:
        return out
    names = np.frombuffer("".join(texts[i] for i in own).encode("utf-32-le"), "<u4") + np.uint32(1)
    first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in own])[:-1]]).astype(np.int64)
    least: list[list[np.ndarray]] = [[] for _ in own]
    level, alive = 0, np.arange(len(own))
    while len(alive):
        level += 1
        names, first = next_level(names, first, level)
        sizes = np.diff(first, append=len(names))
        if level >= FIRST_LEVEL:
            hashes = (names >> np.uint64(32)).astype(np.uint32)
            for i, a, n in zip(alive.tolist(), first.tolist(), sizes.tolist()):
                h = hashes[a:a + n]
                least[i].append(np.unique(h)[:k])
            keep = sizes > 1  # a text of one phrase is done
            if not keep.all():
                names = names[np.repeat(keep, sizes)]
                alive, sizes = alive[keep], sizes[keep]
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else first[:0]
    for i, found in zip(own, least):
        out[i] = np.unique(np.concatenate(found))[:k]
    return out


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def alike(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Estimated Jaccard similarity; two empty sketches are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.intersect1d(a, b, assume_unique=True)
    union = np.union1d(a, b)[:k]
    return float(np.isin(both, union, assume_unique=True).sum() / len(union))


def in_batches(texts: list[str], k: int) -> list[np.ndarray]:
    out, at, held = [], 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= BATCH_CHARS or i + 1 == len(texts):
            out += sketches(texts[at:i + 1], k)
            at, held = i + 1, 0
    return out


def with_fingerprint(df: DataFrame, text_col: str = "text", out: str = "fingerprint",
                     k: int = SKETCH) -> DataFrame:
    """Every row with the fingerprint of its text. A null text counts as an empty one, which has
    the empty fingerprint; equal texts have equal fingerprints. An input column named ``out`` is
    replaced."""
    @F.arrow_udf("string")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array([as_text(s) for s in in_batches([t.as_py() or "" for t in texts], k)], pa.string())

    return df.select(*map(quoted, without(df, [out])), fingerprint(quoted(text_col)).alias(out))


def edited(text: str, other: str) -> str:
    """The text with its last half replaced by as much of the other's beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def compared(ids: list, texts: list[str], k: int) -> dict:
    """Result columns for all texts but the last, each compared with the one after it."""
    edits = [edited(a, b) for a, b in zip(texts, texts[1:])]
    prints = in_batches(texts, k)
    edit_prints = in_batches(edits, k)
    return {
        "id": ids[:-1], "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edits],
        "fingerprint": [as_text(s) for s in prints[:-1]],
        "edited_fingerprint": [as_text(s) for s in edit_prints],
        "near_edited": [alike(a, b, k) for a, b in zip(prints, edit_prints)],
        "near_next": [alike(a, b, k) for a, b in zip(prints, prints[1:])]}


COLUMNS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
           " near_edited double, near_next double")
ARROW = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                   ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                   ("near_edited", pa.float64()), ("near_next", pa.float64()),
                   ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())])


def _record(columns: dict, n: int, **more) -> pa.RecordBatch:
    """A batch; what is not given is null."""
    columns = columns | more
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in ARROW], schema=ARROW)


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = SKETCH) -> DataFrame:
    """One row per document, compared with an edit of itself and with the next document.

    The next document is the one with the next greater id (null ids first; equal ids by a hash of
    the text), after the last the first. ``edited`` replaces the last half of the characters by
    the beginning of the next document. Returns the id column, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``. A null text counts
    as an empty one. A single document is its own next; an empty table gives an empty result.

    The documents are sorted by range, and every sorted partition is read as a stream in which
    the next document is the next row. Only the first and the last row of each partition leave
    the stream with their texts; the last rows are compared afterwards.
    """
    spark = df.sparkSession

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, texts, held = [], [], 0
        begun = False
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                i, t = i.as_py(), t.as_py()
                if not begun:
                    begun = True
                    yield _record({"id": [i], "part": [part], "edge": ["first"], "text": [t]}, 1)
                ids.append(i)
                texts.append(t)
                held += len(t)
                if held >= BATCH_CHARS and len(texts) > 1:
                    yield _record(compared(ids, texts, k), len(ids) - 1)
                    ids, texts, held = ids[-1:], texts[-1:], len(t)
        if len(texts) > 1:
            yield _record(compared(ids, texts, k), len(ids) - 1)
        if begun:
            yield _record({"id": ids[-1:], "part": [part], "edge": ["last"], "text": texts[-1:]}, 1)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t, other in zip(*(batch.column(c).to_pylist() for c in range(3))):
                yield _record(compared([i, None], [t, other], k), 1)

    kind = f"id long, {COLUMNS}, part int, edge string, text string"
    docs = df.select(quoted(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    parted = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    done = materialise(parted.mapInArrow(stream, kind), "fingerprints")
    edges = done.where("edge IS NOT NULL")
    parts = sorted(r["part"] for r in edges.where("edge = 'first'").select("part").collect())
    following = small_table(spark, [{"part": a, "next_part": b} for a, b in zip(parts, parts[1:] + parts[:1])],
                            "part int, next_part int")
    firsts = edges.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next"))
    lasts = (edges.where("edge = 'last'").select("id", "text", "part").join(following, "part")
             .join(firsts, "next_part").select("id", "text", "next").mapInArrow(across, kind))
    out = ["id", *(c.split()[0] for c in COLUMNS.split(", "))]
    return (done.where("edge IS NULL").select(out).unionByName(lasts.select(out))
            .withColumnRenamed("id", id_col))
