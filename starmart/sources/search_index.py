"""Substring search that opens only files that may hold the term.

For every file and text column a bit array says which three-byte sequences occur in it. A text that
contains a term contains all its sequences, so files that lack one of them are left out, and the
others are searched exactly. Each task finds the distinct sequences of a batch of rows over all its bytes
at once; the arrays are built of these by aggregation, one short set of rows per file
(``SLICES`` times 4 KB a column), and files are never changed once written: files that came later
are indexed by another call, and those not indexed yet are searched like any that may match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import filters
from starmart.sources import file_index

GRAM, BITMAP, SLICES = 3, 32_768, 4
BLOCK = 1 << 20
INDEX = "path string, column string, slice int, bits binary"


def _place(gram: Column) -> Column:
    """Place of a sequence in the bit array."""
    return F.when(gram.isNotNull(), F.pmod(F.xxhash64(gram), F.lit(BITMAP * SLICES)))


def _grams(text: Column) -> Column:
    """Places in the bit array of all sequences of a term, each once; none for shorter ones."""
    raw = text.cast("binary")
    starts = F.sequence(F.lit(1), F.octet_length(raw) - GRAM + 1)
    places = F.transform(starts, lambda i: _place(F.substr(raw, i, F.lit(GRAM))))
    return F.when(F.octet_length(raw) >= GRAM, F.array_distinct(places))


def _distinct(texts: pa.Array) -> list[bytes | None]:
    """All sequences of the texts, each once, and None if some text has none.

    The bytes are looked at in blocks, all places of a block together; sequences that go over the
    end of a text are left out."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.empty(0, np.uint8)
    ends = ends - ends[0]
    seen = np.zeros(1 << 8 * GRAM, bool)
    for start in range(0, len(raw) - GRAM + 1, BLOCK):
        block = raw[start:start + BLOCK + GRAM - 1].astype(np.int32)
        size = len(block) - GRAM + 1
        codes, inside = np.zeros(size, np.int32), np.ones(size, bool)
        for i in range(GRAM):
            codes = codes << 8 | block[i:i + size]
        near = ends[np.searchsorted(ends, start, "right"):np.searchsorted(ends, start + size + GRAM)] - start
        for i in range(1, GRAM):
            over = near - i
            inside[over[(over >= 0) & (over < size)]] = False
        seen[codes[inside]] = True
    short = [None] if (np.diff(ends) < GRAM).any() else []
    return [int(code).to_bytes(GRAM, "big") for code in np.flatnonzero(seen)] + short


def _sequences(names: list[str]):
    """Per batch of rows, file and text column: the sequences that occur, each once."""
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            files = batch.column("path").dictionary_encode().indices.to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(files)) + 1).tolist(), len(files)]
            for a, b in zip(edges[:-1], edges[1:]):
                path = batch.column("path")[a].as_py()
                for i, name in enumerate(names):
                    grams = _distinct(batch.column(f"c{i}").slice(a, b - a))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(grams)), pa.array([name] * len(grams)), pa.array(grams, pa.binary())],
                        ["path", "column", "gram"])
    return found


def _texts(schema: T.StructType, cols=None) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType) and (cols is None or f.name in cols)]


def index_files(spark: SparkSession, table: str, index: str) -> int:
    """Index the files of the Parquet folder ``table`` that are not in ``index`` yet; how many.

    File names come to the driver. A file's column without a text of three bytes has a row
    without bits, which says that it has been looked at.
    """
    whole = spark.read.parquet(table)
    known = file_index.known(file_index.stored(spark, index, INDEX))
    new = [f for f in whole.inputFiles() if file_index.place(f) not in known]
    names = _texts(whole.schema)
    if not new or not names:
        return 0
    rows = file_index.opened(spark, table, new, whole.schema)
    path = F.col("_metadata.file_path").alias("path")
    grams = rows.select(path, *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).mapInArrow(
        _sequences(names), "path string, column string, gram binary").withColumn("at", _place(F.col("gram")))
    (grams.groupBy("path", "column", F.coalesce(F.floor(F.col("at") / BITMAP), F.lit(0)).cast("int").alias("slice"))
     .agg(F.bitmap_construct_agg(F.col("at") % BITMAP).alias("bits")).write.mode("append").parquet(index))
    return len(new)


def candidates(spark: SparkSession, table: str, index: str, term: str, cols=None) -> list[str]:
    """Files that may hold the term in one of the columns: those with all its sequences, and those
    that are not indexed."""
    whole = spark.read.parquet(table)
    present = whole.inputFiles()
    names = _texts(whole.schema, cols)
    if len(term.encode()) < GRAM:
        return present
    stored = file_index.stored(spark, index, INDEX)
    places = spark.range(0, 1, 1, 1).select(F.explode(_grams(F.lit(term))).alias("at")).select(
        F.floor(F.col("at") / BITMAP).cast("int").alias("slice"), (F.col("at") % BITMAP).alias("bit"))
    byte = F.conv(F.hex(F.substr("bits", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(byte, cast(bit % 8 as int)) & 1") == 1
    found = (stored.where(F.col("column").isin(names)).join(F.broadcast(places), "slice")  # a row per byte of the term
             .withColumn("byte", byte).where(hit).groupBy("path", "column").agg(F.count("*").alias("n")))
    n = len({term.encode()[i:i + GRAM] for i in range(len(term.encode()) - GRAM + 1)})
    # two sequences may share a place, so the places are counted and not the sequences
    n = min(n, places.count())
    may = {file_index.place(r[0]) for r in found.where(F.col("n") >= n).select("path").distinct().collect()}
    known = file_index.known(stored)
    return [f for f in present if file_index.place(f) in may or file_index.place(f) not in known]


def search(spark: SparkSession, table: str, index: str, term: str, cols=None) -> DataFrame | None:
    """Rows of a Parquet folder in which some text column contains ``term``: the same as
    ``filters.search`` over the whole folder, out of the files that may hold it."""
    schema = spark.read.parquet(table).schema
    if not term or not _texts(schema, cols):
        return None
    return filters.search(file_index.opened(spark, table, candidates(spark, table, index, term, cols), schema), term, cols)
