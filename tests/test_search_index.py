"""Search by bit arrays of byte sequences against a full scan."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.operators import filters
from starmart.sources import search_index
from tests.conftest import rows

WORDS = ["strasse", "maison", "street", "calle", "Ünïcode", "日本語", "a%b", "x y", "it's"]


@pytest.fixture
def stored(spark, folder):
    """One word per file, nine files."""
    data = [(i, WORDS[i % 9] + f" number {i}", None if i % 4 else "other") for i in range(180)]
    df = spark.createDataFrame(data, "n int, a string, b string")
    path = folder("my table+1")
    df.repartitionByRange(9, F.col("n") % 9).write.parquet(path)
    search_index.index_files(spark, path, folder("index"))
    return path, folder("index")


@pytest.mark.parametrize("term", ["strasse", "ass", "日本", "nï", "r 17", "other", "x", "ou", "%b ", "absent", "strasse number 9", "oooo"])
def test_equal_to_a_full_scan(spark, stored, term):
    whole = spark.read.parquet(stored[0])
    assert rows(search_index.search(spark, *stored, term)) == rows(filters.search(whole, term))


def test_files_opened(spark, stored):
    def count(term, cols=None):
        return len(search_index.candidates(spark, *stored, term, cols))
    files = len(spark.read.parquet(stored[0]).inputFiles())
    assert count("strasse") == 1 and count("日本語") == 1 and count("absent") == 0
    assert count("number") == files and count("number", ["b"]) == 0
    assert count("x") == files  # too short for a sequence
    assert search_index.search(spark, *stored, "") is None


def test_files_that_came_later(spark, stored, folder):
    path, index = stored
    later = spark.createDataFrame([(500, "strasse again", None), (501, "x", "y")], "n int, a string, b string")
    later.coalesce(1).write.mode("append").parquet(path)
    before = len(search_index.candidates(spark, path, index, "maison"))
    assert rows(search_index.search(spark, path, index, "again"), "n") == [(500,)]
    assert search_index.index_files(spark, path, index) == 1 and search_index.index_files(spark, path, index) == 0
    assert len(search_index.candidates(spark, path, index, "maison")) == before - 1
    assert rows(search_index.search(spark, path, index, "again"), "n") == [(500,)]


def test_partitions_nulls_and_nothing(spark, folder):
    df = spark.createDataFrame([(1, None, "p"), (2, "", "p"), (3, "find me", "q"), (4, "ab", "q")], "n int, a string, k string")
    df.write.partitionBy("k").parquet(folder("t"))
    search_index.index_files(spark, folder("t"), folder("i"))
    assert rows(search_index.search(spark, folder("t"), folder("i"), "find"), "n", "k") == [(3, "q")]
    assert len(search_index.candidates(spark, folder("t"), folder("i"), "find")) == 1
    assert search_index.search(spark, folder("t"), folder("i"), "nowhere").count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 20])
def test_distinct_sequences_of_many_texts(monkeypatch, block):
    monkeypatch.setattr(search_index, "BLOCK", block)
    texts = ["abcabc", None, "", "ab", "日本語x", "q", "zabc\x00\n", "a" * 50, "abcd"]
    for part in (pa.array(texts), pa.array(texts).slice(2, 5), pa.array(["abcd", "xyz"]), pa.array([None, None], pa.string()), pa.array(texts).slice(0, 0)):
        raw = [(t or "").encode() for t in part.to_pylist()]
        want = {r[i:i + 3] for r in raw for i in range(len(r) - 2)} | {None for r in raw if len(r) < 3}
        found = search_index._distinct(part)
        assert len(found) == len(want) and set(found) == want


def test_bits_equal_those_of_a_term(spark, stored):
    """The arrays of the files hold the places that a search asks for, and no others."""
    at = F.explode(search_index._grams(F.col("a"))).alias("at")
    want = spark.read.parquet(stored[0]).select(F.col("_metadata.file_path").alias("path"), at).groupBy(
        "path", (F.col("at") / search_index.BITMAP).cast("int").alias("slice")).agg(
        F.bitmap_construct_agg(F.col("at") % search_index.BITMAP).alias("bits"))
    assert rows(spark.read.parquet(stored[1]).where("column = 'a'").select("path", "slice", "bits")) == rows(want)


def test_long_texts_take_time_by_their_length(spark, folder):
    """A text of four million bytes: work by the square of its length would not end."""
    df = spark.createDataFrame([(1, 400_000), (2, 3)], "n int, times int")
    df.select("n", F.concat(F.repeat(F.lit("0123456789"), F.col("times")), F.lit("needle"), F.col("n")).alias("a")).coalesce(1).write.parquet(folder("t"))
    assert search_index.index_files(spark, folder("t"), folder("i")) == 1
    assert rows(search_index.search(spark, folder("t"), folder("i"), "9needle1"), "n") == [(1,)]
    assert len(search_index.candidates(spark, folder("t"), folder("i"), "absent")) == 0
