"""Exact deduplication against plain Python."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm import content_sort


def by_hand(rows, keep=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        best = keep([i for i in ids if i is not None], default=None)
        out += [(i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def found(df, **settings):
    rows = content_sort.with_copies(df, **settings).collect()
    kept = defaultdict(list)
    for r in rows:
        if r["kept"]:
            kept[r["text_sha256"]].append(r["doc_id"])
    assert all(ids == [r["keep_id"]] for r in rows for ids in [kept[r["text_sha256"]]])
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str)


@pytest.mark.parametrize("range_bytes", [400, 5_000, 1 << 25])
def test_a_third_of_the_rows_is_one_text(spark, range_bytes):
    rng = random.Random(3)
    rows = [(i, "the same text" if i % 3 == 0 else f"the same begin of a long line, then {rng.randrange(500)}")
            for i in range(1200)] + [(None, "the same text"), (-2 ** 63, "lone"), (5000, None), (5001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, range_bytes=range_bytes) == by_hand(rows)
    assert found(df, range_bytes=range_bytes, keep="smallest") == by_hand(rows, min)


def test_ranges_split_a_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"))
    keys = df.select(F.lit("a").alias("head"), F.lit("b").alias("digest"), F.xxhash64("doc_id").alias("place"),
                     F.lit(72).cast("long").alias("size"))
    cuts = content_sort.splitters(keys, 9000, 50)
    key = F.struct("head", "digest", "place")
    sizes = [r["count"] for r in keys.groupBy(content_sort.range_of(key, cuts).alias("r")).count().collect()]
    assert len(sizes) == 24 and max(sizes) < 250


def test_range_of_counts_cuts_not_above(spark):
    cuts = [{"head": h, "digest": "", "place": 0} for h in "BDFHJLNPRT"]
    df = spark.createDataFrame([(c,) for c in "ABCDKTZ"], "c string")
    got = df.select("c", content_sort.range_of(F.struct(F.col("c").alias("head"), F.lit("").alias("digest"),
                                                        F.lit(0).cast("long").alias("place")), cuts)).collect()
    assert dict(map(tuple, got)) == {c: sum(x <= c for x in "BDFHJLNPRT") for c in "ABCDKTZ"}


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(documents, range_bytes=20_000) == by_hand(rows)


def test_edges(edges, edge_rows):
    assert found(edges, range_bytes=300) == by_hand([r[:2] for r in edge_rows])
    out = content_sort.with_copies(edges)
    assert set(edges.columns) <= set(out.columns) and all(r["keep"] == 7 for r in out.select("keep").collect())
    assert content_sort.with_copies(edges.limit(0)).count() == 0
    replaced = content_sort.with_copies(edges.withColumn("KEPT", F.lit("mine")))
    assert [c.lower() for c in replaced.columns].count("kept") == 1


def test_one_row_of_each_group(edges, edge_rows):
    named = edges.withColumn("kept", F.lit("mine"))
    once = content_sort.exact_dedup(named, keep="smallest")
    assert once.columns == named.columns
    rows = once.collect()
    assert sorted(r["text"] or "" for r in rows) == sorted({r[1] or "" for r in edge_rows})
    assert all(r["kept"] == "mine" for r in rows)
    assert [r["doc_id"] for r in rows if not r["text"]] == [3]  # null texts and the empty one


def test_no_python(documents):
    plan = content_sort.with_copies(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_which_row_stays(spark):
    with pytest.raises(ValueError):
        content_sort.with_copies(spark.range(1), keep="first")
