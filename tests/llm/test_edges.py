"""Every operator on nulls, empty and long texts, repeated rows, an empty table, clashing names."""

from collections import Counter

import public_tokenizers
import pytest

from starmart.llm import (
    byte_bpe,
    cotraining,
    fingerprints,
    histogram_sort,
    language_id,
    licences,
    mixing,
    near_dedup,
    token_counts,
)
from starmart.llm.queries import RANKS, WORD_BPE

PATTERN = public_tokenizers.PATTERN


def quality(df):
    labels = df.sparkSession.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (8, 0, 0), (7, 0, 0), (None, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    return cotraining.with_quality(df, cotraining.fit(df, labels))


#: Operators that return every row, and the columns they write.
ROW_BY_ROW = {
    "language": (language_id.identify, language_id.OUTPUT),
    "quality": (quality, cotraining.OUTPUT),
    "encode": (lambda df: byte_bpe.encode(df, RANKS, PATTERN, chunk_chars=1000, overlap=50), ("ids",)),
    "licences": (licences.scan, licences.OUTPUT),
    "counts": (lambda df: token_counts.with_token_counts(df, WORD_BPE, chunk_chars=1000), token_counts.OUTPUT),
    "fingerprint": (fingerprints.with_fingerprint, ("fingerprint",)),
    "shard": (lambda df: histogram_sort.shard_by_bytes(df, 4), histogram_sort.OUTPUT),
    "classes": (near_dedup.near_classes, ("class_id",)),
}


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_every_row_stays(edges, edge_rows, name):
    operator, written = ROW_BY_ROW[name]
    out = operator(edges)
    own = {w.lower() for w in written}
    assert {c.lower() for c in out.columns} == {c.lower() for c in edges.columns} | own
    assert len(out.columns) == len({c.lower() for c in out.columns})
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r[0], r[1]) for r in edge_rows)
    for c in edges.columns[5:]:
        if c.lower() not in own:
            assert all(r[c] == 7 for r in rows)
    if name != "shard":  # equal texts and metadata, equal results
        by_row = {}
        for r in rows:
            key = (r["doc_id"], r["text"], r["lang"], r["source"])
            assert by_row.setdefault(key, [r[w] for w in written]) == [r[w] for w in written]


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_empty_table(edges, name):
    operator, _ = ROW_BY_ROW[name]
    assert operator(edges.limit(0)).count() == 0


def test_mixture_and_comparison(edges, edge_rows):
    mixed = mixing.mix(edges, target=5000).collect()
    given = {(r[0], r[1]) for r in edge_rows}
    assert {(r["doc_id"], r["text"]) for r in mixed} <= given and len(mixed) > 100
    assert mixing.mix(edges.limit(0)).count() == 0
    compared = fingerprints.compare_with_next(edges).collect()
    assert Counter(r["doc_id"] for r in compared) == Counter(r[0] for r in edge_rows)
    assert fingerprints.compare_with_next(edges.limit(0)).count() == 0
    assert fingerprints.compare_with_next(edges.where("doc_id = 7")).first()["near_next"] == 1.0


def test_one_of_each(edges):
    kept = near_dedup.one_of_each(edges).collect()
    # the repeated row once, the null texts all; of the other classes the row with the least id, and
    # a text that shares its id with another one, or has none, stays as well
    assert Counter(r["text"] is None for r in kept) == {True: 3, False: 9}
    texts = sorted(((r["doc_id"] or 0, r["text"][:5]) for r in kept if r["text"] is not None))
    assert texts == [(0, "no id"), (1, "one t"), (4, ""), (4, "tie i"), (5, " \n\t "), (6, "12 34"),
                     (7, next(r["text"] for r in kept if r["doc_id"] == 7)[:5]), (8, "yyyyy"), (9, "nul\x00 ")]
    assert near_dedup.one_of_each(edges.limit(0)).count() == 0


def test_missing_metadata(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert quality(df).count() == 2
