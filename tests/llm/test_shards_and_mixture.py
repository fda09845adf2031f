"""Shards and mixtures against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm import histogram_sort, mixing


def by_hand(rows, n):
    """Shard and slot of each (id, text), in the order of crc32 and id."""
    rows = sorted(rows, key=lambda r: (zlib.crc32(r[1].encode()), r[0]))
    total = sum(len(t.encode()) + 1 for _, t in rows)
    before, out, slots = 0, {}, Counter()
    for i, t in rows:
        shard = min(n - 1, before * n // total)
        out[i] = shard, slots[shard]
        slots[shard] += 1
        before += len(t.encode()) + 1
    return out


@pytest.mark.parametrize("n", [1, 3, 16])
def test_shards_are_equal_cuts_of_the_order(documents, n):
    want = by_hand([tuple(r) for r in documents.select("doc_id", "text").collect()], n)
    got = histogram_sort.shard_by_bytes(documents, n).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want


def test_a_group_of_equal_texts_is_cut_like_any_other(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in histogram_sort.shard_by_bytes(df, 7).collect()}
    assert got == by_hand(rows, 7)


def test_rows_equal_in_everything_are_cut(spark):
    same = [(1, "the same row")] * 1000
    rows = same + [(i, f"text {i}") for i in range(2, 2002)] + [(None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = histogram_sort.shard_by_bytes(df, 16).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(sizes.values()) / 16
    assert len(sizes) == 16 and all(abs(x - share) <= 13 for x in sizes.values())


@pytest.mark.parametrize("most", [64, 1 << 17])
def test_cells_on_the_driver_are_bounded(spark, documents, monkeypatch, most):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()] + [(10_000 + i, f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(histogram_sort, "MOST_CELLS", most)
    counted, inside = [], histogram_sort._count_inside

    def seen(keys, cells):
        found = inside(keys, cells)
        counted.append((len(cells), sum(map(len, found.values()))))
        return found
    monkeypatch.setattr(histogram_sort, "_count_inside", seen)
    got = histogram_sort.shard_by_bytes(df, 16, rows_per_range=1).collect()
    assert all(n <= max(most, 2 * cells) + cells for cells, n in counted)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == by_hand(rows, 16)


def test_ids_of_any_size(spark):
    rows = [(i, "x") for i in (-2 ** 63, -2 ** 63 + 1, -1, 0, 1, 2 ** 62, 2 ** 63 - 2, 2 ** 63 - 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in histogram_sort.shard_by_bytes(df, 4).collect()}
    assert got == by_hand(rows, 4)


def test_tolerance_keeps_shards_near_equal(documents):
    sizes = Counter()
    for r in histogram_sort.shard_by_bytes(documents, 4, tolerance=0.5).collect():
        sizes[r["shard"]] += r["size"]
    share = sum(sizes.values()) / 4
    assert all(abs(s - share) <= 0.5 * share + 40_000 for s in sizes.values())


def test_one_exchange_carries_the_rows(documents):
    plan = histogram_sort.shard_by_bytes(documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def repetitions(doc_id, text, rate, seed=17):
    blocks = max(1, math.ceil(rate / mixing.MAX_RATE))
    r, n = rate / blocks, 0
    for b in range(1, blocks + 1):
        name = f"{seed}|{doc_id}|{hashlib.md5(text.encode()).hexdigest()}|{b}"
        point = int(hashlib.md5(name.encode()).hexdigest()[:13], 16) / 2 ** 52
        p = c = math.exp(-r)
        k = 0
        while c <= point and k < mixing.TERMS:
            k += 1
            p *= r / k
            c += p
            n += 1
    return n


@pytest.mark.parametrize("weights, target", [(None, None), ({"src0": 3, "src1": 1, "absent": 5}, None),
                                             ({"src2": 1}, 20_000)])
def test_each_document_gets_its_own_poisson_number(documents, weights, target):
    rows = documents.select("doc_id", "text", "source").collect()
    sizes = Counter(r["source"] for r in rows)
    given = {s: 1.0 if weights is None else weights.get(s, 0) for s in sizes}
    whole = sum(given.values())
    rates = {s: (target or len(rows)) * w / whole / sizes[s] for s, w in given.items()}
    want = {r["doc_id"]: n for r in rows if (n := rates[r["source"]] and repetitions(r["doc_id"], r["text"], rates[r["source"]]))}
    got = defaultdict(list)
    for r in mixing.mix(documents, weights, target=target).collect():
        got[r["doc_id"]].append((r["copy"], r["repetitions"]))
    assert {i: len(c) for i, c in got.items()} == want
    assert all(sorted(c) == [(k, len(c)) for k in range(1, len(c) + 1)] for c in got.values())


def test_expected_sizes(documents):
    mixed = mixing.mix(documents, {"src0": 1, "src1": 3}, size_col="n_chars", target=3e7)
    sizes = dict(mixed.groupBy("source").agg(F.sum("n_chars")).collect())
    assert abs(sizes["src1"] / sizes["src0"] / 3 - 1) < 0.1 and abs(sum(sizes.values()) / 3e7 - 1) < 0.1


def test_order_is_that_of_a_hash(documents):
    keys = [r["position_key"] for r in mixing.mix(documents).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_sources_without_size(spark):
    df = spark.createDataFrame([(1, "a", "s", 0), (2, "b", None, 2)], "doc_id long, text string, source string, n long")
    assert {r["source"] for r in mixing.mix(df, size_col="n", target=100).collect()} == {None}
    assert mixing.mix(df, {}).count() == 0
