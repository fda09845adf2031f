"""Near-duplicate classes, fingerprints and top-k search against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from starmart import session
from starmart.llm import ball_tree, fingerprints, near_dedup


def shingles(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def classes_by_hand(rows):
    """The least id of each row's component, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][1] == rows[j][1] or both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, (d, _) in enumerate(rows)}


def drifting(rng, n, length, change):
    """Copies of copies: neighbours are alike, the first and the last are not."""
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(length)]
    for _ in range(n):
        yield " ".join(words)
        words = [w if rng.random() > change else f"w{rng.randrange(10 ** 6)}" for w in words]


def test_classes_are_the_components(spark, documents):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
    more = ["", "", " ", "a", "a b", "a b", "x y z u v w", "x y z u v  w", *drifting(rng, 30, 200, 0.01),
            *(" ".join(w if rng.random() > 0.03 else f"q{rng.randrange(999)}" for w in base) for _ in range(40))]
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()] + list(enumerate(more, 10 ** 6))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(df).collect()}
    assert got == classes_by_hand(rows)
    kept = near_dedup.one_of_each(df).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(got.values()))


def test_one_of_each_keeps_unlike_texts_without_an_id_of_their_own(spark):
    texts = [" ".join(f"t{i}w{j}" for j in range(30)) for i in range(6)]
    rows = [(None, t) for t in texts[:3]] + [(None, texts[0] + " end"), (None, texts[0]), (7, texts[3]), (7, texts[4]),
                                             (7, texts[4]), (8, texts[5]), (7, texts[5]), (None, None), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in near_dedup.one_of_each(df).collect()]
    assert len([t for _, t in kept if t and t.startswith("t0w0 ")]) == 1
    assert sorted((t.split()[0], d) for d, t in kept if t) == [
        ("t0w0", None), ("t1w0", None), ("t2w0", None), ("t3w0", 7), ("t4w0", 7), ("t5w0", 7)]
    assert sorted(str(d) for d, t in kept if t is None) == ["7", "None"]


def test_a_large_group_of_copies_has_as_many_pairs_as_members(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(300)] = f"n{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in near_dedup.near_classes(df).collect()} == {0}


def test_whole_texts_go_to_workers_in_batches_of_bounded_bytes(spark, monkeypatch):
    """Shingles of both texts of a pair are longer than the texts, and a batch had up to 10,000 pairs."""
    before = spark.conf.get(session.ARROW_BYTES, None)
    spark.conf.unset(session.ARROW_BYTES)
    seen = {}
    first = near_dedup.materialise

    def written(df, name):
        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])
        if name == "signatures":  # a worker of this session is handed rows of 8 kB
            rows = spark.range(0, 2000, 1, 1).selectExpr("cast(repeat('x', 8000) as binary) as s")
            seen["sizes"] = rows.mapInArrow(sizes, "n long, bytes long").collect()
        seen[name] = int(spark.conf.get(session.ARROW_BYTES, str(1 << 40)))
        return first(df, name)
    monkeypatch.setattr(near_dedup, "materialise", written)
    try:
        words = [" ".join(f"w{i % 3}x{j}" for j in range(40)) + f" end{i}" for i in range(9)]
        df = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
        got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(df).collect()}
        assert got == {i: i % 3 for i in range(9)}
        assert {"signatures", "sets", "links"} <= set(seen)
        assert all(seen[x] == session.BATCH_BYTES for x in ("signatures", "sets", "links"))
        assert sum(r["n"] for r in seen["sizes"]) == 2000
        assert max(r["bytes"] for r in seen["sizes"]) <= session.BATCH_BYTES + 20_000
        spark.conf.set(session.ARROW_BYTES, "12345")  # a bound of the session's own stays
        session.bound_batches(spark)
        assert spark.conf.get(session.ARROW_BYTES) == "12345"
    finally:
        spark.conf.unset(session.ARROW_BYTES)
        if before is not None:
            spark.conf.set(session.ARROW_BYTES, before)


def test_signatures_estimate_weighted_similarity():
    a = b" ".join([b"a b c d e"] * 30 + [b"q r s t u v w"] * 5)
    b = b" ".join([b"a b c d e"] * 20 + [b"q r s t u v w"] * 6)
    for by_count in (False, True):
        x, w, sizes = near_dedup.weighted(*near_dedup.shingles([a, b]), by_count)
        n = sizes[0]
        true = near_dedup.similarity((x[:n], w[:n]), (x[n:], w[n:]))
        agree = [np.mean(np.equal(*near_dedup.signatures(x, w, sizes, 80, seed))) for seed in range(40)]
        assert abs(np.mean(agree) - true) < 0.04


def test_shingle_hashes_are_those_of_the_words(documents):
    texts = [r["text"] for r in documents.collect()] + ["", " ", "a", "y" * 9000 + " z", "\n a  b\tc d\r\ne f "]
    hashes, counts = near_dedup.shingles([t.encode() for t in texts])
    names, at = {}, 0
    for t, n in zip(texts, counts.tolist()):
        words = t.split()
        own = [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        assert len(own) == n
        for s, h in zip(own, hashes[at:at + n].tolist()):
            assert names.setdefault(s, h) == h
        at += n
    assert len(set(names.values())) == len(names)


def test_components_of_a_long_chain(spark):
    order = list(range(60))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(f"{a:03}", f"{b:03}") for a, b in zip(order, order[1:])] + [("900", "901")], "a string, b string")
    got = {r["node"]: r["component"] for r in near_dedup.components(links).collect()}
    assert got == {f"{i:03}": "000" for i in range(60)} | {"900": "900", "901": "900"}


def test_equal_substrings_share_phrases_at_any_offset():
    rng = random.Random(6)
    body = "".join(rng.choice("etaoin shrdlu") for _ in range(20_000))
    whole = fingerprints.sketches([body])[0]
    for front in ("x", "some other words ", "q" * 101):
        assert fingerprints.alike(whole, fingerprints.sketches([front + body])[0]) >= 0.9
    other = "".join(rng.choice("etaoin shrdlu") for _ in range(20_000))
    assert fingerprints.alike(whole, fingerprints.sketches([other])[0]) < 0.1


def test_labels_of_neighbours_differ():
    rng = np.random.default_rng(2)
    names = np.repeat(rng.integers(0, 2 ** 63, 5000, dtype=np.uint64), 1)
    lab = fingerprints.labels(names, np.array([0, 1000]))
    assert (lab[1:] != lab[:-1])[np.arange(1, 5000) != 1000].all() and lab.max() < 8


def test_batches_and_slabs_change_nothing(documents, monkeypatch):
    texts = [r["text"] for r in documents.collect()] + ["", "a", "aaaa", "ab" * 5000, "z" * 9000]
    alone = [fingerprints.as_text(fingerprints.sketches([t])[0]) for t in texts]
    monkeypatch.setattr(fingerprints, "SLAB", 1000)
    monkeypatch.setattr(fingerprints, "BATCH_CHARS", 5000)
    assert [fingerprints.as_text(s) for s in fingerprints.in_batches(texts, fingerprints.SKETCH)] == alone


@pytest.mark.parametrize("partitions", [1, 7])
def test_comparison_with_the_next_document(spark, documents, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["doc_id"]: r for r in fingerprints.compare_with_next(documents).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    assert len(got) == len(rows)
    for (i, text), (_, other) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edit = text[:len(text) - half] + other[:half]
        a, b, c = fingerprints.sketches([text, edit, other])
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprints.as_text(a), fingerprints.as_text(b))
        assert (r["near_edited"], r["near_next"]) == (fingerprints.alike(a, b), fingerprints.alike(a, c))


def top_by_hand(rows, k=20, every=20):
    clean = sorted({(i, tuple(int(np.floor(64 * float(x))) for x in v)) for i, v in rows if i is not None
                    and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    queries = {}
    for i, v in clean:
        if i % every == 0:
            queries.setdefault(i, v)
    out = []
    for i, v in queries.items():
        best = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), j)
                      for j, w in clean if j != i)[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block_rows", [(4096, 1024), (20, 3)])
def test_top_k(spark, shard_rows, block_rows):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    same = [(10 ** 6 + i, rows[3][1]) for i in range(50)]  # ties
    df = df.unionByName(spark.createDataFrame(same, df.schema))
    got = ball_tree.top_k(df, shard_rows=shard_rows, block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == top_by_hand(rows + same)


@pytest.mark.parametrize("n", [1000, 2])
def test_top_k_of_odd_vectors(spark, n):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [1e30, 1.0, 3.0]), (40, [float("nan")]), (60, None), (80, []),
            (None, [1.0]), (3, [1.0, None]), (4, [-1e30]), (5, [1.0, 2.0]), (6, [1.0, 2.0]), (120, [float("inf")]),
            (100, [0.5, -0.01, 0.0, 7.0]), (7, [2e5] * 3), (7, [2e5] * 4), (8, [1e200, -1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ball_tree.top_k(df, shard_rows=n, block_rows=n).collect())) == top_by_hand(rows)
    assert ball_tree.top_k(df.limit(0)).count() == 0


def test_bounds_cut_off_most_of_a_tree():
    rng = np.random.default_rng(3)
    centres = rng.integers(-2000, 2000, (16, 8))
    points = (centres[rng.integers(0, 16, 4096)] + rng.integers(-20, 20, (4096, 8))).astype(float)
    order, nodes = ball_tree.build(points)
    ids = np.arange(4096, dtype=np.int64)
    block = ball_tree.Block(ids[:1], points[:1], 20)
    seen = []
    score = block.score
    block.score = lambda rows, queries, own, leaf, whole: (seen.append(len(own)), score(rows, queries, own, leaf, whole))
    block.search(ids[order], points[order], nodes)
    want = np.lexsort((ids[1:], -(points[1:] @ points[0])))[:20] + 1
    assert block.found[0].tolist() == want.tolist() and sum(seen) < 1000
