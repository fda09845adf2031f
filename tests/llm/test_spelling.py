"""Spelling variants against plain Python: every pair of words, tried edit by edit."""

import random
import re
import zlib
from collections import Counter

import pytest

from starmart.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def words_by_hand(rows):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(counts):
    out = {}
    for w, n in counts.items():
        others = [x for x in counts if abs(len(x) - len(w)) <= 1 and near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        out[w] = best if best is not None and counts[best] >= 10 * n else None, n, len(others)
    rows = []
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, k, None if form is None else counts[form]))
    return sorted(rows)


def found(df):
    return sorted(tuple(r) for r in spelling.variants(df).select(
        "word", "form", "root", "n", "n_near", "form_n").collect())


def test_documents(spark, documents):
    few = documents.where("doc_id < 60")
    rows = [tuple(r) for r in few.select("doc_id", "text").collect()]
    assert found(few) == by_hand(words_by_hand(rows))


def test_chains_of_forms_and_accents(spark):
    counts = {"abcdefghijk": 3000, "abcdefghij": 250, "abcdefghi": 20, "abcdefgh": 2, "Überzÿgt": 50, "Überzÿg": 5,
              "überzÿgt": 3, "zzzzzzz×": 7, "zzzzzzz÷": 7, "zzzzzzzz": 70}
    rows = [(i, " ".join([w] * n)) for w, n in counts.items() for i in (1, 2)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == by_hand(words_by_hand(rows))
    assert {w: r for w, _, r, *_ in got}["abcdefgh"] == "abcdefghijk"


@pytest.mark.parametrize("tile, cells", [(4, 300), (1024, 1 << 21)])
def test_near_words_of_one_hot_half(spark, monkeypatch, tile, cells):
    monkeypatch.setattr(spelling, "CELLS", cells)
    rng = random.Random(5)
    words = {"prefixes" + "".join(rng.choices("abc", k=rng.randrange(0, 6))) for _ in range(150)}
    words |= {"".join(rng.choices("ab", k=rng.randrange(1, 9))) for _ in range(120)}
    words |= {"日本語の単語", "日本語単語", "日本語の単吾", "a", "", "\0a", "a\0", "x" * 5000, "x" * 4999, "\U0001F600x", "x"}
    counts = {w: rng.randrange(1, 2000) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = {}
    for w in words:
        others = [x for x in words if abs(len(x) - len(w)) <= 1 and near(w, x)]
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            want[w] = len(others), counts[best], best
    assert {r["word"]: (r["n_near"], r["best_n"], r["best"])
            for r in spelling.near_words(df, tile=tile).collect()} == want


def test_many_roots_in_few_rounds(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(17)]
    got = spelling.with_roots(spark.createDataFrame(forms, "word string, form string"), 10 ** 17).collect()
    assert {tuple(r) for r in got} == {(f"w{i}", "w17") for i in range(17)}


def test_edges(spark, edges, edge_rows, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 1000)
    monkeypatch.setattr(spelling, "HELD_WORDS", 2)
    rows = [r[:2] for r in edge_rows] + [(20, "y" * 69_999), (21, "y" * 69_999), (22, "y" * 70_000)]
    df = edges.select("doc_id", "text", "rank").unionByName(
        spark.createDataFrame(rows[len(edge_rows):], "doc_id long, text string"), allowMissingColumns=True)
    assert found(df) == by_hand(words_by_hand(rows))
    assert found(edges.limit(0)) == []
