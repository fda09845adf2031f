"""The audit of sources against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from starmart.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, least=30, top=50):
    """Every cell, term by term and source by source."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = [t.translate(SMALL) for t in TERM.findall(text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q, p = share(whole), {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(x, sum(abs(p[s][t] - p[x][t]) for t in kept)) for x in sources - {s}]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i) for i, (item, v) in enumerate(found[:limit], 1)]
    return sorted(out)


def found(df, **settings):
    return sorted(tuple(r) for r in divergence.audit(df, **settings).select(
        "lang", "source", "part", "item", "value", "rank").collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("lang", "source", "text").collect()]
    assert found(documents) == by_hand(rows)


@pytest.mark.parametrize("held", [3, 150_000])
def test_hot_texts_and_sources(spark, held, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_COUNTS", held)
    rng = random.Random(1)
    words = ["Été", "the", "THE", "a1b", "naïve", "x", "ÀB", "zz-top", "__", "42", "\x00q", "日本"]
    rows = [(rng.choice(["en", "fr", None]), f"s{rng.randrange(5)}", " ".join(rng.choices(words, k=rng.randrange(9))))
            for _ in range(400)]
    rows += [("en", "s0", "the same hot text")] * 300 + [("en", "s1", "the same hot text")] * 9
    rows += [("xx", "a", "rare"), ("xx", "b", None), ("xx", None, ""), ("en", "silent", "12 34"), (None, None, None)]
    assert found(frame(spark, rows).repartition(3), least_documents=4, top_terms=3) == by_hand(rows, 4, 3)


def test_copies_are_tokenized_once(spark):
    rows = [("en", f"s{i % 2}", "one text") for i in range(50)] + [("de", "s0", "one text")]
    got = {(r["lang"], bytes(r["text"])): sorted((s["source"], s["copies"]) for s in r["sources"])
           for r in divergence.collapsed(frame(spark, rows)).collect()}
    assert got == {("en", b"one text"): [("s0", 25), ("s1", 25)], ("de", b"one text"): [("s0", 1)]}


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = "Some longer wörds, äöü and averyverylongword end".encode()
    assert b"".join(divergence.pieces(text)) == text
    held = {}
    assert divergence.add_terms(held, text, [(("en", "s"), 2)]) == 7
    assert held["en", "s"] == ({t: 2 for t in text.translate(divergence.LETTERS).split()},) * 2


def test_edges(spark, edges, edge_rows):
    rows = [(r[2], r[3], r[1]) for r in edge_rows]
    assert found(edges, least_documents=1) == by_hand(rows, 1)
    assert found(edges.limit(0)) == []
    # no term is kept: sources are still compared
    assert found(frame(spark, [("en", "b", "x"), ("en", "a", "x"), ("en", "c", "x")])) == by_hand(
        [("en", "b", "x"), ("en", "a", "x"), ("en", "c", "x")])


def test_shares_of_great_counts(spark):
    from pyspark.sql import functions as F
    row = spark.range(1).select(divergence.share(F.lit(10 ** 17), F.lit(3 * 10 ** 17), F.lit(7).cast("long"))).first()
    assert row[0] == 1 + 10 ** 9 * (10 ** 17 + 5) // (3 * 10 ** 17 + 35)
