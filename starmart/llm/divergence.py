"""How far the sources of a language differ in their words.

Copies are counted, not read: identical texts of a language are put together first, with the
number of copies each source has, and tokenized once. A text's terms then add to its sources'
counts by these multiplicities, and its document frequencies likewise. A task adds up what it has
read in tables of bounded size before anything is sent on, one row a term with the counts of its
sources, so a frequent term or a hot source is sent once per task and table.

Shares are compared on what occurs. A term that a source doesn't have gets the source's base
share, so with base shares b and shares p the sum over the V kept terms of a language is

    V |b1 - b2|  +  Σ terms of 1 (|p1 - b2| - |b1 - b2|)  +  Σ terms of 2 (|p2 - b1| - |b1 - b2|)
                 +  Σ terms of both (|p1 - p2| + |b1 - b2| - |p1 - b2| - |p2 - b1|),

where only the last sum needs two sources side by side. Everything is whole numbers: shares are
parts in 10^9, rounded down by integer division of decimals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import text_or_empty
from starmart.session import materialise

LEAST_DOCUMENTS, SMOOTHING, SCALE, TOP_TERMS = 30, 5, 10 ** 9, 50
#: A task sends its counts on when it has this many.
HELD_COUNTS = 150_000
#: A long text is taken in pieces of about so many bytes, cut between terms.
PIECE = 1 << 20
#: Bytes by what they are in a term: letters small, all other ASCII characters a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
COUNTS = "lang string, term binary, sources array<struct<source:string,n:long,docs:long>>"


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces; no term goes over an edge."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and LETTERS[text[end]] != 32:
            end += 1
        yield text[at:end]
        at = end


def add_terms(held: dict, text: bytes, owners: list[tuple[tuple, int]]) -> int:
    """Add the terms of a text to its owners' tables; how many entries are new.

    ``held``: by owner, the occurrences and the documents of each term.
    """
    seen: Counter[bytes] = Counter()
    for piece in pieces(text):
        seen.update(piece.translate(LETTERS).split())
    new = 0
    for owner, copies in owners:
        counts, docs = held.setdefault(owner, ({}, {}))
        before = len(counts)
        for term, n in seen.items():
            counts[term] = counts.get(term, 0) + n * copies
            docs[term] = docs.get(term, 0) + copies
        new += len(counts) - before
    return new


def _by_term(held: dict) -> Iterator[pa.RecordBatch]:
    """Per language, one row a term with the counts of its sources."""
    for lang in {lang for lang, _ in held}:
        place: dict[bytes, int] = {}
        names, rows, own, n, docs = [], [], [], [], []
        for (other, source), (counts, of) in held.items():
            if other == lang:
                rows.append(np.fromiter((place.setdefault(t, len(place)) for t in counts), np.int64, len(counts)))
                own.append(np.full(len(counts), len(names)))
                n.append(np.fromiter(counts.values(), np.int64, len(counts)))
                docs.append(np.fromiter(of.values(), np.int64, len(counts)))
                names.append(source)
        at = np.concatenate(rows)
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(np.bincount(at, minlength=len(place)))
        entries = pa.StructArray.from_arrays(
            [pa.array(names, pa.string()).take(pa.array(np.concatenate(own)[order])),
             pa.array(np.concatenate(n)[order]), pa.array(np.concatenate(docs)[order])], ["source", "n", "docs"])
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(place), pa.string()), "term": pa.array(list(place), pa.binary()),
            "sources": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), entries)})


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict = {}
    entries = 0
    for batch in batches:
        for lang, text, sources in zip(*(batch.column(c) for c in ("lang", "text", "sources"))):
            owners = [((lang.as_py(), s["source"]), s["copies"]) for s in sources.as_py()]
            entries += add_terms(held, text.as_py(), owners)
            if entries > HELD_COUNTS:
                yield from _by_term(held)
                held.clear()
                entries = 0
    yield from _by_term(held)


def collapsed(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Each different text of a language once: ``lang``, ``text`` (bytes), and ``sources``, a list of
    ``source`` and ``copies``. Nulls are empty strings.

    Texts are told apart by their SHA-256. Copies are brought together within each task first.
    The list of a text has one entry per source, whatever the number of copies.
    """
    rows = df.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
                     text_or_empty(text_col).cast("binary").alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("copies"))
    sources = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "copies")).alias("sources"))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(sources, ["lang", "digest"]).select("lang", "text", "sources")


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, its occurrences ``n`` and the documents ``docs`` it is in."""
    found = collapsed(df, text_col, lang_col, source_col).mapInArrow(_count_terms, COUNTS)
    return (found.withColumn("term", F.col("term").cast("string")).repartition("lang", "term")
            .select("lang", "term", F.inline("sources")).groupBy("lang", "term", "source")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE × (n + 5) / (total + 5 V)), exact for any counts of 64 bits."""
    up = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTHING).cast("decimal(20,0)")
    return F.call_function("div", up, (total + SMOOTHING * terms).cast("decimal(20,0)")) + 1


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Per language and source: how far it is from every other source of the language (part
    ``pair``, greatest first) and the ``top_terms`` terms it has most in excess of the language
    (part ``term``); with ``item``, ``value`` in parts of 10^9, and ``rank``.

    Terms are runs of letters and of characters beyond ASCII, with A to Z in lower case; a language
    keeps those that are in at least ``least_documents`` of its documents, copies counted. Null
    texts, languages and sources count as empty strings. A source without a term is compared like
    any other; in a language without kept terms all values are 0. Equal values go by the bytes of
    the item. Repeated rows count as often as they occur, an empty table gives an empty result,
    and other columns are not looked at.
    """
    groups = df.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source")).distinct()
    # counts come out dealt by language and term; a term has one row per source at most
    term = Window.partitionBy("lang", "term")
    own = (term_counts(df, text_col, lang_col, source_col)
           .select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"),
                   F.sum("docs").over(term).alias("docs"),
                   F.row_number().over(term.orderBy("source")).alias("of_term"))
           .where(F.col("docs") >= least_documents).drop("docs"))
    own = materialise(own, "kept-terms")
    langs = own.groupBy("lang").agg(F.count_if(F.col("of_term") == 1).alias("v"), F.sum("n").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    base = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(
        0, ["total", "v", "lang_total"])
    nothing = F.lit(0).cast("long")
    base = base.withColumn("b", F.when(F.col("v") > 0, share(nothing, F.col("total"), F.col("v"))).otherwise(0))
    base = materialise(base, "sources")  # one row per language and source

    shares = own.join(base, ["lang", "source"]).select(
        "lang", "source", "term", "b", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))

    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    # equal shares of a source are taken together; against every other source of the language
    alone = shares.groupBy("lang", "source", "p", "b").agg(F.count("*").alias("terms"))
    others = base.select("lang", F.col("source").alias("item"), F.col("b").alias("other_b"))
    one_sided = (alone.join(others, "lang").where(F.col("source") != F.col("item")).groupBy("lang", "source", "item")
                 .agg(F.sum(F.col("terms") * (gap("p", "other_b") - gap("b", "other_b"))).alias("value")))
    x, y = shares.alias("x"), shares.alias("y")
    both = (x.join(y, (F.col("x.lang") == F.col("y.lang")) & (F.col("x.term") == F.col("y.term"))
                   & (F.col("x.source") < F.col("y.source")))  # at most one row per source and term
            .groupBy("x.lang", F.col("x.source").alias("source"), F.col("y.source").alias("item"))
            .agg(F.sum(gap("x.p", "y.p") + gap("x.b", "y.b") - gap("x.p", "y.b") - gap("y.p", "x.b")).alias("value")))
    absent = (base.join(others, "lang").where(F.col("source") != F.col("item"))
              .select("lang", "source", "item", (F.col("v") * gap("b", "other_b")).alias("value")))
    turned = ["lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"]
    pairs = (absent.unionByName(one_sided).unionByName(one_sided.select(*turned))
             .unionByName(both).unionByName(both.select(*turned))
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    excess = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked_terms = excess.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked_terms)
