"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into pre-tokens by a pattern, and each pre-token's bytes are merged by the ranks of
the vocabulary. The merging of a pre-token is independent of its neighbours; finding the
pre-tokens is a left-to-right scan. But the pattern never looks back: from a boundary on, the cut
depends only on what follows. So a long text is cut into chunks that overlap, each chunk is
scanned on its own by some task, and two neighbours are stitched at the first place in the
overlap where both have a boundary: from there on the right one's cut is the true one. A
boundary close to the end of a chunk does not count, as the pattern may look further. If no
boundary agrees, because one pre-token is longer than the overlap, the rest of the text is
scanned from the last sure boundary.

Encoded texts are kept as packed ids, unsigned 32-bit little-endian, in a binary column: four
bytes a token, and the form that training jobs map into memory. Decoding joins the tokens' bytes,
whether or not they are valid UTF-8.

An executor has several Python workers at a time, and any of them may encode now and decode later. So
rows go to them in batches of bounded bytes, decoding needs no more than the tokens' bytes, and the
pre-tokens that a worker remembers are bounded in bytes, whatever the script.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import free_name, per_text, quoted, without
from starmart.session import bound_batches

#: What the pattern may look at beyond a pre-token's end.
LOOKAHEAD = 2
#: Pre-tokens remembered in each of two tables: how many, of how many bytes with their ids, how long.
MAX_WORDS, MAX_BYTES, KEPT_WORD = 100_000, 12 << 20, 40
#: What the classes of a pattern are within ASCII.
ASCII_CLASSES = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r"\t-\r "}
#: Ids decoded at a time.
IDS_AT_ONCE = 1 << 20


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def of_ascii(pattern: str) -> re.Pattern | None:
    """The pattern for texts of ASCII characters alone, in the standard library's faster form, or
    None if it has classes not known here."""
    parts = re.split(r"(\[[^\]]*\])", pattern)
    for i, part in enumerate(parts):
        for name, characters in ASCII_CLASSES.items():
            part = part.replace(name, characters if i % 2 else f"[{characters}]")
        parts[i] = part if i % 2 else part.replace(r"\S", rf"[^{ASCII_CLASSES[r'\s']}]")
    found = "".join(parts)
    return None if regex.search(r"\\[pPSwWdDbB]", found) else re.compile(found)


class Tokens:
    """The bytes of every token by its id; all that decoding needs."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.table = pa.array(tokens, pa.binary())

    def decoded(self, packed: pa.Array) -> pa.Array:
        """The bytes that the packed ids of each row stand for."""
        rows = packed.to_pylist()
        ids = np.frombuffer(b"".join(x for x in rows if x), "<u4").astype(np.uint32, copy=False)
        lengths = np.array([len(x or b"") for x in rows], dtype=np.int64)
        if (lengths % 4).any():
            raise ValueError("packed ids are not whole")
        if len(ids) and ids.max() >= len(self.table):
            raise IndexError("token index out of range")
        borders, places, data, at = np.cumsum([0, *lengths // 4]), [], [], 0
        for i in range(0, len(ids), IDS_AT_ONCE):
            taken = self.table.take(pa.array(ids[i:i + IDS_AT_ONCE]))
            ends = np.frombuffer(taken.buffers()[1], np.int32)[:len(taken) + 1]
            first, last = np.searchsorted(borders, [i, i + len(taken)])
            places += (ends[borders[first:last] - i].astype(np.int64) + at).tolist()
            if ends[-1]:
                data.append(memoryview(taken.buffers()[2])[:ends[-1]])
            at += int(ends[-1])
        places += [at] * (len(borders) - len(places))
        whole = b"".join(data)
        return pa.array([None if x is None else whole[a:b] for x, a, b in zip(rows, places, places[1:])], pa.binary())

    def decode(self, packed: bytes) -> bytes:
        return self.decoded(pa.array([packed], pa.binary()))[0].as_py()


class Vocabulary(dict):
    """The vocabulary, and packed ids of the pre-tokens met lately, by pre-token.

    The merging of one pre-token is left to the tokenizer library, which does it in a microsecond.
    The table is bounded: a full one is put aside, and what is still in use moves to the next.
    """

    def __init__(self, path: str, pattern: str):
        super().__init__()
        ranks = ranks_of(path)
        self.tokens = tokens_of(path)
        self.merged = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                        special_tokens={})._encode_single_piece
        # white space is the Unicode property, as in the pattern's own library
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}")
                                     .replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.ascii_pattern = of_ascii(pattern) or self.pattern
        self.aside: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, piece: str) -> bytes:
        packed = self.aside.get(piece)
        if packed is None:
            packed = self.piece(piece)
        if len(piece) <= KEPT_WORD:
            size = sys.getsizeof(piece) + sys.getsizeof(packed)
            if len(self) >= MAX_WORDS or self.held + size > MAX_BYTES:
                self.aside, self.held = dict(self), 0
                self.clear()
            self[piece] = packed
            self.held += size
        return packed

    def piece(self, piece: str) -> bytes:
        """Packed ids of one pre-token."""
        ids = array("I", self.merged(piece))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def pieces(self, text: str) -> list[str]:
        """The text cut into pre-tokens."""
        return (self.ascii_pattern if text.isascii() else self.pattern).findall(text)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))

    def decode(self, packed: bytes) -> bytes:
        return self.tokens.decode(packed)


@cache
def tokens_of(path: str) -> Tokens:
    return Tokens(ranks_of(path))


@cache
def vocabulary_of(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def scan(piece: str, start: int, vocabulary: Vocabulary) -> dict:
    """A chunk on its own: the ends of its pre-tokens in the text, and their packed ids."""
    found = vocabulary.pieces(piece)
    packed = [vocabulary[x] for x in found]
    return {"ends": np.cumsum([len(x) for x in found], dtype=np.int64) + start,
            "sizes": np.array([len(x) for x in packed], dtype=np.int64), "packed": b"".join(packed)}


def stitched(chunks: list[dict], chunk_chars: int, vocabulary: Vocabulary) -> bytes:
    """Packed ids of the whole text. Each chunk: ``piece``, ``ends``, ``sizes``, ``packed``."""
    out, at = [], 0  # at: up to here the text is encoded
    for i, c in enumerate(chunks):
        start, last = i * chunk_chars, i + 1 == len(chunks)
        ends = np.array(c["ends"], dtype=np.int64)
        starts = np.concatenate([[start], ends[:-1]]) if len(ends) else ends
        begin = int(np.searchsorted(starts, at))
        if begin == len(starts) or starts[begin] != at:
            raise AssertionError("the chunk has no boundary where the one before it stopped")
        if last:
            stop = len(ends)
        else:
            other = chunks[i + 1]
            sure = ends[(ends >= start + chunk_chars) & (ends <= start + len(c["piece"]) - LOOKAHEAD)]
            theirs = np.array([start + chunk_chars, *other["ends"][:-1]])
            agreed = np.intersect1d(sure[sure > at], theirs)
            if not len(agreed):
                break
            stop = int(np.searchsorted(ends, agreed[0])) + 1
        places = np.concatenate([[0], np.cumsum(c["sizes"])]).astype(np.int64)
        out.append(c["packed"][places[begin]:places[stop]])
        at = int(ends[stop - 1])
    else:
        return b"".join(out)
    rest = "".join(c["piece"][:chunk_chars] for c in chunks[i:])[at - i * chunk_chars:]
    return b"".join(out) + vocabulary.encode(rest)


def _scanned_chunks(chunks: DataFrame, vocabulary: str, pattern: str, chunk_chars: int) -> DataFrame:
    """Every chunk scanned on its own: ``digest``, ``chunk``, ``piece`` and ``scan``."""
    @F.arrow_udf("struct<ends:array<long>,sizes:array<long>,packed:binary>")
    def scanned(pieces: pa.Array, starts: pa.Array) -> pa.Array:
        v = vocabulary_of(vocabulary, pattern)
        return pa.array([scan(p.as_py(), s.as_py(), v) for p, s in zip(pieces, starts)], pa.struct([
            ("ends", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("packed", pa.binary())]))

    start = F.col("chunk").cast("long") * chunk_chars
    return chunks.select("digest", "chunk", "piece", scanned("piece", start).alias("scan"))


def encode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", out: str = "ids",
           chunk_chars: int = 65_536, overlap: int = 512) -> DataFrame:
    """Every row with the packed ids of its text in the binary column ``out``.

    ``vocabulary``: path of a rank file, readable on every executor; ``pattern``: the expression
    that cuts pre-tokens. Texts of more than ``chunk_chars`` characters are scanned in chunks
    spread over tasks; the ids do not depend on the chunks. A null or empty text has no ids (an
    empty binary), repeated rows are each encoded, an empty table gives an empty result, and an
    input column named ``out`` is replaced.
    """
    bound_batches(df.sparkSession)

    @F.arrow_udf("binary")
    def whole(texts: pa.Array) -> pa.Array:
        v = vocabulary_of(vocabulary, pattern)
        return pa.array([v.encode(t.as_py() or "") for t in texts], pa.binary())

    def stitch(chunks: pd.DataFrame) -> pd.DataFrame:
        rows = chunks.sort_values("chunk")
        packed = stitched([{**s, "piece": p} for s, p in zip(rows["scan"], rows["piece"])], chunk_chars,
                          vocabulary_of(vocabulary, pattern))
        return pd.DataFrame({"digest": chunks["digest"][:1], "result": [packed]})

    def by_chunks(chunks: DataFrame) -> DataFrame:
        return (_scanned_chunks(chunks, vocabulary, pattern, chunk_chars)
                .groupBy("digest").applyInPandas(stitch, "digest string, result binary"))

    return per_text(df, text_col, out, whole, by_chunks, chunk_chars, overlap)


def encode_checked(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", out: str = "ids",
                   same: str = "decodes", chunk_chars: int = 65_536, overlap: int = 512) -> DataFrame:
    """Like ``encode``, and in the column ``same`` whether the ids decode to the text's bytes.

    Both are found in one evaluation, so that an executor needs one worker a task and the ids
    don't go to and fro. A null text counts as an empty one.
    """
    bound_batches(df.sparkSession)

    @F.arrow_udf("struct<ids:binary,same:boolean>")
    def whole(texts: pa.Array) -> pa.Array:
        v = vocabulary_of(vocabulary, pattern)
        ids = pa.array([v.encode(t.as_py() or "") for t in texts], pa.binary())
        fits = [d.as_py() == (t.as_py() or "").encode() for d, t in zip(v.tokens.decoded(ids), texts)]
        return pa.StructArray.from_arrays([ids, pa.array(fits, pa.bool_())], ["ids", "same"])

    def stitch(chunks: pd.DataFrame) -> pd.DataFrame:
        v = vocabulary_of(vocabulary, pattern)
        rows = chunks.sort_values("chunk")
        packed = stitched([{**s, "piece": p} for s, p in zip(rows["scan"], rows["piece"])], chunk_chars, v)
        text = "".join(p[:chunk_chars] for p in rows["piece"])
        return pd.DataFrame({"digest": chunks["digest"][:1], "ids": [packed], "same": [v.decode(packed) == text.encode()]})

    def by_chunks(chunks: DataFrame) -> DataFrame:
        return (_scanned_chunks(chunks, vocabulary, pattern, chunk_chars)
                .groupBy("digest").applyInPandas(stitch, "digest string, ids binary, same boolean")
                .select("digest", F.struct("ids", "same").alias("result")))

    both = free_name(df, "__encoded")
    found = per_text(df, text_col, both, whole, by_chunks, chunk_chars, overlap)
    kept = without(df, [out, same])
    return found.select(*map(quoted, kept), F.col(both)["ids"].alias(out), F.col(both)["same"].alias(same))


def decode(df: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids",
           out: str = "decoded") -> DataFrame:
    """Every row with the bytes that its packed ids stand for. Null ids give null; an id that the
    vocabulary does not have is an error."""
    bound_batches(df.sparkSession)

    @F.arrow_udf("binary")
    def joined(packed: pa.Array) -> pa.Array:
        return tokens_of(vocabulary).decoded(packed)

    return df.select(*map(quoted, without(df, [out])), joined(quoted(ids_col)).alias(out))
