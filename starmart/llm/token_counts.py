"""Token counts by a tokenizer compiled to finite-state transducers.

Two transducers, one after the other, do what the tokenizer of the vocabulary file does.

* The outer one reads normalised text and cuts it into words (pre-tokens).
* The inner one reads the bytes of a word and emits token counts: every transition carries the
  number by which the count of the word's tokens changes when the byte is read, and the last
  byte, which carries the end-of-word mark, leads back to the start.

The inner one rests on a property of byte-pair merging: a row of tokens is the encoding of its
text exactly if each two neighbours are the encoding of theirs. So the last token of a prefix is
the one token that ends there and fits the last token of what is before it, and the future
depends only on those places from which a longer token may still grow. Those places (the node
of the vocabulary's trie, the last token before, the count there) are the state. States and
transitions are made when a text first needs them, the way lazy determinisation does it, and are
kept in a bounded table for the next words; whole words that were read before are kept as one
step from start to start.

Long texts are read in chunks. What a chunk does to the state is a map: given the open word that
comes in, the count and the open word that goes out. As a boundary resets the inner transducer,
the map is written down by the text before the first boundary, the count between, and the text
after the last one. Such maps compose, associatively, so the chunks of one text are spread over
tasks, neighbours are composed in rounds as in a parallel prefix scan, and the last map gives
the count of the text.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass
from functools import cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import per_text, quoted, text_or_empty, without

#: The word pattern and the two whole-text marks of the vocabulary file. Fixed values. (White
#: space is the Unicode property, as there; the regex library's \\s has four characters more.)
WORD = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+""")
SPECIAL = regex.compile(r"<\|startoftext\|>|<\|endoftext\|>")
#: Characters at which str.split cuts although they are no white space.
SEPARATORS = regex.compile("[\x1c-\x1f]")
MAX_STATES, MAX_RUNS, KEPT_RUN = 150_000, 300_000, 40
OUTPUT = ("n_bytes", "n_tokens", "over_limit")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabularies of this kind: itself if
    it is printable Latin-1, otherwise the next free one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordTransducer:
    """The inner transducer of a merge list with end-of-word marks."""

    def __init__(self, merges: list[tuple[str, str]], end: str = "</w>"):
        alphabet = byte_alphabet()
        ids: dict[str, int] = {}

        def symbol(token: str) -> int:
            return ids.setdefault(token, len(ids))
        self.plain = {b: symbol(c) for c, b in alphabet.items()}
        self.final = {b: symbol(c + end) for c, b in alphabet.items()}
        self.merge = {}
        spelled = {i: ((b,), False) for b, i in self.plain.items()}
        spelled |= {i: ((b,), True) for b, i in self.final.items()}
        for rank, (a, b) in enumerate(merges):
            left, right, new = ids[a], ids[b], symbol(a + b)
            self.merge.setdefault((left, right), (rank, new))
            spelled.setdefault(new, (spelled[left][0] + spelled[right][0], spelled[right][1]))
        self.spelled = spelled
        # the trie: children by (node, byte); the token that ends at a node, or there with the mark
        self.child: dict[int, int] = {}
        self.token: dict[int, int] = {}
        self.end_token: dict[int, int] = {}
        self.inner: set[int] = {0}
        nodes = 1
        for i, (word, last) in spelled.items():
            node = 0
            for b in word[:-1] if last else word:
                key = node << 8 | b
                self.inner.add(node)
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                node = self.child[key]
            if last:
                self.end_token[node << 8 | word[-1]] = i
                self.inner.add(node)
            else:
                self.token[node] = i
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ((0, -1, 0),)
        self.number = {start: 0}
        self.state = [start]
        self.steps: list[dict[int, tuple[int, int]]] = [{}]
        self.ends: list[dict[int, int]] = [{}]

    def merged(self, symbols: list[int]) -> list[int]:
        """Plain merging, used on the spelling of two tokens only."""
        while len(symbols) > 1:
            found = [(*m, i) for i, p in enumerate(zip(symbols, symbols[1:])) if (m := self.merge.get(p))]
            if not found:
                break
            _, new, at = min(found)
            symbols[at:at + 2] = [new]
        return symbols

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens (or the one, after -1) are the encoding of their text."""
        key = (left + 1) << 32 | right
        known = self.pairs.get(key)
        if known is None:
            word, last = self.spelled[right]
            symbols = [self.plain[b] for b in word]
            if last:
                symbols[-1] = self.final[word[-1]]
            if left < 0:
                known = self.merged(symbols) == [right]
            else:
                known = self.merged([self.plain[b] for b in self.spelled[left][0]] + symbols) == [left, right]
            if len(self.pairs) > 4 * MAX_STATES:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def step(self, at: int, byte: int) -> tuple[int, int]:
        """The transition from a state by a byte within the word: next state, change of count."""
        grown, here = [], None
        for node, before, count in self.state[at]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token.get(node)
            if here is None and token is not None and self.fits(before, token):
                here = token, count + 1
            if node in self.inner:
                grown.append((node, before, count))
        token, change = here
        new = (*((node, before, count - change) for node, before, count in grown), (0, token, 0))
        to = self.number.get(new)
        if to is None:
            to = self.number[new] = len(self.state)
            self.state.append(new)
            self.steps.append({})
            self.ends.append({})
        self.steps[at][byte] = to, change
        return to, change

    def end(self, at: int, byte: int) -> int:
        """The transition by the last byte of the word, back to the start: change of count."""
        for node, before, count in self.state[at]:
            token = self.end_token.get(node << 8 | byte)
            if token is not None and self.fits(before, token):
                self.ends[at][byte] = count + 1
                return count + 1
        raise ValueError("the vocabulary lacks a byte")

    def count(self, word: bytes) -> int:
        if len(self.state) > MAX_STATES:
            self.reset()
        at = total = 0
        for byte in word[:-1]:
            found = self.steps[at].get(byte) or self.step(at, byte)
            at = found[0]
            total += found[1]
        return total + (self.ends[at].get(word[-1]) or self.end(at, word[-1]))


class Runs(dict):
    """Runs between white space that were already read, as one step from start to start.

    White space belongs to no word, so every such run begins and ends at the start state. The
    table is bounded: a full one is put aside, and what is still in use moves to the next.
    """

    def __init__(self, transducer: WordTransducer):
        super().__init__()
        self.transducer = transducer
        self.aside: dict[str, int] = {}

    def __missing__(self, run: str) -> int:
        n = self.aside.get(run)
        if n is None:
            count = self.transducer.count
            n = sum(count(word.encode()) for word in WORD.findall(run))
        if len(run) <= KEPT_RUN:
            if len(self) >= MAX_RUNS:
                self.aside = dict(self)
                self.clear()
            self[run] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of normalised text."""
        if SEPARATORS.search(text):
            return sum(self[word] for word in WORD.findall(text))
        return sum(map(self.__getitem__, text.split()))


@cache
def compiled(path: str) -> Runs:
    with open(path, encoding="utf-8") as f:
        merges = json.load(f)["model"]["merges"]
    return Runs(WordTransducer([tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]))


def normalised(text: str) -> str:
    """NFC, then lower case character by character (so that a final sigma is an ordinary one)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def count_tokens(text: str, runs: Runs) -> int:
    """Tokens of a whole text; a mark that stands for a whole text is one token."""
    total, parts = 0, [text]
    if "<|" in text:
        total, parts = len(SPECIAL.findall(text)), SPECIAL.split(text)
    return total + sum(runs.count(normalised(part)) for part in parts)


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does: the open run that comes in grows by ``head``; if the chunk has white
    space (``closed``), ``count`` tokens follow and ``tail`` is the open run that goes out."""
    head: str
    closed: bool
    count: int
    tail: str

    def then(self, other: ChunkMap, runs: Runs) -> ChunkMap:
        if not self.closed:
            return ChunkMap(self.head + other.head, other.closed, other.count, other.tail)
        if not other.closed:
            return ChunkMap(self.head, True, self.count, self.tail + other.head)
        between = count_tokens(self.tail + other.head, runs)
        return ChunkMap(self.head, True, self.count + between + other.count, other.tail)


BOUNDARY = regex.compile(r"\p{White_Space}+")


def chunk_map(chunk: str, runs: Runs) -> ChunkMap:
    first = BOUNDARY.search(chunk)
    if first is None:
        return ChunkMap(chunk, False, 0, "")
    last = max(chunk.rfind(m) for m in set(BOUNDARY.findall(chunk)))
    end = BOUNDARY.match(chunk, last).end()
    return ChunkMap(chunk[:first.start()], True, count_tokens(chunk[first.end():end], runs), chunk[end:])


def composed(maps: list[ChunkMap], runs: Runs) -> ChunkMap:
    """All maps in a row, neighbours first."""
    while len(maps) > 1:
        pairs = [a.then(b, runs) for a, b in zip(maps[::2], maps[1::2])]
        maps = pairs + maps[len(maps) // 2 * 2:]
    return maps[0]


def with_token_counts(df: DataFrame, vocabulary: str, text_col: str = "text", limit: int = 2048,
                      chunk_chars: int = 65_536) -> DataFrame:
    """Every row with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``vocabulary``: path of a word-level BPE file (JSON), readable on every executor. Texts of
    more than ``chunk_chars`` characters are read in chunks spread over tasks; the count does not
    depend on the chunks. A null text counts as an empty one: 0 bytes, 0 tokens. Repeated rows
    are each counted, an empty table gives an empty result, and input columns with the name of
    an output column are replaced.
    """
    @F.arrow_udf("long")
    def whole(texts: pa.Array) -> pa.Array:
        runs = compiled(vocabulary)
        return pa.array([count_tokens(t.as_py() or "", runs) for t in texts], pa.int64())

    @F.arrow_udf("struct<head:string,closed:boolean,count:long,tail:string>")
    def mapped(texts: pa.Array) -> pa.Array:
        runs = compiled(vocabulary)
        return pa.array([vars(chunk_map(t.as_py(), runs)) for t in texts], pa.struct([
            ("head", pa.string()), ("closed", pa.bool_()), ("count", pa.int64()), ("tail", pa.string())]))

    def count_text(chunks: pd.DataFrame) -> pd.DataFrame:
        runs = compiled(vocabulary)
        maps = [ChunkMap(**m) for m in chunks.sort_values("chunk")["map"]]
        m = composed(maps, runs)
        total = m.count + count_tokens(m.head, runs) + (count_tokens(m.tail, runs) if m.closed else 0)
        return pd.DataFrame({"digest": chunks["digest"][:1], "result": total})

    def by_chunks(chunks: DataFrame) -> DataFrame:
        return (chunks.select("digest", "chunk", mapped("piece").alias("map"))
                .groupBy("digest").applyInPandas(count_text, "digest string, result long"))

    kept = without(df, OUTPUT)
    counted = per_text(df, text_col, "n_tokens", whole, by_chunks, chunk_chars)
    n = quoted("n_tokens")
    return counted.select(*map(quoted, kept), F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"),
                          n, (n > limit).alias("over_limit"))
