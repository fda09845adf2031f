"""Encoding, decoding and counting against the libraries, with chunks of several sizes."""

import base64
import random
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmart import session
from starmart.llm import byte_bpe, token_counts
from starmart.llm.queries import RANKS, WORD_BPE

ODD = ["", None, "  ", "a", "a \n b  c\t d ", "Straße ΣΑΣ İstanbul ﬁ", "don't they'LL I'VE we're", "été É",
       "<|endoftext|>x<|startoftext|> <|endoftext|", "日本語テキスト 한국어", "½ ² ⅷ 123", "😀👨‍👩‍👧 ok", "a" * 5000,
       "ab" * 3000 + "!!!" * 500 + " 'r're''ve ll", "\x00\x01​ x", "a\x1cb \x1f \x85z\xa0q​z \x1c c", "x  ", "   x",
       "é" * 700 + " é " + "z" * 900, "e" + "́" * 900 + " x", "ǅ Ǆ ß ŉ ΐ ﬃ ᾳ ᾼ ẞ ς"]
PARTS = ["a", "'", "'re", "'ll", " ", "  ", "\n", "é", "é", "1", "12", "!", "<|endoftext|>", "\x1d", "日", "the", " of", "\xa0"]


@pytest.fixture(scope="module")
def texts(spark, documents):
    rng = random.Random(1)
    odd = ODD + ["".join(rng.choices(PARTS, k=rng.randint(1, 2000))) for _ in range(40)]
    return documents.select("doc_id", "text").unionByName(
        spark.createDataFrame(list(enumerate(odd, 10 ** 6)), "doc_id long, text string"))


@pytest.mark.parametrize("chunk, overlap", [(65_536, 512), (97, 11), (400, 60)])
def test_ids_are_the_library_s(texts, chunk, overlap):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = byte_bpe.encode(texts, RANKS, public_tokenizers.PATTERN, chunk_chars=chunk, overlap=overlap)
    for r in byte_bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect():
        text = r["text"] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()


@pytest.mark.parametrize("chunk", [65_536, 97])
def test_counts_are_the_library_s(texts, chunk):
    library = Tokenizer.from_file(WORD_BPE)
    for r in token_counts.with_token_counts(texts, WORD_BPE, limit=500, chunk_chars=chunk).collect():
        text = r["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 500)


def test_chunk_maps_compose_in_any_grouping():
    runs = token_counts.compiled(WORD_BPE)
    text = "the cat's  pyjamas\nandthensomelongrun " * 20
    rng = random.Random(2)
    for _ in range(20):
        cuts = sorted({0, len(text), *(rng.randrange(len(text)) for _ in range(9))})
        maps = [token_counts.chunk_map(text[a:b], runs) for a, b in zip(cuts, cuts[1:])]
        left = maps[0]
        for m in maps[1:]:
            left = left.then(m, runs)
        assert left == token_counts.composed(maps, runs)
        tail = token_counts.count_tokens(left.tail, runs)
        assert left.count + token_counts.count_tokens(left.head, runs) + tail == token_counts.count_tokens(text, runs)


def test_small_tables_change_nothing(monkeypatch):
    words = "these unrelated transformations thoroughly notwithstanding onheretionshon".split()
    whole = token_counts.compiled(WORD_BPE)
    want = [whole.count(w) for w in words]
    monkeypatch.setattr(token_counts, "MAX_STATES", 3)
    monkeypatch.setattr(token_counts, "MAX_RUNS", 2)
    small = token_counts.Runs(whole.transducer)
    assert [small.count(w) for w in words * 3] == want * 3
    vocabulary = byte_bpe.vocabulary_of(RANKS, public_tokenizers.PATTERN)
    text = " ".join(words * 4)
    want = vocabulary.encode(text)
    monkeypatch.setattr(byte_bpe, "MAX_WORDS", 2)
    assert byte_bpe.vocabulary_of.__wrapped__(RANKS, public_tokenizers.PATTERN).encode(text) == want


def test_remembered_pre_tokens_are_bounded_in_bytes():
    rng = random.Random(3)
    vocabulary = byte_bpe.vocabulary_of.__wrapped__(RANKS, public_tokenizers.PATTERN)
    for _ in range(60):
        text = " ".join("".join(map(chr, rng.choices(range(0x4E00, 0x9000), k=39))) for _ in range(1000))
        assert vocabulary.decode(vocabulary.encode(text)) == text.encode()
    held = [sum(sys.getsizeof(x) for item in table.items() for x in item) for table in (vocabulary, vocabulary.aside)]
    assert max(held) <= 12 << 20 and sum(held) > 12 << 20


def test_ids_decode_across_blocks(monkeypatch):
    vocabulary = byte_bpe.vocabulary_of(RANKS, public_tokenizers.PATTERN)
    texts = [None, "", "one two three", None, "", "日本 x" * 30, "a", ""]
    packed = pa.array([None if t is None else vocabulary.encode(t) for t in texts], pa.binary())
    for at_once in (1, 2, 7, 1 << 20):
        monkeypatch.setattr(byte_bpe, "IDS_AT_ONCE", at_once)
        assert vocabulary.tokens.decoded(packed).to_pylist() == [t if t is None else t.encode() for t in texts]
        assert vocabulary.tokens.decoded(packed[1:4]).to_pylist() == [b"", b"one two three", None]
        assert vocabulary.tokens.decoded(packed[:0]).to_pylist() == []
    with pytest.raises(ValueError):
        vocabulary.tokens.decoded(pa.array([b"abc", b"d"], pa.binary()))


def test_ascii_texts_are_cut_the_same_way():
    vocabulary = byte_bpe.vocabulary_of(RANKS, public_tokenizers.PATTERN)
    assert vocabulary.ascii_pattern is not vocabulary.pattern
    rng = random.Random(5)
    parts = [*map(chr, range(128)), "'re", "'ll", "  ", "\r\n", " the", "12", "\n\n"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=200))
        assert vocabulary.pieces(text) == vocabulary.pattern.findall(text)


def test_whole_texts_go_to_python_in_bounded_batches(spark, monkeypatch):
    per_text, before = byte_bpe.per_text, spark.conf.get(session.ARROW_BYTES, None)

    @F.arrow_udf("binary")
    def size_of_batch(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes.to_bytes(8, "little")] * len(texts), pa.binary())

    monkeypatch.setattr(byte_bpe, "per_text", lambda df, text, out, whole, *rest: per_text(
        df, text, out, size_of_batch, *rest))
    try:
        spark.conf.unset(session.ARROW_BYTES)
        df = spark.range(0, 3000, 1, 1).withColumn("text", F.repeat(F.lit("some words "), 500))
        sizes = [int.from_bytes(r["ids"], "little") for r in byte_bpe.encode(
            df, RANKS, public_tokenizers.PATTERN).select("ids").collect()]
        assert len(sizes) == 3000 and max(sizes) <= session.BATCH_BYTES + 20_000
        spark.conf.unset(session.ARROW_BYTES)
        byte_bpe.decode(spark.createDataFrame([], "ids binary"), RANKS, public_tokenizers.PATTERN)
        assert spark.conf.get(session.ARROW_BYTES) == str(session.BATCH_BYTES)
    finally:
        spark.conf.unset(session.ARROW_BYTES)
        if before is not None:
            spark.conf.set(session.ARROW_BYTES, before)
