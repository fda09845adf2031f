"""Language identification by a byte convolutional network.

A text is lower-cased, encoded as UTF-8 and cut into windows of a fixed number of bytes that
cover all of it. Filters of two, three and four bytes slide over a window; each keeps its
greatest value there (max pooling), and a softmax layer turns these values into a probability for
every language. The probabilities of a text's windows are averaged.

As the input is bytes, a filter is a table with a weight for each byte at each of its places. The
network is trained on the driver in numpy (Adam on cross-entropy; the gradient of max pooling
touches only the winning places) on a bounded sample of windows of labelled texts: at most
``DOCS`` texts for each language, chosen by hash, and ``SAMPLE`` texts in all, shared out evenly
where the languages are many, and ``WINDOWS`` windows of each. Every language of the table is
learned, however rare, and training takes longer the more there are. To apply it,
the tables of a filter are added up for pairs of bytes, so that a value takes two look-ups at
most, and all windows of a batch go through at once.
"""

from __future__ import annotations

import pickle
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import quoted, small_table, text_or_empty, without

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 8, 128
DOCS, WINDOWS, STEPS, BATCH, RATE = 400, 6, 400, 128, 0.01
#: So many texts are learned from in all, one at least of each language.
SAMPLE = 40_000
#: Languages that the ``STEPS`` of training are for; more languages take proportionally more.
USUAL = 8
STRIDE = WINDOW - max(WIDTHS) + 1
BATCH_WINDOWS = 512
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
OUTPUT = ("held_out", "lang_pred", "score")


def labelled_windows(df: DataFrame, lang_col: str, text_col: str, id_col: str,
                     docs: int = DOCS, windows: int = WINDOWS, sample: int = SAMPLE) -> list:
    """At most ``docs × windows`` (language, window) rows per language, and ``sample × windows`` in all,
    from labelled rows. Each language has as many texts as the others, as far as it has them, and
    one at least; only a column with more than ``sample`` languages would leave out its rarest."""
    labelled = df.select(quoted(id_col).alias("id"), quoted(lang_col).cast("string").alias("lang"),
                         quoted(text_col).cast("string").alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    order = F.xxhash64("id", "text")
    found = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample).collect()
    docs = max(1, min(docs, sample // max(1, len(found))))
    counts = small_table(df.sparkSession, [r.asDict() for r in found], "lang string, n long")
    # twice as many as asked by the share of hashes, so that what is sorted below is small
    share = (F.lit(2.0 * docs) + 50) / F.col("n")
    near = (labelled.join(F.broadcast(counts), "lang")  # at most sample rows
            .where(F.pmod(order, F.lit(1 << 20)) < share * (1 << 20)))
    chosen = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(order, "id")))
    raw = F.encode(F.lower("text"), "utf-8")
    return (chosen.where(F.col("place") <= docs).withColumn("raw", raw)
            .withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(windows))))
            .withColumn("at", F.pmod(F.xxhash64("id", "i"), F.greatest(F.lit(1), F.octet_length("raw") - WINDOW + 1)) + 1)
            .select("lang", F.substr("raw", F.col("at").cast("int"), F.lit(WINDOW)).alias("window"))
            .orderBy("lang", F.xxhash64("window")).collect())


def _padded(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(r.ljust(WINDOW, b" ") for r in rows), np.uint8).reshape(-1, WINDOW)


class Network:
    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, self.bias, self.dense, self.offset]

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Greatest value of each filter in each window, and where it is."""
        values, places = [], []
        for w, table in zip(WIDTHS, self.tables):
            n = WINDOW - w + 1
            out = sum(table[o][x[:, o:o + n]] for o in range(w))
            places.append(out.argmax(axis=1))
            values.append(np.take_along_axis(out, places[-1][:, None], axis=1)[:, 0])
        return np.concatenate(values, axis=1), places

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy of windows ``x`` with language numbers ``y``."""
        values, places = self.pooled(x)
        hidden = np.maximum(values + self.bias, 0)
        p = softmax(hidden @ self.dense + self.offset)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.dense.T) * (hidden > 0)
        grads = []
        for i, (w, at) in enumerate(zip(WIDTHS, places)):
            g = np.zeros_like(self.tables[i])
            own = back[:, i * FILTERS:(i + 1) * FILTERS]
            for o in range(w):
                np.add.at(g[o], (np.take_along_axis(x, at + o, axis=1), np.arange(FILTERS)[None, :]), own)
            grads.append(g)
        return [*grads, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 6) -> Network:
        """Adam; every batch has the languages in equal numbers, as far as chance has it."""
        rng = np.random.default_rng(seed)
        weight = 1.0 / np.bincount(y, minlength=len(self.languages)).clip(1)[y]
        weight /= weight.sum()
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        for t in range(1, steps + 1):
            own = rng.choice(len(y), BATCH, p=weight)
            for p, g, m, v in zip(self.parameters(), self.gradients(x[own], y[own]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        return self


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Applied:
    """A trained network with its tables added up for pairs of bytes."""

    def __init__(self, net: Network):
        def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        two, three, four = net.tables
        self.two, self.three, self.third = pairs(*two), pairs(*three[:2]), three[2]
        self.four, self.last = pairs(*four[:2]), pairs(*four[2:])
        self.net = net

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        pair = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        values = np.concatenate([
            self.two[pair].max(axis=1),
            (self.three[pair[:, :-1]] + self.third[x[:, 2:]]).max(axis=1),
            (self.four[pair[:, :-2]] + self.last[pair[:, 2:]]).max(axis=1)], axis=1)
        return softmax(np.maximum(values + self.net.bias, 0) @ self.net.dense + self.net.offset)

    def languages(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language of each text with its probability; unknown without a letter."""
        out: list = [(UNKNOWN, 0.0)] * len(texts)
        if not self.net.languages:
            return out
        own = [i for i, t in enumerate(texts) if LETTER.search(t)]
        sums = np.zeros((len(texts), len(self.net.languages)))
        held: list[bytes] = []
        owners: list[int] = []

        def flush():
            p = self.probabilities(_padded(held))
            np.add.at(sums, owners, p)
            held.clear()
            owners.clear()
        for i in own:
            raw = texts[i].lower().encode()
            for at in range(0, max(1, len(raw) - WINDOW + STRIDE), STRIDE):
                held.append(raw[at:at + WINDOW])
                owners.append(i)
                if len(held) >= BATCH_WINDOWS:
                    flush()
        if held:
            flush()
        for i in own:
            best = int(sums[i].argmax())
            out[i] = self.net.languages[best], float(sums[i, best] / sums[i].sum())
        return out


@lru_cache(maxsize=2)
def applied(model: bytes) -> Applied:
    return Applied(pickle.loads(model))


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> Network:
    """A network trained on a bounded sample of the rows that have a language and a text."""
    rows = labelled_windows(df, lang_col, text_col, id_col)
    languages = sorted({r["lang"] for r in rows})
    net = Network(languages)
    if not rows:
        return net
    number = {lang: i for i, lang in enumerate(languages)}
    steps = STEPS * max(1, -(-len(languages) // USUAL))
    return net.train(_padded([bytes(r["window"]) for r in rows]), np.array([number[r["lang"]] for r in rows]), steps)


def with_language(df: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """Every row with ``lang_pred`` and ``score``, the mean probability over the text's windows.

    Only the text counts. ``und`` with score 0 where the text is null or has no letter, or the
    network was trained on nothing; of equal languages the first in alphabetical order.
    """
    model = pickle.dumps(net)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        use = applied(model)
        found: list = []
        for at in range(0, len(texts), 256):
            found += use.languages([t.as_py() or "" for t in texts[at:at + 256]])
        return pa.array([{"lang": a, "score": b} for a, b in found],
                        pa.struct([("lang", pa.string()), ("score", pa.float64())]))

    found = df.select(*map(quoted, without(df, OUTPUT[1:])), predicted(quoted(text_col)).alias(OUTPUT[1]))
    return found.select(*map(quoted, without(found, OUTPUT[1:])), F.col("lang_pred")["lang"].alias("lang_pred"),
                        F.col("lang_pred")["score"].alias("score"))


def identify(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """All rows with ``held_out``, ``lang_pred`` and ``score``.

    Trained on rows with a language whose ``crc32(id as text) mod 4`` is not 2; that remainder is
    ``held_out`` (a null id counts as the empty text). Languages, sources and ids are no inputs of
    a prediction. Equal texts get equal results, an empty table an empty one. Input columns with
    the name of an output column are replaced.
    """
    held_out = F.crc32(F.encode(text_or_empty(id_col), "utf-8")) % 4 == 2
    net = fit(df.where(~held_out), lang_col, text_col, id_col)
    marked = df.select(*map(quoted, without(df, OUTPUT[:1])), held_out.alias("held_out"))
    return with_language(marked, net, text_col)
