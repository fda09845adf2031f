"""Quality classification by co-training.

Two classifiers look at a document from two sides: one at its text (which bytes it has, and how
words and lines repeat), one at what is known about the page (source, language, length). Both
start from the labelled documents. In every round each of them picks, from all unlabelled
documents, those about which it is most confident, and hands them with its verdict to the other
as further training examples. A verdict counts as confident only by its calibrated probability,
so a side that cannot tell hands over nothing. At the end both sides are calibrated on labelled
documents that neither was trained on, and a last logistic regression weighs the two calibrated
views against each other; that combination scores all documents.

The views of all documents are computed once, from whole texts, and written. A round reads them: each
task scores its documents with both sides and keeps its most confident ones, of which the most
confident of all remain, so that any document of the corpus can be handed over. Only these, at
most ``HANDED`` a side and round, and ``LABELLED`` labelled documents chosen by hash, a quarter of
them for calibration, come to the driver, where the regressions are fitted in numpy.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import free_name, quoted, without
from starmart.llm.near_dedup import IS_WHITE, shingles
from starmart.session import materialise

LABELLED, ROUNDS, HANDED, CONFIDENT = 4000, 4, 200, 0.95
#: The side that is taught by each side.
PUPIL = {"text": "page", "page": "text"}
#: Probabilities count as equal up to so many places; among equal ones a hash decides.
PLACES = 6
#: The most confident documents of the tasks are merged in so many parts first.
PARTS = 64
SOURCES, LANGUAGES, LENGTHS = 64, 32, 24
BATCH_BYTES = 1 << 20
#: So many views are scored at a time, so that a worker holds little more than a batch.
BLOCK = 512
OUTPUT = ("text_score", "page_score", "score", "keep")


def text_features(texts: list[bytes]) -> np.ndarray:
    """Per text: the square roots of the shares of each byte value, the shares of words that
    repeat the word before or any word, and of repeated lines, and the mean length of a word."""
    out = np.zeros((len(texts), 256 + 6), np.float32)
    words, counts = shingles(texts, 1)
    at = 0
    for row, text, n in zip(out, texts, counts.tolist()):
        own, at = words[at:at + n], at + n
        if not text:
            continue
        raw = np.frombuffer(text, np.uint8)
        row[:256] = np.sqrt(np.bincount(raw, minlength=256) / len(raw))
        lines = text.split(b"\n")
        row[256] = 1 - len(set(lines)) / len(lines)
        if n:
            row[257] = (own[1:] == own[:-1]).mean() if n > 1 else 0.0
            row[258] = 1 - len(np.unique(own)) / n
            row[259] = (len(raw) - IS_WHITE[raw].sum()) / n / 10
            row[260] = np.log1p(n) / 10
        row[261] = 1.0
    return out


def page_features(source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> np.ndarray:
    """One place each for the hashed source, the hashed language, and the length in powers of two."""
    def place(names: pd.Series, places: int) -> np.ndarray:
        hashed = pd.util.hash_array(names.fillna("").astype(str).to_numpy(object), categorize=False)
        return (hashed % places).astype(np.int64)
    out = np.zeros((len(source), SOURCES + LANGUAGES + LENGTHS), np.float32)
    rows = np.arange(len(source))
    out[rows, place(source, SOURCES)] = 1
    out[rows, SOURCES + place(lang, LANGUAGES)] = 1
    length = np.log2(pd.to_numeric(n_chars).fillna(0).clip(lower=0).to_numpy(float) + 1)
    out[rows, SOURCES + LANGUAGES + np.minimum(length.astype(int), LENGTHS - 1)] = 1
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Logistic:
    """Logistic regression: Newton steps on standardised inputs with a ridge."""
    mean: np.ndarray = field(default=None)
    scale: np.ndarray = field(default=None)
    weights: np.ndarray = field(default=None)

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> Logistic:
        x = x.astype(float)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-3
        for _ in range(steps):
            p = sigmoid(z @ w)
            grad = z.T @ (p - y) + penalty * w
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), grad)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


@dataclass
class Views:
    """Both classifiers, their calibrations and the combination; ``None`` of all if the labels
    say nothing (none at all, or all alike)."""
    text: Logistic = None
    page: Logistic = None
    text_calibrated: Logistic = None
    page_calibrated: Logistic = None
    both: Logistic = None
    prior: float = 1.0

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.both is None:
            same = np.full(len(text), self.prior)
            return same, same, same
        a, b = self.text.margin(text)[:, None], self.page.margin(page)[:, None]
        own = self.text_calibrated.margin(a), self.page_calibrated.margin(b)
        return sigmoid(own[0]), sigmoid(own[1]), self.both.probability(np.stack(own, axis=1))


@dataclass
class Candidates:
    """Unlabelled documents that one side is confident about, the surest first: one verdict, the keys
    of the documents (equal in both views, equal key), how sure it is, and the pupil's view of them."""
    keys: np.ndarray
    certainty: np.ndarray
    views: np.ndarray

    def best(self, n: int) -> Candidates:
        """The ``n`` surest different documents; of equally sure ones those of the least keys."""
        _, one = np.unique(self.keys, return_index=True)
        own = one[np.lexsort((self.keys[one], -self.certainty[one]))][:n]
        return Candidates(self.keys[own], self.certainty[own], self.views[own])

    def also(self, other: Candidates) -> Candidates:
        return Candidates(*(np.concatenate([a, b]) for a, b in zip(
            (self.keys, self.certainty, self.views), (other.keys, other.certainty, other.views))))


@dataclass
class Question:
    """What a round asks of the unlabelled documents: the ``shares[verdict]`` surest of each side and
    verdict that are at least ``confident`` and were not handed over before."""
    models: dict[str, tuple[Logistic, Logistic]]
    shares: tuple[int, int]
    confident: float
    taken: np.ndarray

    def asked(self, keys: np.ndarray, views: dict[str, np.ndarray]) -> dict[tuple[str, int], Candidates]:
        free = ~np.isin(keys, self.taken)
        out = {}
        for side, (model, calibrated) in self.models.items():
            p = calibrated.probability(model.margin(views[side])[:, None])
            for verdict, certainty in enumerate((1 - p, p)):
                certainty = np.round(certainty, PLACES)
                sure = free & (certainty >= self.confident) & ((p >= 0.5) == bool(verdict))
                out[side, verdict] = Candidates(keys[sure], certainty[sure], views[PUPIL[side]][sure]).best(
                    self.shares[verdict])
        return out


Answer = dict[tuple[str, int], Candidates]


def taught(text: np.ndarray, page: np.ndarray, y: np.ndarray, ask: Callable[[Question], Answer],
           rounds: int = ROUNDS, handed: int = HANDED, confident: float = CONFIDENT) -> Views:
    """Train both views on labelled rows, let them teach each other on the documents that ``ask``
    finds, combine them."""
    if len(set(y.tolist())) < 2:
        return Views(prior=float(y.mean()) if len(y) else 1.0)
    held = np.zeros(len(y), bool)
    held[::4] = True  # the rows come in random order
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held[:] = False
    calibrate = held if held.any() else ~held
    own = {"text": text, "page": page}
    known = {side: (x[~held], y[~held]) for side, x in own.items()}

    def fitted(side: str) -> tuple[Logistic, Logistic]:
        model = Logistic().fit(*known[side])
        return model, Logistic().fit(model.margin(own[side][calibrate])[:, None], y[calibrate])
    models = {side: fitted(side) for side in own}
    fewer = max(1, round(handed * min(y.mean(), 1 - y.mean())))
    taken = np.empty(0, np.int64)
    for _ in range(rounds):
        found = ask(Question(models, (fewer, handed - fewer), confident, taken))
        if not any(len(c.keys) for c in found.values()):
            break
        for (side, verdict), c in sorted(found.items()):
            x, verdicts = known[PUPIL[side]]
            known[PUPIL[side]] = (np.concatenate([x, c.views]),
                                  np.concatenate([verdicts, np.full(len(c.keys), float(verdict))]))
            taken = np.concatenate([taken, c.keys])
        models = {side: fitted(side) for side in own}
    (a, a_cal), (b, b_cal) = models["text"], models["page"]
    both = np.stack([a_cal.margin(a.margin(text[calibrate])[:, None]),
                     b_cal.margin(b.margin(page[calibrate])[:, None])], axis=1)
    return Views(a, b, a_cal, b_cal, Logistic().fit(both, y[calibrate]))


def co_train(text: np.ndarray, page: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_page: np.ndarray,
             rounds: int = ROUNDS, handed: int = HANDED, confident: float = CONFIDENT) -> Views:
    """Both views trained on labelled rows and on unlabelled ones that are all at hand."""
    keys = view_keys(pool_text, pool_page)
    return taught(text, page, y, lambda q: q.asked(keys, {"text": pool_text, "page": pool_page}),
                  rounds, handed, confident)


def view_keys(text: np.ndarray, page: np.ndarray) -> np.ndarray:
    """A hash of both views of each row."""
    return np.array([xxhash.xxh3_64_intdigest(a.tobytes() + b.tobytes()) for a, b in zip(text, page)],
                    np.uint64).astype(np.int64)


KIND = "text string, source string, lang string, n_chars long"


def _inputs(df: DataFrame) -> list:
    """Text and metadata columns; a missing metadata column counts as all null."""
    have = {c.lower(): c for c in df.columns}
    return [(quoted(have[c]) if c in have else F.lit(None)).cast(t).alias(c)
            for c, t in (x.split() for x in KIND.split(", "))]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    """Rows of a batch in groups of bounded text: first row, stop, texts."""
    at, held, group = 0, 0, []
    for i, t in enumerate(batch.column("text")):
        group.append((t.as_py() or "").encode())
        held += len(group[-1])
        if held >= BATCH_BYTES or i + 1 == batch.num_rows:
            yield at, i + 1, group
            at, held, group = i + 1, 0, []


def _page(batch: pa.RecordBatch, start: int, stop: int) -> np.ndarray:
    return page_features(*(batch.column(c).slice(start, stop - start).to_pandas() for c in ("source", "lang", "n_chars")))


VIEWED = "id long, y double, key long, text_view binary, page_view binary"


def _viewed(df: DataFrame) -> DataFrame:
    """``id`` and ``y`` of all rows with both views and their key."""
    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in _groups(batch):
                text, page = text_features(texts), _page(batch, start, stop)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(start, stop - start), batch.column("y").slice(start, stop - start),
                     pa.array(view_keys(text, page)), pa.array([r.tobytes() for r in text], pa.binary()),
                     pa.array([r.tobytes() for r in page], pa.binary())],
                    names=["id", "y", "key", "text_view", "page_view"])
    return df.select("id", "y", *_inputs(df)).mapInArrow(views, VIEWED)


def _matrix(rows: list, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r) for r in rows), np.float32).reshape(len(rows), width)


WIDTH = {"text": 256 + 6, "page": SOURCES + LANGUAGES + LENGTHS}


def _sample(viewed: DataFrame, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verdicts and both views of at most so many documents, in an order that depends on the rows
    alone. Of several rows with one id the least views count, found in each task first, so that no
    id has more than one row here."""
    if most is not None:
        # twice as many as asked by the share of hashes: a sort of all would send the driver so many from each task
        order = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 40))
        share = (2 * most + 50) / max(1, viewed.select("id").distinct().count())
        viewed = viewed.where(order < min(1.0, share) * (1 << 40))
    one = viewed.groupBy("id").agg(F.min(F.struct("text_view", "page_view", "y")).alias("r"))
    if most is not None:
        one = one.orderBy(order, "id").limit(most)
    rows = sorted(one.select("r.*").collect(), key=lambda r: (bytes(r["text_view"]), bytes(r["page_view"]), r["y"]))
    order = np.random.default_rng(1).permutation(len(rows))
    rows = [rows[i] for i in order]
    return (np.array([r["y"] for r in rows], dtype=float), _matrix([r["text_view"] for r in rows], WIDTH["text"]),
            _matrix([r["page_view"] for r in rows], WIDTH["page"]))


def _features(df: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _sample(_viewed(df))


def surest(pool: DataFrame, question: Question) -> Answer:
    """The answer to a question out of a table of views: the best of each task, then of each part of
    these by their keys, then of all."""
    asked = pickle.dumps(question)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, best = pickle.loads(asked), {}
        for block in (batch.slice(at, BLOCK) for batch in batches for at in range(0, batch.num_rows, BLOCK)):
            views = {side: _matrix(block.column(f"{side}_view").to_pylist(), WIDTH[side]) for side in WIDTH}
            for case, found in ask.asked(block.column("key").to_numpy(), views).items():
                best[case] = best[case].also(found).best(ask.shares[case[1]]) if case in best else found
        for (side, verdict), c in best.items():
            n = len(c.keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([side] * n, pa.string()), pa.array([verdict] * n, pa.int32()), pa.array(c.keys, pa.int64()),
                 pa.array(c.certainty, pa.float64()), pa.array([v.tobytes() for v in c.views], pa.binary())],
                names=["side", "verdict", "key", "certainty", "view"])

    found = pool.select("key", "text_view", "page_view").mapInArrow(
        own, "side string, verdict int, key long, certainty double, view binary")
    found = found.withColumn("part", F.pmod("key", F.lit(PARTS)))
    most = F.when(F.col("verdict") == 0, question.shares[0]).otherwise(question.shares[1])
    for group in (["side", "verdict", "part"], ["side", "verdict"]):  # copies of a document are in one part
        if "part" in group:
            found = found.dropDuplicates(["side", "verdict", "part", "key"])
        place = Window.partitionBy(*group).orderBy(F.desc("certainty"), "key")
        found = found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= most)
    rows = found.collect()  # at most the shares of both sides
    answer = {}
    for side in WIDTH:
        for verdict in (0, 1):
            mine = sorted((r for r in rows if (r["side"], r["verdict"]) == (side, verdict)), key=lambda r: r["place"])
            answer[side, verdict] = Candidates(
                np.array([r["key"] for r in mine], np.int64), np.array([r["certainty"] for r in mine], float),
                _matrix([r["view"] for r in mine], WIDTH[PUPIL[side]]))
    return answer


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        labelled: int = LABELLED, rounds: int = ROUNDS) -> Views:
    """Views co-trained on at most ``labelled`` labelled documents and on all unlabelled ones.

    Rows without an id take no part; a labelled id that is repeated counts as one document, and so do
    unlabelled documents with equal views.
    """
    known = (labels.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("int").alias("y"))
             .where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").cast("double").alias("y")))
    own = docs.select(quoted(id_col).cast("long").alias("id"), F.lit(None).cast("double").alias("y"), *_inputs(docs))
    viewed = materialise(_viewed(own.where("id IS NOT NULL")).drop("y").join(known, "id", "left"), "views")
    y, text, page = _sample(viewed.where("y IS NOT NULL"), labelled)
    pool = viewed.where("y IS NULL")
    return taught(text, page, y, lambda question: surest(pool, question), rounds)


def with_quality(df: DataFrame, views: Views, threshold: float = 0.5) -> DataFrame:
    """Every row with ``text_score``, ``page_score``, ``score`` (probabilities of good quality)
    and ``keep`` (``score`` at least ``threshold``).

    A null text counts as an empty one, null or missing metadata as a value of their own. Equal rows
    get equal scores, an empty table gives an empty result, and input columns with the name of an
    output column are replaced.
    """
    model = pickle.dumps(views)

    @F.arrow_udf("struct<t:double,p:double,s:double>")
    def scored(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        use = pickle.loads(model)
        batch = pa.RecordBatch.from_arrays([text, source, lang, n_chars], names=["text", "source", "lang", "n_chars"])
        found = [use.scores(text_features(texts), _page(batch, start, stop)) for start, stop, texts in _groups(batch)]
        parts = [np.concatenate([f[i] for f in found]) if found else np.empty(0) for i in range(3)]
        return pa.StructArray.from_arrays([pa.array(p, pa.float64()) for p in parts], ["t", "p", "s"])

    name = free_name(df, "__scores")
    found = df.withColumn(name, scored(*_inputs(df)))
    own = F.col(name)
    return found.select(*map(quoted, without(df, OUTPUT)), own["t"].alias("text_score"),
                        own["p"].alias("page_score"), own["s"].alias("score"), (own["s"] >= threshold).alias("keep"))
