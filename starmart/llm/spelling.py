"""Spelling variants: words that differ by one code point, and the word each is a variant of.

Two words are near if one inserted, deleted or replaced code point makes one of the other. With p
the length of their common prefix and s that of their common suffix, that is p + s >= (longer
length) - 1, for different words. So words are written as rows of a matrix of code points, padded
on the right for prefixes and on the left for suffixes, and two blocks of rows are compared
densely: the first place where they differ gives p, the last one s.

Not every block has to meet every other. As p + s >= longer - 1, near words share their first or
their last ⌈(longer - 1) / 2⌉ code points. A word of length L therefore goes to the groups of its
first and of its last half, once for pairs whose longer word has L code points and once for
L + 1. Only words of a group are compared; a pair that shares both halves is taken in the group of
prefixes. Words of a group that is larger than a tile are dealt out to blocks by hash, and every
pair of blocks is a tile of its own, so a half that a third of all words share costs many tasks and
not a long one. A tile sends on, for each word, the number of its near words and the best one;
pairs are never written out.

Words are grouped where they are counted: a task adds up the words it has read before the
shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import quoted, text_or_empty
from starmart.session import materialise

#: One run in so many loses a code point.
SLIP, LEAST_LENGTH, LEAST_COUNT, TIMES = 31, 7, 2, 10
#: A task sends its counts on when it has this many.
HELD_WORDS = 200_000
#: A long text is taken in pieces of about so many characters, cut between runs.
PIECE = 1 << 20
#: Latin-1 code points by what they are in a run: A to Z small, a to z and from 0xC0 as they are.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Words of a block, and cells of the comparison of two blocks.
TILE, CELLS = 1024, 1 << 21


def slipped(run: bytes, begin: int) -> bytes:
    """The run (in Latin-1), less one code point if its checksum says so; ``begin`` is the
    checksum of what stands before it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begin)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def runs(text: str) -> Iterator[list[bytes]]:
    """Small runs of letters up to U+00FF, piece by piece, in Latin-1."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and ord(text[end]) < 256 and LETTERS[ord(text[end])] != 32:
            end += 1
        yield text[at:end].encode("latin-1", "replace").translate(LETTERS).split(b" ")
        at = end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def sent() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in held], pa.string()),
                                          "n": pa.array(list(held.values()), pa.int64())})
        held.clear()
        return out
    for batch in batches:
        for doc, text in zip(batch.column("id"), batch.column("text")):
            begin = zlib.crc32(f"{doc.as_py()}:".encode())
            for found in runs(text.as_py()):
                for run, n in Counter(found).items():
                    if len(run) >= LEAST_LENGTH and len(word := slipped(run, begin)) >= LEAST_LENGTH:
                        held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield sent()
    yield sent()


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``: runs of ``[A-Za-z\\u00C0-\\u00FF]`` of all texts in lower case (A to Z only),
    each run with a slip in one of ``SLIP`` documents, that have at least ``LEAST_LENGTH`` code
    points and occur at least ``least`` times."""
    rows = df.select(text_or_empty(id_col).alias("id"), quoted(text_col).cast("string").alias("text")).where(
        "length(text) > 0")
    return (rows.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least))


def _matrix(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points of the words, one row each, padded with zeros on the left or on the right."""
    pad = str.rjust if right else str.ljust
    joined = "".join(pad(w, width, "\0") for w in words)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), width)


def compare(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the common prefix and the common suffix of every word of one block and every
    word of another."""
    width = max(map(len, (*a, *b)))
    shorter = np.minimum.outer([len(w) for w in a], [len(w) for w in b])

    def shared(right: bool) -> np.ndarray:
        x, y = _matrix(a, width, right), _matrix(b, width, right)
        if right:
            x, y = x[:, ::-1], y[:, ::-1]
        differ = x[:, None, :] != y[None, :, :]
        first = differ.argmax(axis=2)
        first[~differ.any(axis=2)] = width
        return np.minimum(first, shorter)
    return shared(False), shared(True)


class Tile:
    """Rows of one or more groups, whose words are compared block by block."""

    def __init__(self):
        self.found: dict[str, list] = {}

    def add(self, word: str, n: int, near: int, other: tuple[int, str]) -> None:
        held = self.found.setdefault(word, [0, (0, "")])
        held[0] += near
        held[1] = min(held[1], other)

    def blocks(self, rows: list[tuple], others: list[tuple] | None) -> None:
        """Compare rows (group, longest, by_suffix, word, n) with others, or among themselves.

        Only rows of one group are near, and only in the group that their pair belongs to.
        """
        long = max(len(r[3]) for r in rows)
        step = max(1, int((CELLS / long) ** 0.5))
        for i in range(0, len(rows), step):
            own = rows[i:i + step]
            rest = rows[i:] if others is None else others
            for j in range(0, len(rest), step):
                self.pair(own, rest[j:j + step], others is None and j == 0)

    def pair(self, x: list[tuple], y: list[tuple], same: bool) -> None:
        prefix, suffix = compare([r[3] for r in x], [r[3] for r in y])
        length = np.maximum.outer([len(r[3]) for r in x], [len(r[3]) for r in y])
        group = np.equal.outer([r[0] for r in x], [r[0] for r in y])
        longest = np.array([r[1] for r in x])[:, None]
        by_suffix = np.array([r[2] for r in x])[:, None]
        near = (prefix + suffix >= length - 1) & group & (length == longest)
        near &= ~by_suffix | (prefix < longest // 2)  # ⌈(longest - 1) / 2⌉
        if same:
            near &= np.triu(np.ones_like(near), 1)
        for i, j in zip(*np.nonzero(near)):
            a, b = x[i], y[j]
            self.add(a[3], a[4], 1, (-b[4], b[3]))
            self.add(b[3], b[4], 1, (-a[4], a[3]))


#: Rows of small groups that are compared together.
TOGETHER = 192
FOUND = "word string, n_near long, best_n long, best string"


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and tile; each tile whole, small ones several at a time."""
    rows: list[tuple] = []
    tile = Tile()
    numbers: dict[tuple, int] = {}

    def compared(ready: list[tuple]) -> None:
        # tiles with two blocks: one against the other; all others are put together
        single = []
        at = 0
        while at < len(ready):
            end = at
            while end < len(ready) and ready[end][5] == ready[at][5]:
                end += 1
            own = ready[at:end]
            if own[0][6]:
                left = [r for r in own if not r[7]]
                right = [r for r in own if r[7]]
                if left and right:
                    tile.blocks(left, right)
            elif len(own) > TOGETHER:
                tile.blocks(own, None)
            else:
                single += own
                if len(single) > TOGETHER:
                    tile.blocks(single, None)
                    single = []
            at = end
        if single:
            tile.blocks(single, None)

    def sent() -> pa.RecordBatch:
        found = tile.found
        out = pa.RecordBatch.from_pydict({
            "word": pa.array(list(found), pa.string()),
            "n_near": pa.array([v[0] for v in found.values()], pa.int64()),
            "best_n": pa.array([-v[1][0] for v in found.values()], pa.int64()),
            "best": pa.array([v[1][1] for v in found.values()], pa.string())})
        tile.found = {}
        return out

    last = None
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("longest", "by_suffix", "half", "low", "high",
                                                             "block", "word", "n"))):
            key = r[:5]
            if key != last and len(rows) > 4 * TOGETHER:
                compared(rows)
                rows = []
                numbers.clear()
                if len(tile.found) > HELD_WORDS:
                    yield sent()
            last = key
            number = numbers.setdefault(key, len(numbers))
            rows.append((number, r[0], r[1], r[6], r[7], number, r[3] != r[4], r[5] == r[4]))
    if rows:
        compared(rows)
    yield sent()


def halves(words: DataFrame) -> DataFrame:
    """The groups of each word: ``longest`` (length of the longer word of a pair), ``by_suffix``,
    and the shared ``half``."""
    length = F.char_length("word")
    each = F.explode(F.array(*[
        F.struct((length + more).alias("longest"), F.lit(suffix).alias("by_suffix"))
        for more in (0, 1) for suffix in (False, True)])).alias("g")
    size = F.floor(F.col("longest") / 2).cast("int")
    rows = words.select("word", "n", each).select("word", "n", "g.*")
    return rows.select("longest", "by_suffix", F.when(F.col("by_suffix"), F.substr(
        "word", F.char_length("word") - size + 1, size)).otherwise(F.substr("word", F.lit(1), size)).alias("half"),
        "word", "n").where(F.length("half") == size)


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """For each word with near words: their number ``n_near``, and of the most frequent one (of
    equals the first in code-point order) ``best`` and its count ``best_n``.

    ``words`` has different words ``word`` with a count ``n``. Words of any length and script may
    stand there.
    """
    grouped = halves(words)
    group = ["longest", "by_suffix", "half"]
    sizes = (grouped.groupBy(*group).agg(F.count("*").alias("size"), F.max(F.char_length("word")).alias("m"))
             .where((F.col("size") > 1) & (F.col("m") == F.col("longest"))).drop("m"))
    blocks = F.ceil(F.col("size") / tile).cast("int")
    dealt = (grouped.join(sizes, group).withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*group, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                     "block", "word", "n"))
    key = [*group, "low", "high"]
    # a stated number of tasks: their bytes say little about their work
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = dealt.repartition(tasks, *key).sortWithinPartitions(*key, "word").mapInArrow(_compare_tiles, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")))


def with_roots(forms: DataFrame, most: int) -> DataFrame:
    """``word`` and ``root`` for words that have a form.

    A form is ``TIMES`` as frequent as its word, so a way has at most log10(``most``) steps; each
    round doubles the steps taken.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    steps = 1
    while steps < len(str(max(1, most))):
        reached = materialise(reached, "roots")
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        steps *= 2
    return reached


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All words of the texts with ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    A word's ``form`` is its most frequent near word (of equals the first in code-point order) if
    that is at least ``TIMES`` as frequent, else null; ``root`` is where the forms end. Null and
    empty texts have no words; a null id counts as the empty text in the checksum of a run.
    Repeated rows count as often as they occur. Runs of any length are words, and texts are read
    as a whole. An empty table gives an empty result; other columns are not looked at.
    """
    words = materialise(count_words(df, id_col, text_col), "words")
    found = words.join(near_words(words), "word", "left")
    formed = F.col("best_n") >= TIMES * F.col("n")
    found = materialise(found.select(
        "word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best_n")).alias("form_n")), "near-words")
    most = words.agg(F.max("n")).first()[0] or 1
    roots = with_roots(found.where("form IS NOT NULL"), most)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
