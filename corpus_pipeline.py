"""From raw documents to encoded training data.

Five stages, each on all that the one before it kept: documents whose language is not recognised
go, documents of low quality go, one document of each class of near copies stays, sources are
mixed to equal shares, and the mixture is encoded. Every stage is written as Parquet to the folder
in ``spark.checkpoint.dir`` and read again by the next, so a lost executor costs a stage at most.

Every stage takes nulls in any column, empty and very long texts, ties and repeated rows, and an
empty table, which stays empty; its docstring says what becomes of them. All but the last return
the columns they were given, whatever else these hold and however they are called: columns that no
operator reads are set aside under other names while it works.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import byte_bpe, cotraining, language_id, mixing, near_dedup
from starmart.llm.common import quoted
from starmart.session import bound_batches, materialise

#: A text stays if its best language is by so much likelier than by chance, whatever their number.
OVER_CHANCE = 1.2
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ORACLE_SQL = None  # trained models decide
#: What the operators read.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def stage(work: Callable[[DataFrame], DataFrame], docs: DataFrame) -> DataFrame:
    """What is left of the rows after some work, with all columns as they were."""
    bound_batches(docs.sparkSession)
    aside = {c: c if c in READ else f"__column_{i}" for i, c in enumerate(docs.columns)}
    out = work(docs.select(*[quoted(c).alias(new) for c, new in aside.items()]))
    return out.select(*[quoted(new).alias(c) for c, new in aside.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is recognised; the network learns from ``docs``.

    Null and empty texts and those without a letter go. Rows with equal texts stay or go together.
    """
    def work(rows: DataFrame) -> DataFrame:
        net = language_id.fit(rows)
        least = min(1.0, OVER_CHANCE / max(1, len(net.languages)))
        return language_id.with_language(rows, net).where(
            (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least))
    return stage(work, docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality; the classifiers learn from the table ``labels``.

    A null text counts as an empty one, null metadata as a value of their own; a row without an id is
    judged but not learned from. Equal rows stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return stage(lambda rows: cotraining.with_quality(rows, cotraining.fit(rows, labels)).where("keep"), docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id, and of several rows
    that have it any one.

    Rows with a null text all stay; empty texts, and those without words, are copies of each
    other only where they are equal. Texts without an id, or with that of another, lose nothing.
    """
    return stage(near_dedup.one_of_each, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents as before, on average, the same share from every source, in random order.

    A document is repeated or left out as its id and text decide, so repeated rows get the same
    number of copies each. Null is a source like any other; a null id or text counts as empty.
    """
    return stage(mixing.mix, docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document, and whether they decode to its text.

    Null and empty texts have no ids and decode. Every row is encoded, repeated ones too.
    """
    bound_batches(spark)
    found = byte_bpe.encode_checked(docs.select("doc_id", "lang", "source", "text"), RANKS, public_tokenizers.PATTERN)
    return found.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        "ids", "decodes")


STAGES = [("language", language), ("quality", quality), ("near_dedup", dedup), ("mixture", mixture),
          ("byte_bpe", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        docs = materialise(work(spark, docs, sf_dir), name)
    return docs
