import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and very long texts, equal texts and repeated rows."""
    rng = random.Random(4)
    long = " ".join(rng.choice(["the", "of", "zwölf", "né", "x1", "word.", "\n"]) for _ in range(40_000))
    return [
        (1, "one two three four five six seven. Released under the MIT License.\n", "en", "s1", 60),
        (1, "one two three four five six seven. Released under the MIT License.\n", "en", "s1", 60),
        (2, "one two three four five six seven. Released under the MIT License.\n", "de", "s2", 60),
        (None, None, None, None, None), (None, None, None, None, None), (3, None, "en", "s1", 0),
        (4, "", "en", "s1", 0), (5, " \n\t ", None, "s1", 4), (6, "12 34 !!", "fr", None, 8),
        (7, long, "de", "s2", len(long)), (8, "y" * 70_000, "de", "s3", 70_000),
        (4, "tie in the id", "en", "s3", 13), (None, "no id", "en", "s1", 5),
        (9, "nul\x00 and \U0001F600 é é \x1c  x", "es", "s1", -1)]


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    """The same with further columns named like outputs and internals."""
    from pyspark.sql import functions as F
    names = ["Size", "SCORE", "ids", "class_id", "copy", "a.b", "__k1", "__class", "__digest", "matches",
             "fingerprint", "keep", "n_tokens", "position_key", "__n", "rank"]
    df = spark.createDataFrame(edge_rows, SCHEMA)
    return df.withColumns({n: F.lit(7) for n in names})
