"""The pipeline's stages on edge cases, one after another."""

from collections import Counter

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture
def crowded(edges):
    """Columns named like everything that a stage writes."""
    names = ["score", "lang_pred", "held_out", "keep", "text_score", "page_score", "repetitions", "position_key",
             "__column_0", "__scores", "__encoded", "decodes"]
    return edges.drop("SCORE", "keep", "copy", "position_key").withColumns({n: F.lit(f"my {n}") for n in [*names, "copy"]})


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:4])
def test_columns_stay_as_they_are(spark, crowded, edge_rows, name, stage):
    out = stage(spark, crowded, SF)
    assert out.columns == crowded.columns and out.dtypes == crowded.dtypes
    rows = out.collect()
    assert rows and {(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows} <= set(edge_rows)
    for r in rows:
        assert r["score"] == "my score" and r["copy"] == "my copy" and r["a.b"] == 7 and r["__column_0"] == "my __column_0"
    assert stage(spark, crowded.limit(0), SF).count() == 0


def test_encoded(spark, crowded, edge_rows):
    rows = pipeline.encoded(spark, crowded, SF).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in edge_rows)
    assert all(r["decodes"] and r["n_tokens"] * 4 == len(r["ids"]) for r in rows)
    assert {len(r["ids"]) for r in rows if r["doc_id"] in (3, None)} >= {0}
    assert pipeline.encoded(spark, crowded.limit(0), SF).count() == 0


def test_clean_documents_of_one_language_stay(spark, documents):
    one = documents.where("lang = 'en'")
    assert pipeline.language(spark, one, SF).count() == one.where("text rlike '\\\\p{L}'").count()
