"""Documents whose keys change their type, stored as variants."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources import ragged, warehouse
from tests.conftest import rows

BATCHES = [
    ['{"id": 1, "v": 7, "n": 1, "o": {"a": 1}}', '{"id": 2, "v": 8, "l": [1, 2]}', "", "not json", "[1]", '{"x": 1, "x": 2}'],
    ['{"id": 3, "v": "7", "n": 2.5, "o": {"b": "x"}}', '{"id": 4, "v": null}', "{}"],
    ['{"id": 5, "v": {"k": [1, {"z": "é"}]}, "n": 100000000000, "odd.key\'s": true, "l": ["a"], "ID": 9}', '{"id": 5, "q\\"\'": 4}'],
]


def lines(spark, batch):
    return spark.createDataFrame([(x,) for x in [*batch, None]], "value string")


@pytest.fixture
def root(spark, folder):
    for i, batch in enumerate(BATCHES, 1):
        ragged.take_up(spark, folder("w"), "docs", lines(spark, batch), i)
    return folder("w")


def test_number_text_and_object_without_loss(spark, root):
    df = ragged.flatten(spark, root, "docs", "json")
    assert df.columns == ["ID", "id_2", "l", "n", "o", "odd.key's", "q\"'", "v"]
    v = {r["id_2"]: r["v"] for r in df.collect() if r["id_2"] not in (None, 5)}
    assert v == {1: "7", 2: "8", 3: '"7"', 4: "null"}
    whole = [json.loads(x) for b in BATCHES for x in b if x.startswith("{") and '"x": 2' not in x]
    back = [{k: json.loads(r[c]) for k, c in (("v", "v"), ("l", "l")) if r[c] is not None} for r in df.collect()]
    want = [{k: d[k] for k in ("v", "l") if k in d} for d in whole]
    assert sorted(map(json.dumps, back)) == sorted(map(json.dumps, want))
    kinds = dict(df.dtypes)
    assert (kinds["id_2"], kinds["v"], kinds["o"], kinds["odd.key's"]) == (
        "bigint", "string", "struct<a:bigint,b:string>", "boolean")
    n = {r["id_2"]: float(r["n"]) for r in df.where("n IS NOT NULL").collect()}
    assert n == {1: 1, 3: 2.5, 5: 100000000000}
    assert [r["q\"'"] for r in df.collect() if r["q\"'"] is not None] == [4]


def test_variants_stay_variants_and_old_versions_readable(spark, root):
    df = ragged.flatten(spark, root, "docs")
    assert dict(df.dtypes)["v"] == "variant"
    assert df.where(F.expr("try_variant_get(v, '$.k[1].z', 'string') = 'é'")).count() == 1
    first = ragged.flatten(spark, root, "docs", version=1)
    assert dict(first.dtypes)["v"] == "bigint" and rows(first, "id", "v") == [(1, 7), (2, 8)]
    with pytest.raises(ValueError):
        ragged.flatten(spark, root, "docs", "text")


def test_widenings_are_recorded(spark, root):
    found = {(r["batch"], r["key"]): (r["before"], r["after"]) for r in ragged.widenings(spark, root, "docs").collect()}
    assert found[1, "v"] == (None, "bigint") and found[2, "v"] == ("bigint", "variant") and (3, "v") not in found
    assert found[1, "o"] == (None, "struct<a:bigint>") and found[2, "o"] == ("struct<a:bigint>", "struct<a:bigint,b:string>")
    assert found[2, "n"][1].startswith("decimal") and found[3, "ID"][0] is None


def test_refused_lines_and_repeated_batches(spark, root):
    aside = warehouse.read(spark, root, "docs_refused")
    assert rows(aside, "line", ragged.BATCH) == [("[1]", 1), ("not json", 1), ('{"x": 1, "x": 2}', 1)]
    version = warehouse.snapshot(spark, root).version
    again = ragged.take_up(spark, root, "docs", lines(spark, BATCHES[0]), 1)
    assert again == {"version": version, "new": []} and ragged.flatten(spark, root, "docs").count() == 7


def test_a_batch_reads_nothing_of_earlier_ones(spark, root, monkeypatch):
    seen = []
    inner = ragged.key_types
    monkeypatch.setattr(ragged, "key_types", lambda docs: (seen.extend(docs.inputFiles()), inner(docs))[1])
    before = {f for f in warehouse.read(spark, root, "docs").inputFiles()}
    ragged.take_up(spark, root, "docs", lines(spark, ['{"id": 6, "v": 1}']), 4)
    assert seen and not before & set(seen)
    assert before <= set(warehouse.read(spark, root, "docs").inputFiles())


def test_a_failure_leaves_the_old_version(spark, root, monkeypatch):
    def broken(*_):
        raise OSError("lost")
    monkeypatch.setattr(ragged, "key_types", broken)
    version = warehouse.snapshot(spark, root).version
    with pytest.raises(OSError):
        ragged.take_up(spark, root, "docs", lines(spark, ['{"id": 6}']), 4)
    assert warehouse.snapshot(spark, root).version == version and ragged.flatten(spark, root, "docs").count() == 7


def test_empty_batches(spark, folder):
    for i, batch in enumerate(([], ["no"], ["{}"], ['{"a": null}'], ['{"a": 2}']), 1):
        ragged.take_up(spark, folder("w"), "t", lines(spark, batch), i)
        if i == 4:
            assert rows(ragged.flatten(spark, folder("w"), "t"), "a") == [(None,), (None,)]
    df = ragged.flatten(spark, folder("w"), "t")
    assert df.dtypes == [("a", "bigint")] and rows(df) == [(None,), (None,), (2,)]


def test_merged_types():
    long, text, real, none, var = T.LongType(), T.StringType(), T.DoubleType(), T.NullType(), T.VariantType()
    dec = T.DecimalType
    for a, b, want in ((long, none, long), (long, text, var), (long, dec(3, 2), dec(21, 2)), (dec(30, 0), dec(30, 20), var),
                       (real, dec(5, 2), real), (real, dec(20, 2), var), (real, long, var), (var, long, var),
                       (T.ArrayType(long), T.ArrayType(text), T.ArrayType(var)), (T.ArrayType(long), long, var)):
        assert ragged.merged_type(a, b) == want and ragged.merged_type(b, a) == want
