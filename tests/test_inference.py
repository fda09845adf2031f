"""Types of the columns of a directory, against Spark's own inference file by file."""

import pytest
from pyspark.sql import functions as F

from starmart.sources import files, inference
from tests.conftest import rows
from tests.test_sources import put

FILES = {
    "numbers": "i,l,d,big,mixed,zero\n1,3000000000,1.5,123456789012345678901234,1,007\n-2,4,2,5,2.5,1\n,,1e-3,,,\n",
    "times": "day,short,at,both,no day,at2\n2024-02-29,2024-02,2024-01-01 10:00:00,2024-01-01,2024-02-30,2024-01-01T10:00:00.123456\n"
             "2024-01-05,2024-1-5,2024-01-01 10:00:00.5,2024-01-01 00:00:01,2024-01-01,2024-01-01T10:00:00\n",
    "flags": "b,b or n,text,none,blank\nTrue,true,a,,\"\"\nfalse,1,b,,\"\"\n",
    "crlf": "n,t\r\n1,x\r\n2,\r\n",
    "header again": "n,t\n1,a\nn,t\n",
    "odd": "n,special\n\"1,5\",NaN\n2,Inf\n",
    "lines": "n,t,x\n1,\"a\nb\",1.5\n2,\"say \"\"hi\"\"\",2\n",
    "lines of numbers": "n,t\n\"1\n2\",x\n3,y\n",
}


@pytest.fixture
def directory(folder):
    for name, text in FILES.items():
        put(folder(f"d/{name}.csv"), text)
    put(folder("d/header only.csv"), "a,b\n")
    put(folder("d/nothing.csv"), "")
    put(folder("d/ragged.csv"), "a,b\n1,2\n1,2,3\n")
    put(folder("d/wide + % ü.csv"), ",".join(f"c{i}" for i in range(30)) + "\n" + ",".join(map(str, range(30))) + "\n")
    return folder("d")


def test_same_types_and_values_as_one_by_one(spark, directory):
    out, report = files.load_directory(spark, directory, infer=True)
    assert set(out) == {*FILES, "wide + % ü"}
    assert rows(report.where("status <> 'loaded'"), "name", "status") == [
        ("header only.csv", "empty"), ("nothing.csv", "empty"), ("ragged.csv", "failed")]
    again = out.pop("header again")  # Spark infers int here, and then loses a record's value
    assert again.dtypes == [("n", "string"), ("t", "string")] and rows(again) == [("1", "a"), ("n", "t")]
    for name, df in out.items():
        own = files.read_csv(spark, f"{directory}/{name}.csv", multiline=name.startswith("lines"))
        # the digits of a great whole number are not counted
        like = [(c, "decimal(38,0)" if t.startswith("decimal") else t) for c, t in own.dtypes]
        assert df.dtypes == like, name
        plain = own.select(*[F.col(f"`{c}`").cast(t) for c, t in like])
        assert [tuple(map(str, r)) for r in rows(df)] == [tuple(map(str, r)) for r in rows(plain)], name


def test_text_without_inference(spark, directory):
    out, _ = files.load_directory(spark, directory)
    assert all(t == "string" for df in out.values() for _, t in df.dtypes)


def test_one_scan_of_all_files(spark, directory, monkeypatch):
    seen = []
    inner = inference.class_counts
    monkeypatch.setattr(inference, "class_counts", lambda *a, **k: (seen.append(inner(*a, **k)), seen[-1])[1])
    files.load_directory(spark, directory, infer=True)
    assert len(seen) == 1  # for all files, plain ones and those with line breaks
    text = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan text") == 3 and "ArrowEvalPython" not in text  # lines, records, records over an edge
    exchanged = text[:text.index("Exchange hashpartitioning(path")]
    assert "HashAggregate" in exchanged and "SortAggregate" not in text


def test_stored_counts_add_up(spark, folder):
    put(folder("d/a.csv"), "k,v\n1,1\n2,\n")
    put(folder("d/b.csv"), "v,k\n2.5,1\n3000000000,x\n")
    counts = files.column_types(spark, folder("d"))
    assert rows(inference.types(counts, "name", "column")) == [
        ("a.csv", "k", "int", 2), ("a.csv", "v", "int", 1), ("b.csv", "k", "string", 2), ("b.csv", "v", "double", 2)]
    assert rows(inference.types(counts, "column")) == [("k", "string", 4), ("v", "double", 3)]


def test_names_and_edges(spark, directory, folder):
    counts = files.column_types(spark, directory)
    kinds = {(r["name"], r["column"]): (r["type"], r["filled"]) for r in inference.types(counts, "name", "column").collect()}
    assert kinds["wide + % ü.csv", "c29"] == ("int", 1) and kinds["header only.csv", "a"] == ("string", 0)
    assert kinds["times.csv", "no day"] == ("string", 2) and kinds["times.csv", "both"] == ("timestamp", 2)
    assert kinds["lines.csv", "t"] == ("string", 2) and kinds["lines of numbers.csv", "n"] == ("string", 2)
    assert not any(name == "nothing.csv" for name, _ in kinds)
    put(folder("e/none.csv"), "")
    assert files.column_types(spark, folder("e")).count() == 0
    assert files.load_directory(spark, folder("e"), infer=True)[0] == {}


def test_a_file_in_many_splits(spark, folder):
    spark.range(20_000).select("id", (F.col("id") / 7).alias("x"), F.concat(F.lit("t\n"), "id").alias("t")) \
        .coalesce(1).write.option("header", True).option("escape", '"').csv(folder("q"))
    spark.range(20_000).select("id", F.lit(True).alias("b")).coalesce(1).write.option("header", True).csv(folder("p"))
    limits = {"spark.sql.files.maxPartitionBytes": "30000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        for name, want in (("q", [("id", "int"), ("t", "string"), ("x", "double")]), ("p", [("b", "boolean"), ("id", "int")])):
            counts = files.column_types(spark, folder(name))
            assert rows(inference.types(counts, "column")) == [(c, t, 20_000) for c, t in want]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
