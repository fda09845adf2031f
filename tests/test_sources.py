import json
import os
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions.columns import iso_timestamp, megabytes
from starmart.plans import ingest as ingestion
from starmart.plans import sql
from starmart.session import together
from starmart.sources import documents, files, jdbc, sinks
from starmart.streaming.payload import stream_payload
from starmart_demo import files as demo_files
from tests.conftest import plan, rows


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_csv_schema_is_matched_by_name(spark, folder):
    path = put(folder("in/p.csv"), "_id,alighting,vehicle_id,timestamp,passenger_count,stop_id,boarding\r\n"
               "x1,True,V1,2025-07-13 02:32:48.965652,39,,False\r\n")
    df = files.read_csv(spark, path, schemas.RAW_SCHEMAS["passagers"])
    r = df.first()
    assert (r["_id"], r["passenger_count"], r["alighting"], r["stop_id"]) == ("x1", 39, "True", None)
    assert r["timestamp"] == datetime(2025, 7, 13, 2, 32, 48, 965652)


def test_csv_header_variants_and_lenient_values(spark, folder):
    path = put(folder("in/g.csv"), "route_id,vehicle_id,timeshamp,latitude,longitude,speek_kmh,traffic_level\n"
               "R,V,2025-01-01 00:00:00,1.5,2.5,fast,Faible\n")
    df = files.read_csv(spark, path, schemas.RAW_SCHEMAS["gps"], aliases=schemas.HEADER_ALIASES, lenient=True)
    r = df.first()
    assert (r["timestamp"], r["latitude"], r["speed_kmh"]) == (datetime(2025, 1, 1), 1.5, None)


def test_csv_inference_and_text(spark, folder):
    path = put(folder("in/a.csv"), "a,b\n1,x\n,\" \"\n")
    assert files.read_csv(spark, path).dtypes == [("a", "int"), ("b", "string")]
    df = files.read_csv(spark, path, infer=False)
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert rows(df) == [(None, " "), ("1", "x")]


def test_csv_multiline_and_doubled_quotes(spark, folder):
    path = put(folder("in/q.csv"), 'a,b\n"say ""hi""\nthere",2\n')
    assert rows(files.read_csv(spark, path, multiline=True, escape='"')) == [('say "hi"\nthere', 2)]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_save_round_trip(spark, folder, fmt):
    df = spark.createDataFrame([(1, 'é "q", x'), (2, None), (3, "")], "n int, s string")
    path = folder(fmt)
    sinks.save(df, path, fmt)
    sinks.save(df, path, fmt)  # replaced, not doubled
    back = {"csv": lambda: files.read_csv(spark, path, df.schema, escape='"'),
            "json": lambda: spark.read.schema(df.schema).json(path),
            "parquet": lambda: spark.read.parquet(path)}[fmt]()
    want = rows(df) if fmt != "csv" else rows(df.replace({"": None}, subset=["s"]))
    assert rows(back) == want


def test_save_text_has_no_header_and_unknown_format_fails(spark, folder):
    sinks.save(spark.createDataFrame([(1, "a")], "n int, s string"), folder("t"), "text")
    assert [r[0] for r in spark.read.text(folder("t")).collect()] == ["1,a"]
    with pytest.raises(ValueError):
        sinks.save(spark.range(1), folder("x"), "xml")


def test_table_round_trip_with_partitions(spark, folder):
    df = spark.range(10).withColumn("day", F.col("id") % 3)
    sinks.write_table(df, folder("w"), "t", partition_by=["day"])
    assert files.read_table(spark, folder("w"), "t").filter("day = 1").count() == 3


def test_append_repeats_unless_told_not_to(spark, folder):
    df = spark.createDataFrame([("i1", 1, None), ("i2", 1, None), ("i3", 2, "b")], "_id string, n int, s string")
    sinks.append(df, folder("a"))
    sinks.append(df, folder("a"))
    assert spark.read.parquet(folder("a")).count() == 6
    for _ in range(2):
        sinks.append(df, folder("b"), dedupe_on=["n", "s"])
    assert rows(spark.read.parquet(folder("b")), "n", "s") == [(1, None), (2, "b")]


def test_inventory_lists_plain_csv_files_only(spark, folder):
    put(folder("d/b.csv"), "x" * 20_000)
    put(folder("d/a.csv"), "y\n")
    put(folder("d/c.txt"), "z\n")
    put(folder("d/sub/e.csv"), "z\n")
    out = files.list_files(spark, folder("d"))
    put(folder("d/none.csv"), "")
    put(folder("d/_part.csv"), "y\n")
    put(folder("d/.x.csv"), "y\n")
    out = files.list_files(spark, folder("d"))
    got = [(r["name"], r["size"], r["size_mb"], r["collection"]) for r in out.collect()]
    assert got == [(".x.csv", 2, 0.0, ".x"), ("_part.csv", 2, 0.0, "_part"), ("a.csv", 2, 0.0, "a"),
                   ("b.csv", 20_000, 0.01, "b"), ("none.csv", 0, 0.0, "none")]
    assert files.list_files(spark, folder("d"), "*.json").count() == 0


def test_megabytes_are_cut_not_rounded(spark):
    df = spark.createDataFrame([(1048576 * 2 - 1,)], "n long")
    assert float(df.select(megabytes(F.col("n"))).first()[0]) == 1.99


def test_load_directory_skips_empty_and_keeps_text(spark, folder):
    put(folder("d/a.csv"), "x,y\n1,True\n")
    put(folder("d/empty.csv"), "x,y\n")
    put(folder("d/nothing.csv"), "")
    out, report = files.load_directory(spark, folder("d"))
    assert list(out) == ["a"] and out["a"].dtypes == [("x", "string"), ("y", "string")]
    assert rows(report, "name", "status") == [("a.csv", "loaded"), ("empty.csv", "empty"), ("nothing.csv", "empty")]


def test_load_directory_reads_quotes_and_line_breaks(spark, folder):
    records = [('say "hi", x', "1"), ("two\nlines", "2"), ("plain", "3")]
    text = "a,b\n" + "".join('"' + a.replace('"', '""') + f'",{b}\n' for a, b in records)
    put(folder("d/q.csv"), text)
    put(folder("d/one line.csv"), 'a,b\n"say ""hi"", x",1\n')
    put(folder("d/ragged.csv"), "a,b\n1,2\n1,2,3\n")
    put(folder("d/short.csv"), 'a,b\n"x\ny"\n1,2\n')
    put(folder("d/_tmp.csv"), "a\n1\n")
    out, report = files.load_directory(spark, folder("d"))
    assert rows(out["q"]) == sorted(records) and rows(out["one line"]) == [('say "hi", x', "1")]
    assert rows(report, "name", "status") == [
        ("_tmp.csv", "failed"), ("one line.csv", "loaded"), ("q.csv", "loaded"), ("ragged.csv", "failed"),
        ("short.csv", "failed")]
    assert "from 2 to 3" in report.where("name = 'ragged.csv'").first()["error"]


def test_quick_start_reads_what_is_saved(spark, folder):
    """The way of reading that the README shows."""
    df = spark.createDataFrame([(1, 'a "q", x')], "n int, s string")
    sinks.save(df, folder("c"), "csv")
    assert rows(files.read_csv(spark, folder("c"), df.schema)) == rows(df)


def test_document_ids_do_not_depend_on_splits(spark, folder):
    put(folder("in/t.csv"), "a,b\n" + "".join(f"{i % 500},x{i % 7}\n" for i in range(4000)))
    seen = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            out, _ = files.load_directory(spark, folder("in"))
            seen.append(rows(ingestion.as_documents(out["t"])))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] and len({r[-1] for r in seen[0]}) == 4000


def test_document_ids_of_many_copies(spark, monkeypatch):
    df = spark.createDataFrame([("a",)] * 23 + [("b",)] * 5 + [("c",)] * 10 + [(None,)] * 11, "x string")
    want = rows(ingestion.as_documents(df))
    monkeypatch.setattr(ingestion, "BLOCK", 5)
    assert rows(ingestion.as_documents(df)) == want and len({r[1] for r in want}) == 49
    out = ingestion.as_documents(df)
    assert out.count() == 49 and "REPARTITION_BY_COL" in plan(out)  # blocks are dealt out


def test_manifest_stops_at_a_missing_file(spark, folder):
    path = put(folder("a.csv"), "x\n1\n2\n")
    out = files.load_manifest(spark, {"a": path})
    assert rows(files.manifest_report(out)) == [("a", 2, 1)]
    with pytest.raises(ValueError, match="'b'"):
        files.load_manifest(spark, {"a": path, "b": folder("none.csv")})


def test_documents_flatten_to_sorted_text(spark, folder):
    put(folder("d.json"), "\n".join(json.dumps(d) for d in [
        {"_id": "68a1", "a": 1, "nested": {"x": 1}, "list": [1, 2], "Z": "é"},
        {"_id": "68a2", "b": None, "a": 2.5, "flag": True}]))
    out = documents.flatten_documents(documents.read_documents(spark, folder("d.json")))
    assert out.columns == ["Z", "_id", "a", "b", "flag", "list", "nested"]
    assert {t for _, t in out.dtypes} == {"string"}
    assert rows(out) == [("", "68a2", "2.5", "", "True", "", ""),
                         ("é", "68a1", "1.0", "", "", "[1,2]", '{"x":1}')]


def test_numbers_as_text(spark):
    values = [12345678.9, 1e-05, 0.5, 1e7, 123456789012345.6, 1e16, 1.5e-7, -2.5e-4, 0.0, 1e100, -1234567.25, 0.0001234567890123456]
    df = spark.createDataFrame([(float(v),) for v in values], "d double")
    assert [r[0] for r in documents.flatten_documents(df).collect()] == [str(float(v)) for v in values]


def test_iso_timestamps(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-07-13 02:32:48' a, timestamp_ntz'2025-07-13 02:32:48.9' b")
    assert tuple(df.select(iso_timestamp(F.col("a")), iso_timestamp(F.col("b"))).first()) == (
        "2025-07-13T02:32:48", "2025-07-13T02:32:48.900000")


def test_union_ragged(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([(2.0, 3)], "d double, n int")
    assert rows(documents.union_ragged(a, b), "n", "s", "d") == [(1, "x", None), (3, None, 2.0)]


def test_payload_records(spark, folder):
    put(folder("p/a.json"), json.dumps({"stops": [{"id": 1, "geo": {"lat": 1.5}}, {"id": 2}]}, indent=1))
    put(folder("p/b.json"), json.dumps({"stops": []}))
    put(folder("p/c.json"), json.dumps({"error": "no"}))
    df = documents.read_documents(spark, folder("p"), multiline=True)
    assert rows(documents.explode_payload(df, "stops"), "id") == [(1,), (2,)]
    answered = df.withColumn("status", F.lit(500))
    assert documents.explode_payload(answered, "stops", "status").count() == 0


def test_payload_stream_takes_each_file_once(spark, folder):
    from pyspark.sql import types as T

    record = T.StructType([T.StructField("id", T.LongType())])

    def run():
        stream_payload(spark, folder("land"), record, "stops", folder("out"), folder("cp"),
                       folder("refused")).awaitTermination()
        return rows(spark.read.schema(record).parquet(folder("out")), "id")

    put(folder("land/1.json"), json.dumps({"stops": [{"id": 1}, {"id": 2}]}, indent=1))
    assert run() == [(1,), (2,)]
    assert run() == [(1,), (2,)]
    put(folder("land/2.json"), json.dumps({"stops": [{"id": 3}]}))
    assert run() == [(1,), (2,), (3,)]


def test_payload_stream_keeps_what_it_refuses(spark, folder):
    from pyspark.sql import types as T

    record = T.StructType([T.StructField("id", T.LongType())])
    put(folder("land/1.json"), json.dumps({"status": 200, "stops": [{"id": 1}]}, indent=1))
    put(folder("land/2.json"), json.dumps({"status": 200, "stops": [{"id": 2}, {"id": 3}]})[:-9])
    put(folder("land/3.json"), json.dumps({"status": 503, "stops": [{"id": 4}]}))
    put(folder("land/4.json"), json.dumps({"status": 200, "error": "x"}))
    put(folder("land/5.json"), json.dumps({"status": 200, "stops": []}))
    stream_payload(spark, folder("land"), record, "stops", folder("out"), folder("cp"),
                   folder("refused")).awaitTermination()
    assert rows(spark.read.schema(record).parquet(folder("out")), "id") == [(1,)]
    refused = spark.read.parquet(folder("refused")).select(F.element_at(F.split("file", "/"), -1).alias("f"), "reason", "payload")
    assert [(r[0], r[1], r[2] is None) for r in sorted(refused.collect())] == [
        ("2.json", "unreadable", False), ("3.json", "status 503", True), ("4.json", "no stops", True)]


PAGE = """<html><body><table><tr><td>outside</td></tr></table>
<div class="wide table-container"><table>
<tr><th> Operator Name (Short Name) </th><th>City</th><th>State / Province</th><th>Country</th></tr>
<tr><td>A &amp; B<!-- note --> <b> Lines </b></td><td></td><td>CA</td><td>USA<br>San <i>Mateo</i></td></tr>
<tr><td>C<script>var x = "<td>no</td>";</script></td><td>Dakar</td></tr>
</table></div><div class="other"><tr><td>no</td></tr></div></body></html>"""


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>no table")], "page_id long, html string")
    out = documents.extract_html_rows(pages)
    assert [tuple(r) for r in out.orderBy("page_id", "table_no", "row_no").collect()] == [
        (1, 1, 1, ["Operator Name (Short Name)", "City", "State / Province", "Country"]),
        (1, 1, 2, ["A & BLines", "", "CA", "USASanMateo"]),
        (1, 1, 3, ["C", "Dakar"])]
    spaced = documents.extract_html_rows(pages, sep=" ").filter("row_no = 2").first()["cells"]
    assert spaced == ["A & B Lines", "", "CA", "USA San Mateo"]


def test_html_nested_tables_come_out_per_level(spark):
    html = '<div class="table-container"><tr><td>a<table><tr><td>b</td></tr></table></td></tr></div>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert rows(documents.extract_html_rows(pages), "row_no", "cells") == [(1, ["ab", "b"]), (2, ["b"])]


def test_html_end_tags_may_be_left_out(spark):
    html = '<div class="table-container"><table>' + "<tr><td>x<td>y" * 2000 + "</table></div>"
    nested = '<div class="table-container"><table><tr><td>a<table><tr><td>b<tr><td>c</table><td>d</table></div>'
    pages = spark.createDataFrame([(1, html), (2, nested)], "page_id long, html string")
    out = documents.extract_html_rows(pages)
    one = out.where("page_id = 1")
    assert one.count() == 2000 and one.where("cells = array('x', 'y')").count() == 2000
    assert rows(out.where("page_id = 2"), "row_no", "cells") == [(1, ["abc", "b", "c", "d"]), (2, ["b"]), (3, ["c"])]
    items = documents.extract_html_rows(
        spark.createDataFrame([(1, "<nav><ul><li>a<li>b<ul><li>c</ul></ul></nav>")], "page_id long, html string"),
        container="nav", css_class=None, row="ul", cells=("li",))
    assert rows(items, "row_no", "cells") == [(1, ["a", "bc", "c"]), (2, ["c"])]


def test_operator_catalogue(spark):
    pages = spark.createDataFrame([(2, PAGE), (1, PAGE.replace("Dakar", "Thiès"))], "page_id long, html string")
    assert rows(ingestion.build_operators(pages)) == [
        (1, "A & BLines", "", "CA", "USASanMateo"), (2, "C", "Thiès", None, None),
        (3, "A & BLines", "", "CA", "USASanMateo"), (4, "C", "Dakar", None, None)]


def test_ingest_writes_canonical_csv(spark, folder):
    put(folder("in/stops.csv"), "zone,name,Stop\nN,a,1\n,b,2\n")
    put(folder("in/empty.csv"), "x\n")
    report, loaded = ingestion.ingest(spark, folder("in"), folder("out"))
    assert rows(report) == [("stops", 2, True)]
    assert rows(loaded, "name", "status") == [("empty.csv", "empty"), ("stops.csv", "loaded")]
    back = files.read_csv(spark, folder("out/stops"), infer=False)
    assert back.columns == ["Stop", "_id", "name", "zone"]
    assert rows(back, "Stop", "zone") == [("1", "N"), ("2", None)]
    assert back.select("_id").distinct().count() == 2
    first = rows(back)
    ingestion.ingest(spark, folder("in"), folder("out"))  # a second run changes nothing
    assert rows(files.read_csv(spark, folder("out/stops"), infer=False)) == first


def test_export_report(spark):
    report = sinks.export_report({"a": spark.range(3), "b": spark.range(0)})
    assert rows(report) == [("a", 3, True), ("b", 0, False)]
    assert tuple(sinks.export_totals(report).first()) == (1, 2, 3)


def test_jdbc_options_come_from_the_caller():
    opts = {"url": "jdbc:x:y", "user": "u"}
    assert jdbc.read_options(opts, "t", ("id", 1, 100, 8)) == {
        "url": "jdbc:x:y", "user": "u", "dbtable": "t", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "100", "numPartitions": "8"}
    assert jdbc.write_options(opts, "t") == {
        "url": "jdbc:x:y", "user": "u", "dbtable": "t", "batchsize": "1000", "truncate": "true",
        "numPartitions": "8"}
    assert opts == {"url": "jdbc:x:y", "user": "u"}


def test_load_jdbc_swaps_only_a_complete_staging_table(spark, monkeypatch):
    """The order of steps, with the database replaced by a dict of frames."""
    store, steps = {"t": spark.range(2)}, []
    monkeypatch.setattr(jdbc, "count_rows", lambda s, o, table: store[table].count())

    def write(df, opts, table, mode="overwrite", batchsize=1000, truncate=True):
        steps.append((table, mode, batchsize))
        store[table] = store[table].union(df) if mode == "append" else df

    monkeypatch.setattr(jdbc, "write_jdbc", write)
    swap = lambda a, b: store.update({b: store[a]})
    assert rows(jdbc.load_jdbc(spark.range(5), {}, "t", swap=swap)) == [("t", 5, 5, True)]
    assert steps == [("t_staging", "overwrite", 1000)]
    assert rows(jdbc.load_jdbc(spark.range(3), {}, "t")) == [("t", 3, 3, True)]
    assert jdbc.load_jdbc(spark.range(0), {}, "t").first()["ok"] and len(steps) == 2
    with pytest.raises(KeyError):
        jdbc.load_jdbc(spark.range(1), {}, "missing")

    def lossy(df, opts, table, mode="overwrite", batchsize=1000, truncate=True):
        store[table] = df.limit(1)

    monkeypatch.setattr(jdbc, "write_jdbc", lossy)
    before = store["t"].count()
    with pytest.raises(RuntimeError):
        jdbc.load_jdbc(spark.range(4), {}, "t", swap=swap)
    assert store["t"].count() == before


def test_sql_over_registered_frames(spark):
    name = sql.register(spark.range(30), "stops")
    assert name == "table_stops"
    assert sql.query(spark, "SELECT id * 2 AS x FROM table_stops WHERE id > 5", 20).count() == 20
    with pytest.raises(ValueError):
        sql.register(spark.range(1), "x; DROP TABLE y")


def test_recreate_tables(spark):
    sql.recreate(spark, ["dim_stop", "fact_transport"])
    spark.sql("INSERT INTO dim_stop (stop_id) VALUES ('s1')")
    assert spark.table("dim_stop").count() == 1
    sql.recreate(spark, ["dim_stop"])
    assert spark.table("dim_stop").count() == 0
    assert spark.table("fact_transport").columns == schemas.SCHEMAS["fact_transport"].names


def test_recreate_in_a_folder_empties_it(spark, folder):
    for _ in range(2):
        sql.recreate(spark, ["operators"], folder("db"))
        assert spark.table("operators").count() == 0
        spark.sql("INSERT INTO operators (id) VALUES (1)")
        assert spark.read.parquet(folder("db/operators")).count() == 1
    spark.sql("DROP TABLE operators")


def test_ingest_writes_collections_side_by_side(spark, folder, monkeypatch):
    """Both collections must be under way for either to be written, and the report keeps their order."""
    for name in "ab":
        put(folder(f"in/{name}.csv"), f'k,t\n{name},"x\ny"\n{name},\n')
    meet, write = threading.Barrier(2, timeout=120), ingestion.save

    def save(*args, **options):
        meet.wait()
        write(*args, **options)
    monkeypatch.setattr(ingestion, "save", save)
    report, _ = ingestion.ingest(spark, folder("in"), folder("out"))
    assert [tuple(r) for r in report.collect()] == [("a", 2, True), ("b", 2, True)]
    back = files.read_csv(spark, [folder("out/a"), folder("out/b")], infer=False, multiline=True)
    assert rows(back, "k", "t") == [("a", None), ("a", "x\ny"), ("b", None), ("b", "x\ny")]


def test_together_keeps_order_and_raises(spark):
    assert together(spark, lambda n: spark.range(n).count(), [3, 0, 2]) == [3, 0, 2] and together(spark, str, []) == []
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda n: 1 // n, [1, 0])


def test_collections_are_read_back_at_once(spark, folder):
    """The plan does not grow with the number of collections."""
    scans = []
    for n in (2, 6):
        for i in range(n):
            put(folder(f"in{n}/c{i}.csv"), f'a,b\n{i},"x\ny"\n')
        back = demo_files._ingested(spark, folder(f"in{n}"))
        assert rows(back, "a", "b") == [(str(i), "x\ny") for i in range(n)]
        scans.append(plan(back).count("FileScan"))
    assert scans[0] == scans[1]
