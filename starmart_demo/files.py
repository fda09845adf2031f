"""Documents, payloads, pages, and round trips through files in the shared scratch folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.columns import iso_timestamp
from starmart.operators import profiling, quality
from starmart.plans import incremental, sql, star
from starmart.plans import ingest as ingestion
from starmart.session import materialise, scratch_dir
from starmart.sources import (
    distinct_index, documents, files, filesystem, inference, ledger, quoted, ragged, search_index, sinks, warehouse)
from starmart.streaming.payload import stream_into_fact, stream_payload
from starmart_demo.inputs import SUMMARY_CTES, star_inputs
from starmart_demo.registry import query, table

DOCS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS _id,
       CASE WHEN extract(microseconds FROM ts) % 1000000 = 0
            THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS at,
       CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) ELSE '' END AS delay,
       CASE WHEN value > 100 THEN 'True' ELSE 'False' END AS late,
       '{"k":' || CAST(json_extract(props, '$.k') AS INT) || '}' AS nested,
       '[' || event_id || ',' || user_id || ']' AS refs
FROM events"""


def _event_documents(spark, sf):
    """Nested and ragged: ``delay`` is there for errors only."""
    return table(spark, sf, "events").select(
        F.array("event_id", "user_id").alias("refs"),
        F.from_json("props", "k int").alias("nested"),
        F.col("event_id").alias("_id"),
        (F.col("value") > 100).alias("late"),
        F.col("ts").alias("at"),
        F.when(F.col("event_type") == "error", F.col("value")).alias("delay"))


@query(DOCS_SQL)
def flatten_docs(spark, sf):
    return documents.flatten_documents(_event_documents(spark, sf))


@query(DOCS_SQL)
def json_lines(spark, sf):
    """The same documents through JSON files, their columns found from the keys."""
    path = scratch_dir(spark, "documents")
    docs = _event_documents(spark, sf)
    sinks.save(docs.withColumn("at", iso_timestamp(F.col("at"))), path, "json")
    return documents.flatten_documents(documents.read_documents(spark, path))


@query("""
SELECT event_id, user_id, value AS delay, CAST(NULL AS VARCHAR) AS kind FROM events
WHERE event_type = 'error'
UNION ALL
SELECT event_id, user_id, NULL, event_type FROM events WHERE event_type <> 'error'
""")
def union_ragged(spark, sf):
    events = table(spark, sf, "events")
    errors = events.filter("event_type = 'error'").select(
        "event_id", "user_id", F.col("value").alias("delay"))
    others = events.filter("event_type <> 'error'").select(
        F.col("event_type").alias("kind"), "user_id", "event_id")
    return documents.union_ragged(errors, others)


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN '"' || event_type || '"'
         ELSE '{"k":' || CAST(json_extract(props, '$.k') AS INT) || '}' END AS what,
       CASE WHEN event_id % 3 = 1 THEN value END AS amount
FROM events
""")
def ragged_batches(spark, sf):
    """Three batches in which one key is a number, a text and an object, and one key comes and goes."""
    events, root = table(spark, sf, "events"), scratch_dir(spark, "ragged")
    what = {0: F.col("user_id"), 1: F.col("event_type"), 2: F.from_json("props", "k int")}
    for i, value in what.items():
        more = [F.col("value").alias("amount")] if i == 1 else []
        docs = events.where(F.col("event_id") % 3 == i).select(
            F.to_json(F.struct("event_id", value.alias("what"), *more)).alias("value"))
        ragged.take_up(spark, root, "events", docs, i + 1)
    return ragged.flatten(spark, root, "events", "json").withColumn("amount", F.col("amount").cast("double"))


RECORD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("geo", T.StructType([T.StructField("lat", T.DoubleType())]))])


def _payloads(spark, sf) -> DataFrame:
    """One answer per order, listing the order and its customer as records."""
    record = lambda key, kind, lat: F.struct(
        F.col(key).alias("id"), F.lit(kind).alias("kind"),
        F.struct(lat.cast("double").alias("lat")).alias("geo"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderstatus") == "P", 404).otherwise(200).alias("status"),
        F.array(record("o_orderkey", "order", F.col("o_totalprice")),
                record("o_custkey", "customer", F.lit(None))).alias("stops"))


@query("""
SELECT o_orderkey AS id, 'order' AS kind, o_totalprice AS lat FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_custkey, 'customer', NULL FROM orders WHERE o_orderstatus <> 'P'
""")
def payload_explode(spark, sf):
    rows = documents.explode_payload(_payloads(spark, sf), "stops", "status")
    return rows.select("id", "kind", F.col("geo.lat").alias("lat"))


def _streamed(spark, sf) -> tuple[str, str]:
    """The payloads land as JSON files, one in a hundred cut off, and a stream takes them up."""
    landing, out, refused = (scratch_dir(spark, n) for n in ("landing", "stream", "refused"))
    line = F.to_json(F.struct("status", "stops"))
    _payloads(spark, sf).select(F.when(
        F.col("key") % 100 == 7, F.substring(line, 1, 30)).otherwise(line).alias("line")).write.text(landing)
    stream_payload(spark, landing, RECORD, "stops", out, scratch_dir(spark, "checkpoint"), refused,
                   multiline=False).awaitTermination()
    return out, refused


@query("""
SELECT o_orderkey AS id, 'order' AS kind, o_totalprice AS lat FROM orders
WHERE o_orderstatus <> 'P' AND o_orderkey % 100 <> 7
UNION ALL SELECT o_custkey, 'customer', NULL FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 100 <> 7
""")
def payload_stream(spark, sf):
    """Records of the payloads that can be read and were answered with 200."""
    out, _ = _streamed(spark, sf)
    return spark.read.schema(RECORD).parquet(out).select("id", "kind", F.col("geo.lat").alias("lat"))


@query("""
SELECT CASE WHEN o_orderkey % 100 = 7 THEN 'unreadable' ELSE 'status 404' END AS reason, count(*) AS payloads,
       count(*) FILTER (WHERE o_orderkey % 100 = 7) AS kept_texts
FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 100 = 7 GROUP BY ALL
""")
def payload_refused(spark, sf):
    """Payloads that were set aside, with the file they came in."""
    _, refused = _streamed(spark, sf)
    return spark.read.schema("file string, reason string, payload string").parquet(refused).where(
        "file IS NOT NULL").groupBy("reason").agg(
        F.count("*").alias("payloads"), F.count("payload").alias("kept_texts"))


def _landed(df: DataFrame, directory: str) -> None:
    """Rows land as payloads of one record each, in files beside those that are there."""
    df.select(F.to_json(F.struct(F.lit(200).alias("status"), F.array(F.struct(*df.columns)).alias("records")))
              .alias("line")).write.mode("append").text(directory)


def _streamed_twice(spark, df: DataFrame, name: str) -> DataFrame:
    """All rows land, half of them twice, and are taken up; then all land again, and are taken up by
    a stream that is started anew. The states of the fact afterwards."""
    landing, root, checkpoint = (scratch_dir(spark, n) for n in ("landing", "states", "checkpoint"))
    _landed(df, landing)
    _landed(df.where(F.crc32(F.col("_id").cast("binary")) % 2 == 0), landing)
    for again in (True, False):
        stream_into_fact(spark, landing, df.schema, "records", name, root, checkpoint,
                         multiline=False, max_files=8).awaitTermination()
        if again:
            _landed(df, landing)
    return warehouse.read(spark, root, incremental.STATE)


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS vehicle_id, sum(CAST(floor(o_totalprice) AS BIGINT))::BIGINT AS total_passengers,
       count(*) AS passenger_records FROM orders GROUP BY ALL
""")
def stream_totals(spark, sf):
    """Sums and counts out of a source that repeats its records."""
    people = star_inputs(spark, sf)["passagers"].select("_id", "vehicle_id", "passenger_count")
    return _streamed_twice(spark, people, "passagers").select("vehicle_id", "total_passengers", "passenger_records")


@query("""
SELECT CAST(user_id AS VARCHAR) AS vehicle_id, value AS latitude, event_type AS traffic_level FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1
""")
def stream_positions(spark, sf):
    """The running latest position of each vehicle."""
    gps = star_inputs(spark, sf)["gps"].drop("route_id").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return _streamed_twice(spark, gps, "gps").select(
        "vehicle_id", F.col("position.latitude").alias("latitude"), F.col("position.traffic_level").alias("traffic_level"))


NAV = {"container": "nav", "css_class": None, "row": "ul", "cells": ("li",)}
LIST_ITEM = r"""'<li><a href="[^"]*">([^<]*)</a>', 1"""


@query(f"""
SELECT page_id, CAST(1 AS INT) AS table_no, CAST(1 AS INT) AS row_no,
       CAST(generate_subscripts(c, 1) AS INT) AS cell_no, trim(unnest(c)) AS cell
FROM (SELECT page_id, regexp_extract_all(html, {LIST_ITEM}) AS c FROM pages)
""")
def html_rows(spark, sf):
    rows = documents.extract_html_rows(table(spark, sf, "pages"), **NAV)
    return rows.select("page_id", "table_no", "row_no",
                       F.posexplode("cells").alias("p", "cell")).select(
        "page_id", "table_no", "row_no", (F.col("p") + 1).alias("cell_no"), "cell")


@query(f"""
SELECT row_number() OVER (ORDER BY page_id) AS id, c[1] AS operator_name, c[2] AS city,
       c[3] AS state_province, c[4] AS country
FROM (SELECT page_id, regexp_extract_all(html, {LIST_ITEM}) AS c FROM pages)
""")
def operator_catalogue(spark, sf):
    return ingestion.build_operators(table(spark, sf, "pages"), **NAV)


@query("SELECT * FROM supplier")
def csv_roundtrip(spark, sf):
    supplier = table(spark, sf, "supplier")
    path = scratch_dir(spark, "supplier")
    sinks.save(supplier, path, "csv")
    return files.read_csv(spark, path, supplier.schema)


@query("SELECT * FROM part")
def csv_inferred(spark, sf):
    path = scratch_dir(spark, "part")
    sinks.save(table(spark, sf, "part"), path, "csv")
    return files.read_csv(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_quoted(spark, sf):
    """Texts with line breaks and quotes survive."""
    docs = table(spark, sf, "documents")
    path = scratch_dir(spark, "documents-csv")
    sinks.save(docs, path, "csv")
    return files.read_csv(spark, path, docs.schema, multiline=True, escape='"')


@query("SELECT doc_id, text, lang, source, n_chars, true AS in_splits FROM documents")
def csv_quoted_in_splits(spark, sf):
    """The largest file cut into eight splits at least, in the middle of quoted texts."""
    docs = table(spark, sf, "documents")
    path = scratch_dir(spark, "documents-csv")
    sinks.save(docs, path, "csv")
    largest = max(f[2] for f in filesystem.listing(spark, path, "*.csv"))
    limits = {"spark.sql.files.maxPartitionBytes": str(largest // 8), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        n = len(quoted.splits(spark, path).states)
        read = materialise(files.read_csv(spark, path, docs.schema, multiline=True), "read")  # with these limits
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return read.withColumn("in_splits", F.lit(n >= 8))


@query("SELECT * FROM part")
def text_roundtrip(spark, sf):
    part = table(spark, sf, "part")
    path = scratch_dir(spark, "part-text")
    sinks.save(part, path, "text")
    return spark.read.schema(part.schema).csv(path)


@query("SELECT * FROM orders")
def parquet_roundtrip(spark, sf):
    root = scratch_dir(spark, "warehouse")
    sinks.write_table(table(spark, sf, "orders"), root, "orders")
    return files.read_table(spark, root, "orders")


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def append_idempotent(spark, sf):
    path = scratch_dir(spark, "customer-append")
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"),
        "c_mktsegment")
    for _ in range(2):
        sinks.append(customer, path, dedupe_on=customer.columns)
    return spark.read.schema(customer.schema).parquet(path).fillna({"c_nationkey": 3})


@query("SELECT * FROM customer")
def append_once(spark, sf):
    """Two loads of different customers, then all of them twice."""
    root, customer = scratch_dir(spark, "ledger"), table(spark, sf, "customer")
    for rows in (customer.where("c_custkey % 2 = 0"), customer.where("c_custkey % 2 = 1"), customer, customer):
        ledger.append_once(rows, root, "customer", ["c_custkey", "c_nationkey"])
    return files.read_table(spark, root, "customer")


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey % 2, c_custkey) AS id FROM customer")
def ids_kept(spark, sf):
    """Numbers given to half the customers stay when all of them are loaded."""
    root = scratch_dir(spark, "registry")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    for rows in (customer.where("c_custkey % 2 = 0"), customer):
        ledger.append_once(rows, root, "customer", "c_custkey", id_col="id")
    return files.read_table(spark, root, "customer")


@query("SELECT * FROM documents WHERE contains(text, 'erkeit') OR contains(lang, 'erkeit') OR contains(source, 'erkeit')")
def search_indexed(spark, sf):
    """A word of one language, in files by language of which one half was indexed later."""
    docs, path, index = table(spark, sf, "documents"), scratch_dir(spark, "documents"), scratch_dir(spark, "index")
    for part in (F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1):
        docs.where(part).repartitionByRange(8, "lang").write.mode("append").parquet(path)
        search_index.index_files(spark, path, index)
    return search_index.search(spark, path, index, "erkeit")


@query("""
SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS "column",
       true AS near
""")
def distinct_sketches(spark, sf):
    """Orders in two loads; each column's estimate is within two percent of the exact number."""
    orders, path, index = table(spark, sf, "orders"), scratch_dir(spark, "orders"), scratch_dir(spark, "sketches")
    for part in (F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 3 != 0):
        orders.where(part).write.mode("append").parquet(path)
        distinct_index.update(spark, path, index)
    exact = profiling.distinct_profile(orders, orders.columns, by_column=True).withColumnRenamed("distinct_values", "exact")
    return distinct_index.estimates(spark, path, index).join(exact, "column").select(
        "column", (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.02 * F.col("exact")).alias("near"))


@query("""
SELECT c_custkey, count(*) * 2 AS n FROM customer GROUP BY c_custkey
""")
def append_repeats(spark, sf):
    path = scratch_dir(spark, "customer-repeat")
    customer = table(spark, sf, "customer")
    for _ in range(2):
        sinks.append(customer, path)
    return spark.read.schema(customer.schema).parquet(path).groupBy("c_custkey").agg(
        F.count("*").alias("n"))


@query("""
SELECT 'orders' AS collection, count(*) AS documents, count(*) > 0 AS exported FROM orders
UNION ALL SELECT 'events', count(*), count(*) > 0 FROM events
UNION ALL SELECT 'none', count(*), count(*) > 0 FROM events WHERE value < 0
""")
def export_report(spark, sf):
    events = table(spark, sf, "events")
    return sinks.export_report({"orders": table(spark, sf, "orders"), "events": events,
                                "none": events.filter("value < 0")})


@query("""
SELECT 'orders' AS table_name, count(*) AS sent, count(*) AS loaded, true AS ok FROM orders
UNION ALL
SELECT 'events', count(*), count(*) FILTER (WHERE value < 100), count(*) FILTER (WHERE value >= 100) = 0
FROM events
""")
def reconcile(spark, sf):
    """Rows sent against rows stored, once complete and once with rows left out."""
    root = scratch_dir(spark, "reconcile")
    sent = {n: table(spark, sf, n) for n in ("orders", "events")}
    sinks.write_table(sent["orders"], root, "orders")
    sinks.write_table(sent["events"].filter("value < 100"), root, "events")
    return quality.reconcile(sent, {n: files.read_table(spark, root, n) for n in sent})


@query("""
SELECT 'supplier' AS dataset, count(*) AS rows, 4 AS columns FROM supplier
UNION ALL SELECT 'part', count(*), 6 FROM part
""")
def manifest(spark, sf):
    paths = {}
    for name in ("supplier", "part"):
        paths[name] = scratch_dir(spark, f"manifest-{name}")
        sinks.save(table(spark, sf, name), paths[name], "csv")
    return files.manifest_report(files.load_manifest(spark, paths, infer=False))


def _flat_directory(spark, df, by: str, name: str) -> str:
    """The frame as a flat directory of CSV files whose names begin with a value of ``by``, with
    an empty file and a hidden one among them."""
    parts, path = scratch_dir(spark, f"{name}-parts"), scratch_dir(spark, name)
    (df.withColumn("__by", F.col(by)).write.partitionBy("__by").option("header", True).option("escape", '"')
     .option("emptyValue", '""').csv(parts))
    fs, folder = filesystem._at(spark, path)
    _, root = filesystem._at(spark, parts)
    fs.mkdirs(folder)
    for place in fs.listStatus(root):
        value = place.getPath().getName().removeprefix("__by=")
        if place.isDirectory():
            for i, f in enumerate(filesystem.listing(spark, place.getPath().toString(), "*.csv")):
                _, old = filesystem._at(spark, f[1])
                _, new = filesystem._at(spark, f"{path}/{value}-{i}.csv")
                fs.rename(old, new)
    for extra in ("none.csv", "_hidden.csv"):
        fs.create(filesystem._at(spark, f"{path}/{extra}")[1]).close()
    return path


def _orders_directory(spark, sf) -> str:
    return _flat_directory(spark, table(spark, sf, "orders"), "o_orderstatus", "orders-csv")


@query("""
SELECT o_orderstatus AS status, count(*) AS n, true AS sized, true AS ordered FROM orders GROUP BY ALL
UNION ALL SELECT 'none', 0, true, true UNION ALL SELECT '_hidden', 0, true, true
""")
def file_inventory(spark, sf):
    """Every file of the directory, the empty and the hidden one too; rows as found in the files."""
    found = files.list_files(spark, _orders_directory(spark, sf))
    order = Window.orderBy(F.monotonically_increasing_id())  # one row per file
    seen = found.select("*", F.lag("name").over(order).alias("before"))
    rows = {k: v["lines"] - 1 for k, v in files.inspect_csv(
        spark, [r["path"] for r in found.where("size > 0").collect()]).items()}
    counts = spark.createDataFrame([(k.rsplit("/", 1)[-1], n) for k, n in rows.items()], "name string, n long")
    rule = F.col("size_mb") == F.floor(F.col("size") / F.lit(1048576.0) * 100) / 100
    return (seen.join(counts, "name", "left").groupBy(F.split("collection", "-")[0].alias("status")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.every(rule & ((F.col("size") > 0) == F.col("n").isNotNull())).alias("sized"),
        F.every(F.col("before").isNull() | (F.col("before") < F.col("name"))).alias("ordered")))


def _typed(df, like):
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema])


@query("SELECT * FROM orders")
def load_directory(spark, sf):
    datasets, _ = files.load_directory(spark, _orders_directory(spark, sf))
    return _typed(reduce(DataFrame.unionByName, datasets.values()), table(spark, sf, "orders"))


@query("SELECT * FROM orders")
def load_directory_typed(spark, sf):
    """Without a declared schema: the types come from the values, of all files in one job."""
    datasets, _ = files.load_directory(spark, _orders_directory(spark, sf), infer=True)
    df = reduce(DataFrame.unionByName, datasets.values())
    return df.select(*[F.col(c).cast({"int": "bigint", "timestamp": "timestamp_ntz"}.get(t, t)) for c, t in df.dtypes])


@query("""
WITH d AS (SELECT count(doc_id) AS a, count(nullif(lang, '')) AS b, count(n_chars) AS c, count(nullif(source, '')) AS d,
                  count(nullif(text, '')) AS e, max(doc_id) > 2147483647 AS long_id, max(n_chars) > 2147483647 AS long_n FROM documents)
SELECT unnest(['doc_id', 'lang', 'n_chars', 'source', 'text']) AS "column",
       unnest([CASE WHEN long_id THEN 'bigint' ELSE 'int' END, 'string', CASE WHEN long_n THEN 'bigint' ELSE 'int' END,
               'string', 'string']) AS type, unnest([a, b, c, d, e]) AS filled FROM d
""")
def column_types(spark, sf):
    """Types and filled values out of counts per file, added up over files of texts with line breaks."""
    directory = _flat_directory(spark, table(spark, sf, "documents"), "lang", "documents-csv")
    return inference.types(files.column_types(spark, directory), "column")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def load_directory_quoted(spark, sf):
    """Whole texts with quotes and line breaks, one collection of files per language."""
    docs = table(spark, sf, "documents")
    datasets, _ = files.load_directory(spark, _flat_directory(spark, docs, "lang", "documents-csv"))
    return _typed(reduce(DataFrame.unionByName, datasets.values()), docs)


def _ingested(spark, directory) -> DataFrame:
    """Directory → documents → canonical CSV, read back from all collections."""
    out = scratch_dir(spark, "ingested")
    report, _ = ingestion.ingest(spark, directory, out)
    names = [r["collection"] for r in report.filter("exported").collect()]
    return files.read_csv(spark, [f"{out}/{n}" for n in names], infer=False, multiline=True)


@query("SELECT * FROM orders")
def ingest_directory(spark, sf):
    return _typed(_ingested(spark, _orders_directory(spark, sf)), table(spark, sf, "orders"))


@query("SELECT doc_id, text, lang, source, n_chars, true AS own_id FROM documents")
def ingest_documents(spark, sf):
    """Texts with quotes and line breaks, and an id made from the content for each."""
    docs = table(spark, sf, "documents")
    back = _ingested(spark, _flat_directory(spark, docs, "lang", "documents-csv"))
    ids = back.groupBy("_id").agg(F.count("*").alias("n"))
    return back.join(ids, "_id").select(
        *[F.col(f.name).cast(f.dataType) for f in docs.schema], (F.col("n") == 1).alias("own_id"))


def _published(spark, sf, name) -> DataFrame:
    """One table through the warehouse, decimals as doubles, times without a zone."""
    root = scratch_dir(spark, "star")
    star.publish(star.build_star(star_inputs(spark, sf), tables=[name]), root)
    df = files.read_table(spark, root, name)
    plain = {"timestamp": "timestamp_ntz"} | {t: "double" for _, t in df.dtypes if t.startswith("decimal")}
    return df.select(*[F.col(c).cast(plain.get(t, t)) for c, t in df.dtypes])


PLACE_FITS = "abs(round(latitude, 8)) < 100 AND abs(round(longitude, 8)) < 1000"
SPEED_FITS = "abs(round(speed_kmh, 2)) < 1000"


def _decimals(*columns) -> str:
    kinds = {"latitude": "DECIMAL(10,8)", "longitude": "DECIMAL(11,8)", "speed_kmh": "DECIMAL(5,2)"}
    return "REPLACE (" + ", ".join(f"CAST(CAST({c} AS {kinds[c]}) AS DOUBLE) AS {c}" for c in columns) + ")"


@query(f"""
WITH {SUMMARY_CTES}
SELECT * {_decimals("latitude", "longitude", "speed_kmh")}, CAST(NULL AS BIGINT) AS stops_count
FROM fact WHERE {PLACE_FITS} AND {SPEED_FITS}
""")
def publish_star(spark, sf):
    """The fact in its declared types, all columns; rows that do not fit are in quarantine."""
    return _published(spark, sf, "fact_transport")


@query(f"WITH {SUMMARY_CTES} SELECT * FROM transport")
def publish_dim_transport(spark, sf):
    return _published(spark, sf, "dim_transport")


@query(f"""
WITH {SUMMARY_CTES}
SELECT _id AS passager_id, CASE WHEN alighting = 'True' THEN 1 ELSE 0 END AS alighting,
       CASE WHEN boarding = 'True' THEN 1 ELSE 0 END AS boarding, passenger_count, stop_id, timestamp, vehicle_id
FROM passagers
""")
def publish_dim_passager(spark, sf):
    return _published(spark, sf, "dim_passager")


@query(f"""
WITH {SUMMARY_CTES}
SELECT * EXCLUDE (_id) {_decimals("latitude", "longitude", "speed_kmh")}, _id AS position_id
FROM gps WHERE {PLACE_FITS} AND {SPEED_FITS}
""")
def publish_dim_gps(spark, sf):
    return _published(spark, sf, "dim_gps")


@query(f"WITH {SUMMARY_CTES} SELECT * REPLACE (CAST(severity AS VARCHAR) AS severity) FROM incident")
def publish_dim_incident(spark, sf):
    return _published(spark, sf, "dim_incident")


STOP_SQL = f"""
WITH {SUMMARY_CTES}
SELECT * REPLACE (shelter = 'True' AS shelter), CAST(NULL AS VARCHAR) AS vehicle_id, CAST(NULL AS VARCHAR) AS passager_id
FROM stops"""


@query(STOP_SQL)
def publish_dim_stop(spark, sf):
    return _published(spark, sf, "dim_stop")


def _reasons_sql(table_name, key, source) -> str:
    return f"""SELECT '{table_name}' AS table_name, {key} AS key, concat_ws('; ',
        CASE WHEN abs(round(latitude, 8)) >= 100 THEN 'latitude: does not fit' END,
        CASE WHEN abs(round(longitude, 8)) >= 1000 THEN 'longitude: does not fit' END,
        CASE WHEN abs(round(speed_kmh, 2)) >= 1000 THEN 'speed_kmh: does not fit' END) AS reasons, latitude
    FROM {source} WHERE NOT ({PLACE_FITS} AND {SPEED_FITS})"""


@query(f"WITH {SUMMARY_CTES} {_reasons_sql('dim_gps', '_id', 'gps')}"
       f" UNION ALL {_reasons_sql('fact_transport', 'vehicle_id', 'fact')}")
def publish_quarantine(spark, sf):
    """All tables published; the rows set aside, out of their full text."""
    root = scratch_dir(spark, "star")
    star.publish(star.build_star(star_inputs(spark, sf)), root)
    row = lambda c: F.get_json_object("row", f"$.{c}")
    return star.quarantine(spark, root).select(
        "table_name", F.coalesce(row("position_id"), row("vehicle_id")).alias("key"), "reasons",
        row("latitude").cast("double").alias("latitude"))


@query(STOP_SQL)
def recreate(spark, sf):
    """A declared table made anew, filled, and read."""
    sql.recreate(spark, ["dim_stop"], scratch_dir(spark, "recreated"))
    star.publishable(star.build_star(star_inputs(spark, sf), tables=["dim_stop"]))["dim_stop"].write.insertInto("dim_stop")
    df = spark.table("dim_stop")
    return df.select(*[F.col(c).cast("double") if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])
