import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.operators import profiling, quality
from starmart.plans import reports
from tests.conftest import plan, rows

MIXED = "n int, d double, c decimal(5,2), s string, b boolean"


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame([(1, 1.0, None, "a", True), (3, None, None, "a", None),
                                  (None, 4.0, None, None, False)], MIXED)


def test_describe_numeric_includes_decimals(mixed):
    assert rows(profiling.describe_numeric(mixed)) == [
        ("c", 0, None, None, None, None),
        ("d", 2, 2.5, pytest.approx(2.1213203), 1.0, 4.0),
        ("n", 2, 2.0, pytest.approx(1.4142135), 1.0, 3.0)]


def test_describe_without_numeric_columns(spark):
    assert profiling.describe_numeric(spark.createDataFrame([("a",)], "s string")).count() == 0


def test_null_profile_and_empty_table(mixed):
    assert rows(profiling.null_profile(mixed), "column", "nulls") == [
        ("b", 1), ("c", 3), ("d", 1), ("n", 1), ("s", 1)]
    assert profiling.null_profile(mixed).filter("column = 'c'").first()["null_pct"] == 100.0
    assert {tuple(r)[1:] for r in profiling.null_profile(mixed.limit(0)).collect()} == {(0, 0.0)}


def test_null_profile_is_one_aggregation(mixed):
    assert plan(profiling.null_profile(mixed)).count("HashAggregate") == 2  # partial and final


def test_distinct_profile_counts_null_once(spark, mixed):
    df = spark.createDataFrame([("a", None, "x" * 100), ("b", None, "x" * 100), (None, None, "x" * 99 + "y")],
                               "a string, b string, long string")
    want = [("a", 3), ("b", 1), ("long", 2)]
    assert rows(profiling.distinct_profile(df)) == want
    assert rows(profiling.distinct_profile(df, approx=True)) == want
    assert rows(profiling.distinct_profile(df.limit(0))) == [("a", 0), ("b", 0), ("long", 0)]
    assert rows(profiling.distinct_profile(df.limit(0), approx=True)) == [("a", 0), ("b", 0), ("long", 0)]
    assert profiling.distinct_profile(mixed.select("n")).count() == 0
    assert rows(profiling.distinct_profile(mixed, mixed.columns)) == [
        ("b", 3), ("c", 1), ("d", 3), ("n", 3), ("s", 2)]


def test_distinct_profile_reads_each_column_once(mixed, folder):
    mixed.write.parquet(folder("t"))
    text = plan(profiling.distinct_profile(mixed.sparkSession.read.parquet(folder("t")), ["s", "b", "n"], by_column=True))
    assert text.count("FileScan") == 3 and "Expand" not in text
    assert all(f"ReadSchema: struct<{c}>" in text for c in ("s:string", "b:boolean", "n:int"))


def test_shape_and_bounded_count(spark):
    assert tuple(profiling.shape(spark.range(7)).first()) == (7, 1)
    for n, want in ((999, (999, True)), (1000, (1000, False)), (5000, (1000, False)), (0, (0, True))):
        assert tuple(profiling.bounded_count(spark.range(n)).first()) == want


def test_row_share(spark):
    out = profiling.row_share({"a": spark.range(3), "b": spark.range(1), "c": spark.range(0)})
    assert rows(out, "table_name", "rows", "share_pct") == [("a", 3, 75.0), ("b", 1, 25.0), ("c", 0, 0.0)]
    assert profiling.row_share({"a": spark.range(0)}).first()["share_pct"] == 0.0


def test_distinct_keys_counts_null(spark):
    df = spark.createDataFrame([("x",), (None,), (None,)], "k string")
    assert rows(profiling.distinct_keys({"t": df}, "k")) == [("t", 2)]


def test_profile_report(mixed):
    out = reports.profile(mixed)
    assert [r["column"] for r in out.collect()] == mixed.columns
    s = out.filter("column = 's'").first()
    assert (s["type"], s["rows"], s["nulls"], s["distinct_values"], s["mean"]) == ("string", 3, 1, 2, None)


def test_schemas_declare_keys_and_defaults():
    assert {n: schemas.primary_key(s) for n, s in schemas.SCHEMAS.items()} == {
        "dim_transport": ["vehicle_id"], "dim_passager": ["passager_id"], "dim_gps": ["position_id"],
        "dim_incident": ["incident_id"], "dim_stop": ["stop_id"], "fact_transport": ["vehicle_id"],
        "operators": ["id"]}
    assert schemas.defaults(schemas.SCHEMAS["fact_transport"])["traffic_level"] == "Unknown"
    for child, col, parent, key in schemas.FOREIGN_KEYS:
        assert col in schemas.SCHEMAS[child].names and key in schemas.SCHEMAS[parent].names


def test_conform_by_name(spark):
    df = spark.createDataFrame([("7", "v1", 1)], "capacity string, vehicle_id string, _id int")
    schema = schemas.SCHEMAS["dim_transport"]
    with pytest.raises(ValueError, match="_id"):
        quality.conform(df, schema)
    out = quality.conform(df, schema, extra="drop")
    assert out.columns == schema.names and tuple(out.first()) == ("v1", 7, None, None, None, None)
    assert rows(quality.schema_gaps(df, schema)) == [
        ("_id", "extra"), ("company_name", "missing"), ("fuel_type", "missing"), ("status", "missing"),
        ("type_transport", "missing")]


def test_apply_defaults(spark):
    schema = schemas.SCHEMAS["fact_transport"]
    df = quality.conform(spark.createDataFrame([("v",)], "vehicle_id string"), schema)
    r = quality.apply_defaults(df, schema).first()
    assert (r["total_passengers"], float(r["speed_kmh"]), r["traffic_level"], r["status"]) == (0, 0.0, "Unknown", None)


def test_pk_and_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert rows(quality.check_pk(df, ["k"])) == [(None, 1), ("a", 2)]
    assert rows(quality.check_unique(df, ["k", "v"])) == [("a", 1, 2)]


def test_fk_orphans(spark):
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "vehicle_id string")
    parent = spark.createDataFrame([("a",), ("a",)], "vehicle_id string")
    assert rows(quality.check_fk(child, "vehicle_id", parent, "vehicle_id")) == [("z", 2)]


def test_fit_reports_instead_of_failing(spark):
    df = spark.createDataFrame([("x" * 51, 1000.0, 10.5), ("ok", 999.99, 200.0), (None, None, None)],
                               "vehicle_id string, speed_kmh double, latitude double")
    out = quality.check_fit(df, schemas.SCHEMAS["dim_gps"])
    assert rows(out) == [("latitude", 1), ("speed_kmh", 1), ("vehicle_id", 1)]


def test_fit_of_numbers_agrees_with_a_trial_cast(spark):
    values = [0.0, 999.994, 999.995, -999.996, 1000.0, 32767.9, 32768.0, -32768.9, -32769.0, 1e30,
              float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    for dtype in (T.DecimalType(5, 2), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(38, 8)):
        found = quality.check_fit(df, T.StructType([schemas.column("d", dtype)])).first()["violations"]
        tried = df.filter(F.col("d").isNotNull() & F.col("d").try_cast(dtype).isNull()).count()
        assert found == tried, dtype
    wide = spark.createDataFrame([(2**31,), (2**31 - 1,), (-2**31 - 1,), (-2**31,)], "n long")
    assert quality.check_fit(wide, T.StructType([schemas.integer("n")])).first()["violations"] == 2
    exact = spark.sql("SELECT explode(array(99.994, 99.995, -99.995, 1.0)) AS c")
    assert quality.check_fit(exact, T.StructType([schemas.number("c", 4, 2)])).first()["violations"] == 2


def test_domain_rules(spark):
    df = spark.createDataFrame([("Minicar", 25, 14.7), ("Minicar", 80, 14.7), ("Avion", 25, 50.0), (None, None, None)],
                               "type_transport string, capacity int, latitude double")
    out = quality.check_domain(df, {
        "capacity": quality.allowed_by_type("type_transport", "capacity", schemas.CAPACITY_BY_TYPE),
        "box": F.col("latitude").between(*schemas.LATITUDE_BOX)})
    assert rows(out) == [("box", 2), ("capacity", 3)]


def test_reconcile_and_empty(spark):
    out = quality.reconcile({"a": spark.range(3), "b": spark.range(2)}, {"a": spark.range(3), "b": spark.range(1)})
    assert rows(out) == [("a", 3, 3, True), ("b", 2, 1, False)]
    assert quality.is_empty(spark.range(0)).first()[0] is True
    assert quality.is_empty(spark.range(3)).first()[0] is False


def test_check_fit_skips_columns_of_the_same_type(spark):
    schema = T.StructType([schemas.integer("n"), schemas.text("s", 3)])
    out = quality.check_fit(spark.createDataFrame([(1, "abcd")], "n int, s string"), schema)
    assert rows(out) == [("s", 1)]
