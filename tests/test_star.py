import os
from datetime import datetime

import pytest

from starmart import schemas
from starmart.operators import joins, quality
from starmart.plans import reports, star
from starmart.sources import files, warehouse
from tests.conftest import plan, rows

T1, T2, T3 = datetime(2025, 7, 1), datetime(2025, 7, 2), datetime(2025, 7, 3)


@pytest.fixture(scope="module")
def inputs(spark):
    """Small extracts with an orphan, ties, blanks, copies under other ids, unused parts."""
    return {
        "transport": spark.createDataFrame([
            ("t1", "V1", "Minicar", "Transcap", 25, "Diesel", "actif"),
            ("t2", "V2", "Minicar ", " ", 20, "Diesel", "hors service"),
            ("t3", "V3", "Car rapide", "Transcap", None, None, "actif"),
            ("t4", "V4", "Taxi-Clin", "SenMobil", 4, "Essence", None),
            ("t5", "V3", "Car rapide", "Transcap", None, None, "actif"),  # copy of t3
        ], "_id string, vehicle_id string, type_transport string, company_name string, capacity int, "
           "fuel_type string, status string"),
        "passagers": spark.createDataFrame([
            ("p1", 10, T1, "V1", "S1", "True", "False"),
            ("p2", 5, T2, "V1", "S2", "False", "True"),
            ("p3", 5, T2, "V1", "S2", "False", "True"),   # copy of p2
            ("p4", 7, T1, "V2", "S1", None, "True"),
            ("p5", 9, T1, "VX", "S9", "True", "True"),    # orphan vehicle and stop
            ("p6", 3, T3, "V4", "S9", "true", "x"),       # orphan stop
        ], "_id string, passenger_count int, timestamp timestamp, vehicle_id string, stop_id string, "
           "boarding string, alighting string"),
        "gps": spark.createDataFrame([
            ("g1", "R1", "V1", T1, 14.123456, -17.1, 50.0, "Faible"),
            ("g2", "R1", "V1", T3, 14.2, -17.2, 60.555, "Élevé"),
            ("g3", "R2", "V1", T3, 14.3, -17.3, 70.0, "Modéré"),   # same time as g2
            ("g4", "R2", "V2", None, 14.4, -17.4, 1000.0, "Faible"),
            ("g5", "R2", "V2", T1, 14.5, -17.5, float("nan"), "Modéré"),
        ], "_id string, route_id string, vehicle_id string, timestamp timestamp, latitude double, "
           "longitude double, speed_kmh double, traffic_level string"),
        "incident": spark.createDataFrame([
            ("i1", "INC_1", "V1", T1, "Crevaison", 30, 2),
            ("i2", "INC_2", "V1", T2, "Panne moteur", None, 5),
            ("i3", "INC_3", "V3", T2, "Crevaison", 12, 1),
        ], "_id string, Incidents_id string, vehicle_id string, timestamp timestamp, description string, "
           "delay_minutes int, severity int"),
        "stops": spark.createDataFrame([
            ("s1", "S1", "A", 14.777885, -17.5, "Banlieue", "True"),
            ("s2", "S2", "B", 14.7, -17.4, "Zone Est", "False"),
            ("s3", "S3", "C", 14.8, -17.3, "Zone Sud", None),
        ], "_id string, stop_id string, name string, latitude double, longitude double, zone string, "
           "shelter string"),
    }


MEASURES = ("vehicle_id", "total_passengers", "passenger_records", "total_delay_minutes", "incident_count",
            "latitude", "traffic_level")


def test_summary_fact(inputs):
    tables = star.build_star(inputs)
    assert rows(tables["fact_transport"].dropDuplicates(), *MEASURES) == [
        ("V1", 20, 3, 30, 2, 14.3, "Modéré"),
        ("V2", 7, 1, 0, 0, 14.5, "Modéré"),
        ("V3", 0, 0, 12, 1, 0.0, "Unknown"),
        ("V4", 3, 1, 0, 0, 0.0, "Unknown")]
    assert tables["fact_transport"].columns == [
        c for c in schemas.SCHEMAS["fact_transport"].names if c != "stops_count"]


def test_summary_dimensions(inputs):
    tables = star.build_star(inputs)
    for name in ("dim_transport", "dim_passager", "dim_gps", "dim_incident", "dim_stop"):
        assert tables[name].columns == schemas.SCHEMAS[name].names
    people = {r["passager_id"]: (r["alighting"], r["boarding"]) for r in tables["dim_passager"].collect()}
    assert people == {"p1": (0, 1), "p2": (1, 0), "p3": (1, 0), "p4": (1, 0), "p5": (1, 1), "p6": (0, 1)}
    assert rows(tables["dim_stop"], "stop_id", "shelter", "vehicle_id", "passager_id") == [
        ("S1", True, None, None), ("S2", False, None, None), ("S3", False, None, None)]
    assert dict(tables["dim_incident"].dtypes)["severity"] == "string"


def test_summary_reports_the_repeated_vehicle(inputs):
    fact = star.build_star(inputs)["fact_transport"]
    assert rows(quality.check_pk(fact, ["vehicle_id"])) == [("V3", 2)]


def test_ids_are_given_where_extracts_have_none(inputs):
    raw = {n: df.drop("_id") for n, df in inputs.items()}
    tables = star.build_star(raw)
    assert sorted(r["passager_id"] for r in tables["dim_passager"].collect()) == [
        f"pa_{i}" for i in range(1, 7)]
    assert rows(tables["dim_gps"], "position_id", "route_id")[0] == ("po_1", "R1")


def test_full_summary(inputs):
    tables = star.build_star(inputs, "summary_full")
    assert rows(tables["fact_transport"], "vehicle_id", "total_passengers", "passenger_records", "stops_count",
                "company_name", "capacity", "traffic_level") == [
        ("V1", 15, 2, 1, "Transcap", 25, "Modéré"),
        ("V3", 0, 0, 1, "Transcap", 0, "Unknown"),
        ("V4", 3, 1, 0, "SenMobil", 4, "Unknown")]  # a missing status was filled, so V4 stays
    assert tables["fact_transport"].columns == schemas.SCHEMAS["fact_transport"].names
    assert rows(tables["dim_transport"], "vehicle_id", "company_name", "type_transport")[1] == (
        "V2", "Unknown", "Minicar")
    assert rows(tables["dim_stop"], "stop_id", "vehicle_id") == [("S1", "V1"), ("S2", "V2"), ("S3", "V3")]
    assert rows(tables["bridge_stop_passager"], "stop_id", "passager_id") == [
        ("S1", "pa_1"), ("S1", "pa_3"), ("S2", "pa_2"), ("S3", "0")]
    assert quality.check_pk(tables["dim_stop"], ["stop_id"]).isEmpty()
    assert quality.check_pk(tables["dim_passager"], ["passager_id"]).isEmpty()


def test_full_summary_keeps_coordinates_unless_told(inputs):
    exact = star.build_star(inputs, "summary_full")["dim_gps"]
    assert exact.filter("latitude = 14.123456").count() == 1
    rounded = star.build_star(inputs, "summary_full", round_coordinates=True)["dim_gps"]
    assert rounded.filter("latitude = 14.12").count() == 1
    kept = star.build_star(inputs, "summary_full", excluded_status=None)["fact_transport"]
    assert kept.count() == 4


def test_full_summary_requires_keys_before_filling(spark, inputs):
    extra = spark.createDataFrame([("t9", "  ", "Minicar", "Transcap", 25, "Diesel", "actif")],
                                  inputs["transport"].schema)
    tables = star.build_star({**inputs, "transport": inputs["transport"].union(extra)}, "summary_full")
    assert tables["dim_transport"].count() == 4


def test_sums_are_conserved_without_orphans(inputs):
    people = inputs["passagers"].filter("vehicle_id <> 'VX'")
    fact = star.build_star({**inputs, "passagers": people, "transport": inputs["transport"].filter("_id <> 't5'")})[
        "fact_transport"]
    assert fact.agg({"total_passengers": "sum"}).first()[0] == people.agg({"passenger_count": "sum"}).first()[0]
    assert fact.count() == fact.select("vehicle_id").distinct().count()


def test_detail_fact(inputs):
    out = star.build_detail_fact(inputs)
    assert rows(out, "vehicle_id", "passager_id", "stop_name", "stop_latitude", "total_delay_minutes") == [
        ("V1", "p1", "A", 14.78, 30), ("V1", "p2", "B", 14.7, 30),
        ("V3", "Unknown", "Unknown", 0.0, 12)]  # V2 is out of service, the stop of V4 is unknown
    assert out.columns[0] == "transport_id" and out.filter("vehicle_id = 'V1'").first()["transport_id"] == "t1"


def test_detail_and_pairs_say_what_the_fan_out_says(spark, inputs):
    """Record × stop pairs follow from the records and the distinct (vehicle, stop) pairs."""
    cars = inputs["transport"].select("vehicle_id").distinct()
    people = inputs["passagers"].select("_id", "vehicle_id")
    pairs = joins.vehicle_stops(inputs["passagers"], "vehicle_id", "stop_id")
    records = joins.attach_many(cars, people, "vehicle_id")
    fan_out = joins.bridge_join(records, pairs, inputs["stops"].select("stop_id", "name"), "vehicle_id", "stop_id",
                                fan_out=True)
    by_pass = {r["vehicle_id"]: r["n"] for r in people.groupBy("vehicle_id").count().toDF("vehicle_id", "n").collect()}
    by_stop = {r["vehicle_id"]: r["n"] for r in pairs.groupBy("vehicle_id").count().toDF("vehicle_id", "n").collect()}
    ids = [r["vehicle_id"] for r in cars.collect()]
    assert fan_out.count() == sum(max(1, by_pass.get(v, 0)) * max(1, by_stop.get(v, 0)) for v in ids) == 9


def test_only_the_tables_asked_for(inputs):
    fact = star.build_star(inputs, "summary_full", tables=["fact_transport"])
    assert list(fact) == ["fact_transport"]
    assert rows(fact["fact_transport"]) == rows(star.build_star(inputs, "summary_full")["fact_transport"])
    assert list(star.build_star(inputs, tables=["dim_stop"])) == ["dim_stop"]


def test_unknown_variant(inputs):
    with pytest.raises(ValueError):
        star.build_star(inputs, "other")


def test_publishing_is_strict(inputs):
    tables = star.publishable(star.build_star(inputs, "summary_full"))
    for name, schema in schemas.SCHEMAS.items():
        if name in tables:
            assert [(f.name, f.dataType) for f in tables[name].schema] == [(f.name, f.dataType) for f in schema]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        tables["dim_gps"].collect()  # 1000 km/h does not fit


def test_publish_sets_misfits_aside(spark, inputs, folder):
    import json

    tables = star.build_star(inputs, "summary_full")
    report = {r["table_name"]: r for r in star.publish(tables, folder("w")).collect()}
    for name, df in tables.items():
        r = report[name]
        assert r["sent"] == df.count() == r["stored"] + r["quarantined"]
        assert files.read_table(spark, folder("w"), name).count() == r["stored"]
    aside = star.quarantine(spark, folder("w")).collect()
    assert report["dim_gps"]["quarantined"] == 1 and len(aside) == sum(r["quarantined"] for r in report.values())
    gps = next(r for r in aside if r["table_name"] == "dim_gps")
    assert gps["reasons"] == "speed_kmh: does not fit" and json.loads(gps["row"])["speed_kmh"] == 1000.0
    star.publish(tables, folder("w"))  # replaces
    assert len(aside) == star.quarantine(spark, folder("w")).count()
    assert warehouse.vacuum(spark, folder("w")) > 0  # leaves nothing behind
    assert len(os.listdir(folder("w/_commits"))) <= 2 and warehouse.snapshot(spark, folder("w")).version == 2


def test_misfits_of_every_kind(spark):
    from starmart.operators.quality import with_reasons

    schema = schemas.SCHEMAS["dim_incident"]
    rows_ = [("i1", 1, "d", "1"), ("i1", 2, "d", "1"), (None, 1, "d", "1"), ("x" * 60, 1, "d", "1"), ("ok", 1, "d", "1")]
    df = spark.createDataFrame(rows_, "incident_id string, delay_minutes long, description string, severity string")
    found = {(r["incident_id"] or "", r["delay_minutes"]): r["__reasons"] for r in with_reasons(df, schema).collect()}
    assert found[("i1", 1)] == found[("i1", 2)] == ["incident_id: repeated key"] and found[("ok", 1)] == []
    assert found[("", 1)] == ["incident_id: null key"] and found[("x" * 60, 1)] == ["incident_id: does not fit"]


def test_fact_shuffles_each_input_once(spark, inputs):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.fact_summary(inputs))
        assert text.count("Exchange") == 4 and "SinglePartition" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quality_report(inputs):
    report = reports.quality_report(star.build_star(inputs))
    assert report.where("check = 'reference'").count() == len(schemas.FOREIGN_KEYS)
    assert report.where("findings = 0").count() > 20
    found = report.filter("findings > 0")
    assert rows(found) == [
        ("fit", "dim_gps", "speed_kmh", 2), ("fit", "fact_transport", "speed_kmh", 1),
        ("key", "dim_transport", "vehicle_id", 1), ("key", "fact_transport", "vehicle_id", 1),
        ("reference", "dim_passager", "stop_id", 1), ("reference", "dim_passager", "vehicle_id", 1)]


def test_domain_report(spark):
    tables = {"dim_transport": spark.createDataFrame(
        [("a", 60, "Diesel", "actif", "Bus interurbain"), ("b", 60, "Gaz", "actif", "Taxi-Clin"), ("c", None, None, "vendu", "Minicar")],
        "vehicle_id string, capacity int, fuel_type string, status string, type_transport string"),
        "dim_gps": spark.createDataFrame([("p", 14.7, -17.3, "Faible", "a", "t"), ("q", 15.0, None, "?", "a", "t")],
                                         "position_id string, latitude double, longitude double, traffic_level string,"
                                         " vehicle_id string, timestamp string")}
    assert rows(reports.domain_report(tables)) == [
        ("domain", "dim_gps", "latitude", 1), ("domain", "dim_gps", "longitude", 0), ("domain", "dim_gps", "traffic_level", 1),
        ("domain", "dim_transport", "capacity", 2), ("domain", "dim_transport", "fuel_type", 2),
        ("domain", "dim_transport", "status", 1), ("domain", "dim_transport", "type_transport", 0),
        ("unique", "dim_gps", "vehicle_id, timestamp", 1)]


def test_reports(inputs):
    tables = star.build_star(inputs, "summary_full")
    out = rows(reports.relationship_report(tables))
    assert ("vehicle_id", "dim_passager", 4, 3, 1) in out and ("stop_id", "dim_passager", 3, 2, 1) in out
    k = reports.kpis(tables["fact_transport"])
    assert [tuple(r) for r in k["top_companies"].collect()] == [("Transcap", 2), ("SenMobil", 1)]
    assert k["capacity"].first()["max"] == 25.0
    assert k["totals"].first()["total_stops"] == 2
    summary = {r["table_name"]: r["rows"] for r in reports.warehouse_summary(tables).collect()}
    assert summary["dim_stop"] == 3 and summary["fact_transport"] == 3
