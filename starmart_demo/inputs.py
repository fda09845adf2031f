"""The benchmark tables read as transit extracts.

vehicle = customer, passenger record = order, incident = error event, position = event,
stop = nation. Each mapping stands once as Spark and once as SQL (a list of CTEs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart_demo.registry import table


def star_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {n: table(spark, sf_dir, n) for n in
         ("customer", "orders", "events", "nation", "region")}
    text = lambda c: F.col(c).cast("string")
    transport = t["customer"].select(
        text("c_custkey").alias("vehicle_id"),
        F.col("c_mktsegment").alias("type_transport"),
        F.concat(F.lit("NATION_"), text("c_nationkey")).alias("company_name"),
        F.floor("c_acctbal").cast("int").alias("capacity"),
        F.when(F.col("c_acctbal") < 0, "Diesel").otherwise("Essence").alias("fuel_type"),
        F.col("c_mktsegment").alias("status"))
    passagers = t["orders"].select(
        text("o_orderkey").alias("_id"),
        F.floor("o_totalprice").cast("int").alias("passenger_count"),
        F.col("o_orderdate").alias("timestamp"),
        text("o_custkey").alias("vehicle_id"),
        F.concat(F.lit("NATION_"), (F.col("o_orderkey") % 30).cast("string")).alias("stop_id"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("False").alias("boarding"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "True").otherwise("False")
        .alias("alighting"))
    gps = t["events"].select(
        text("event_id").alias("_id"),
        F.col("event_type").alias("route_id"),
        text("user_id").alias("vehicle_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("latitude"),
        (-F.col("value")).alias("longitude"),
        F.col("value").alias("speed_kmh"),
        F.col("event_type").alias("traffic_level"))
    incident = t["events"].filter("event_type = 'error'").select(
        F.concat(F.lit("INC_"), text("event_id")).alias("Incidents_id"),
        text("user_id").alias("vehicle_id"),
        F.col("ts").alias("timestamp"),
        F.col("props").alias("description"),
        F.floor("value").cast("int").alias("delay_minutes"),
        (F.col("event_id") % 5 + 1).cast("int").alias("severity"))
    stops = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("stop_id"),
        F.col("n_name").alias("name"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        (-F.col("n_nationkey")).cast("double").alias("longitude"),
        F.col("r_name").alias("zone"),
        F.when(F.col("n_nationkey") % 2 == 0, "True").otherwise("False").alias("shelter"))
    return {"transport": transport, "passagers": passagers, "gps": gps,
            "incident": incident, "stops": stops}


INPUT_CTES = """
transport AS (
  SELECT CAST(c_custkey AS VARCHAR) AS vehicle_id, c_mktsegment AS type_transport,
         'NATION_' || c_nationkey AS company_name, CAST(floor(c_acctbal) AS INT) AS capacity,
         CASE WHEN c_acctbal < 0 THEN 'Diesel' ELSE 'Essence' END AS fuel_type,
         c_mktsegment AS status
  FROM customer),
passagers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS _id, CAST(floor(o_totalprice) AS INT) AS passenger_count,
         o_orderdate AS timestamp, CAST(o_custkey AS VARCHAR) AS vehicle_id,
         'NATION_' || (o_orderkey % 30) AS stop_id,
         CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS boarding,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'True' ELSE 'False' END AS alighting
  FROM orders),
gps AS (
  SELECT CAST(event_id AS VARCHAR) AS _id, event_type AS route_id,
         CAST(user_id AS VARCHAR) AS vehicle_id, ts AS timestamp, value AS latitude,
         -value AS longitude, value AS speed_kmh, event_type AS traffic_level
  FROM events),
incident AS (
  SELECT 'INC_' || event_id AS incident_id, CAST(user_id AS VARCHAR) AS vehicle_id,
         ts AS timestamp, props AS description, CAST(floor(value) AS INT) AS delay_minutes,
         CAST(event_id % 5 + 1 AS INT) AS severity
  FROM events WHERE event_type = 'error'),
stops AS (
  SELECT n_name AS stop_id, n_name AS name, CAST(n_nationkey AS DOUBLE) AS latitude,
         CAST(-n_nationkey AS DOUBLE) AS longitude, r_name AS zone,
         CASE WHEN n_nationkey % 2 = 0 THEN 'True' ELSE 'False' END AS shelter
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SUMMARY_CTES = INPUT_CTES + """,
people AS (
  SELECT vehicle_id, CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
         count(*) AS passenger_records
  FROM passagers GROUP BY vehicle_id),
delays AS (
  SELECT vehicle_id, CAST(sum(delay_minutes) AS BIGINT) AS total_delay_minutes,
         count(*) AS incident_count
  FROM incident GROUP BY vehicle_id),
latest AS (
  SELECT vehicle_id, latitude, longitude, speed_kmh, traffic_level FROM gps
  QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY timestamp DESC, _id DESC) = 1),
fact AS (
  SELECT t.vehicle_id, capacity, company_name, fuel_type, status, type_transport,
         coalesce(total_passengers, 0) AS total_passengers,
         coalesce(passenger_records, 0) AS passenger_records,
         coalesce(total_delay_minutes, 0) AS total_delay_minutes,
         coalesce(incident_count, 0) AS incident_count,
         coalesce(latitude, 0.0) AS latitude, coalesce(longitude, 0.0) AS longitude,
         coalesce(speed_kmh, 0.0) AS speed_kmh, coalesce(traffic_level, 'Unknown') AS traffic_level
  FROM transport t LEFT JOIN people p ON t.vehicle_id = p.vehicle_id
  LEFT JOIN delays d ON t.vehicle_id = d.vehicle_id
  LEFT JOIN latest l ON t.vehicle_id = l.vehicle_id)"""
