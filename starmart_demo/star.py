"""The star, its joins and summaries, and the reports on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators import aggregates, joins
from starmart.plans import colocated, incremental, reports, star
from starmart.session import scratch_dir
from starmart_demo.inputs import INPUT_CTES, SUMMARY_CTES, star_inputs
from starmart_demo.registry import query, table


@query(f"WITH {SUMMARY_CTES} SELECT * FROM fact")
def fact_summary(spark, sf):
    return star.build_star(star_inputs(spark, sf), tables=["fact_transport"])["fact_transport"]


@query(f"WITH {SUMMARY_CTES} SELECT * FROM fact")
def fact_colocated(spark, sf):
    """The same fact out of inputs stored in buckets by vehicle; vehicles with many records stay aside."""
    root = scratch_dir(spark, "buckets")
    colocated.store(spark, root, star_inputs(spark, sf), 8, hot=0.02)
    return colocated.fact(spark, root)


FULL_CTES = SUMMARY_CTES + """,
slots AS (
  SELECT stop_id, (row_number() OVER (ORDER BY stop_id) - 1) % (SELECT count(*) FROM transport) AS k
  FROM stops),
takers AS (SELECT vehicle_id, row_number() OVER (ORDER BY vehicle_id) - 1 AS k FROM transport),
given AS (SELECT stop_id, vehicle_id FROM slots JOIN takers USING (k)),
stop_agg AS (
  SELECT vehicle_id, count(DISTINCT stop_id) AS stops_count FROM given GROUP BY vehicle_id),
numbered AS (
  SELECT *, 'pa_' || row_number() OVER (ORDER BY vehicle_id, timestamp, stop_id,
    passenger_count, boarding, alighting) AS passager_id
  FROM (SELECT DISTINCT passenger_count, timestamp, vehicle_id, stop_id, boarding, alighting
        FROM passagers)),
people_full AS (
  SELECT vehicle_id, CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
         count(*) AS passenger_records
  FROM numbered GROUP BY vehicle_id)"""


def _batches(inputs, n=3):
    """The inputs in parts, by a hash of the vehicle and the row: vehicles come before their records,
    after them, or at the same time."""
    keys = {"transport": "vehicle_id", "passagers": "_id", "gps": "_id", "incident": "Incidents_id"}
    part = lambda key: F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(n))
    return [{name: inputs[name].where(part(key) == i) for name, key in keys.items()} for i in range(n)]


@query(f"WITH {SUMMARY_CTES} SELECT * FROM fact")
def fact_in_batches(spark, sf):
    """Three batches, the second of them loaded twice."""
    root = scratch_dir(spark, "states")
    batches = _batches(star_inputs(spark, sf))
    for number, i in ((1, 0), (2, 1), (2, 1), (3, 2)):
        incremental.merge(spark, root, batches[i], number)
    return incremental.fact(spark, root)


@query(f"""
WITH {FULL_CTES}
SELECT f.* REPLACE (coalesce(p.total_passengers, 0) AS total_passengers,
                    coalesce(p.passenger_records, 0) AS passenger_records,
                    round(speed_kmh, 2) AS speed_kmh),
       coalesce(stops_count, 0) AS stops_count
FROM fact f LEFT JOIN stop_agg s ON f.vehicle_id = s.vehicle_id
LEFT JOIN people_full p ON f.vehicle_id = p.vehicle_id
WHERE status <> 'MACHINERY'
""")
def fact_summary_full(spark, sf):
    return star.build_star(star_inputs(spark, sf), "summary_full", "MACHINERY",
                           tables=["fact_transport"])["fact_transport"]


@query(f"""
WITH {FULL_CTES}
SELECT g.stop_id, g.vehicle_id, coalesce(n.passager_id, '0') AS passager_id
FROM given g LEFT JOIN numbered n ON g.stop_id = n.stop_id
""")
def bridge_stop_passager(spark, sf):
    return star.build_star(star_inputs(spark, sf), "summary_full",
                           tables=["bridge_stop_passager"])["bridge_stop_passager"]


@query(f"""
WITH {FULL_CTES},
used AS (SELECT stop_id, count(*) AS records FROM passagers GROUP BY stop_id)
SELECT vehicle_id, count(DISTINCT g.stop_id) AS stops_count,
       CAST(sum(greatest(coalesce(records, 0), 1)) AS BIGINT) AS stop_rows
FROM given g LEFT JOIN used u ON g.stop_id = u.stop_id GROUP BY vehicle_id
""")
def stop_counts(spark, sf):
    inputs = star_inputs(spark, sf)
    stops = star.keys.assign_round_robin(
        inputs["stops"], "stop_id", inputs["transport"], "vehicle_id")
    return aggregates.stop_counts(stops, inputs["passagers"])


@query(f"""
WITH {INPUT_CTES},
numbered AS (
  SELECT *, 't' || row_number() OVER (ORDER BY vehicle_id) AS transport_id FROM transport),
delays AS (
  SELECT vehicle_id, CAST(sum(delay_minutes) AS BIGINT) AS total_delay_minutes,
         count(incident_id) AS incident_count
  FROM incident GROUP BY vehicle_id),
people AS (
  SELECT min(_id) AS _id, passenger_count, vehicle_id, stop_id FROM passagers
  GROUP BY passenger_count, timestamp, vehicle_id, stop_id, boarding, alighting)
SELECT transport_id, t.vehicle_id, capacity, company_name, fuel_type, status, type_transport,
       coalesce(p._id, 'Unknown') AS passager_id, coalesce(passenger_count, 0) AS passenger_count,
       p.stop_id, coalesce(s.name, 'Unknown') AS stop_name,
       round(coalesce(s.latitude, 0.0), 2) AS stop_latitude,
       round(coalesce(s.longitude, 0.0), 2) AS stop_longitude,
       coalesce(s.zone, 'Unknown') AS stop_zone,
       coalesce(total_delay_minutes, 0) AS total_delay_minutes,
       coalesce(incident_count, 0) AS incident_count
FROM numbered t LEFT JOIN delays d ON t.vehicle_id = d.vehicle_id
LEFT JOIN people p ON t.vehicle_id = p.vehicle_id
LEFT JOIN stops s ON p.stop_id = s.stop_id
WHERE NOT (p._id IS NOT NULL AND (status = 'MACHINERY' OR s.name IS NULL
           OR s.latitude IS NULL OR s.longitude IS NULL))
""")
def fact_detail(spark, sf):
    return star.build_detail_fact(star_inputs(spark, sf), "MACHINERY")


@query(f"""
WITH {INPUT_CTES}
SELECT _id AS passager_id, CASE WHEN alighting = 'True' THEN 1 ELSE 0 END AS alighting,
       CASE WHEN boarding = 'True' THEN 1 ELSE 0 END AS boarding, passenger_count, stop_id,
       timestamp, vehicle_id
FROM passagers
""")
def dim_passager(spark, sf):
    return star.build_star(star_inputs(spark, sf))["dim_passager"]


@query(f"""
WITH {INPUT_CTES}
SELECT _id AS position_id, latitude, longitude, route_id, speed_kmh, timestamp, traffic_level,
       vehicle_id
FROM gps
""")
def dim_gps(spark, sf):
    return star.build_star(star_inputs(spark, sf))["dim_gps"]


@query(f"""
WITH {INPUT_CTES}
SELECT incident_id, delay_minutes, description, CAST(severity AS VARCHAR) AS severity, timestamp,
       vehicle_id
FROM incident
""")
def dim_incident(spark, sf):
    return star.build_star(star_inputs(spark, sf))["dim_incident"]


@query(f"WITH {INPUT_CTES} SELECT * FROM transport")
def dim_transport(spark, sf):
    return star.build_star(star_inputs(spark, sf))["dim_transport"]


@query(f"""
WITH {INPUT_CTES}
SELECT * REPLACE (shelter = 'True' AS shelter), CAST(NULL AS VARCHAR) AS vehicle_id, CAST(NULL AS VARCHAR) AS passager_id
FROM stops
""")
def dim_stop(spark, sf):
    return star.build_star(star_inputs(spark, sf))["dim_stop"]


@query("""
SELECT c_custkey, k AS n_nationkey, n_name, r_name
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, o_orderkey % 30 AS k FROM orders) ON c_custkey = o_custkey
LEFT JOIN nation ON k = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def bridge_join(spark, sf):
    """Customers → distinct (customer, nation of its orders) → nation details; customers without
    an order and nations that do not exist are kept."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 30).alias("n_nationkey"))
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    pairs = joins.vehicle_stops(orders, "c_custkey", "n_nationkey")
    return joins.bridge_join(
        table(spark, sf, "customer").select("c_custkey"), pairs,
        places.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", "r_name"),
        "c_custkey", "n_nationkey").select("c_custkey", "n_nationkey", "n_name", "r_name")


EVENT_COLS = ["user_id", "event_id", "ts", "event_type", "value"]


@query("""
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(spark, sf):
    return aggregates.latest_per_key(
        table(spark, sf, "events").select(*EVENT_COLS), "user_id", "ts", "event_id")


@query("""
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id
""")
def latest_max_by(spark, sf):
    return aggregates.latest_max_by(
        table(spark, sf, "events"), "user_id", "ts", "event_id", EVENT_COLS)


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_order(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return aggregates.latest_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey")


@query("""
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       count(*) AS orders
FROM orders GROUP BY o_custkey
""")
def sum_count_per_key(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = aggregates.summarise(orders, "o_custkey", {"total_price": "price"}, count_as="orders")
    return out.withColumn("total_price", F.col("total_price").cast("double"))


@query("""
SELECT user_id, CAST(sum(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18,2)) END)
       AS DOUBLE) AS total_delay, count(CASE WHEN event_type = 'error' THEN value END) AS errors,
       count(*) AS events
FROM events GROUP BY user_id
""")
def count_nonnull_per_key(spark, sf):
    """Only errors have a delay; the others are counted as events, not as errors."""
    events = table(spark, sf, "events").select("user_id", F.when(
        F.col("event_type") == "error", F.col("value").cast("decimal(18,2)")).alias("delay"))
    out = aggregates.summarise(events, "user_id", {"total_delay": "delay"},
                               {"errors": "delay"}, "events")
    return out.withColumn("total_delay", F.col("total_delay").cast("double"))


@query("""
SELECT c_custkey, c_mktsegment, event_id, event_type
FROM customer LEFT JOIN events ON c_custkey = user_id
""")
def attach_events(spark, sf):
    """Every customer with its events, customers without events once."""
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("c_custkey"), "event_id", "event_type")
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return joins.attach_many(customer, events, "c_custkey")


@query(f"""
WITH {SUMMARY_CTES}
SELECT CAST(sum(incident_count) AS BIGINT) AS total_incidents,
       round(avg(incident_count), 6) AS avg_incidents_per_vehicle,
       max(incident_count) AS max_incidents,
       CAST(sum(total_delay_minutes) AS BIGINT) AS total_delay,
       round(avg(total_delay_minutes), 6) AS avg_delay_per_vehicle,
       CAST(sum(total_passengers) AS BIGINT) AS total_passengers,
       round(avg(total_passengers), 6) AS avg_passengers,
       max(total_passengers) AS max_passengers
FROM fact
""")
def kpi_global(spark, sf):
    out = reports.kpis(star.fact_summary(star_inputs(spark, sf)))["totals"]
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith("avg_")})


@query(f"WITH {SUMMARY_CTES} SELECT type_transport, count(*) AS count FROM fact GROUP BY 1")
def kpi_by_type(spark, sf):
    return reports.kpis(star.fact_summary(star_inputs(spark, sf)))["by_type"]


@query(f"""
WITH {SUMMARY_CTES}
SELECT company_name, count(*) AS count FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def kpi_top_companies(spark, sf):
    return reports.kpis(star.fact_summary(star_inputs(spark, sf)))["top_companies"]


@query(f"""
WITH {SUMMARY_CTES}
SELECT 'capacity' AS column, count(capacity) AS count, round(avg(capacity), 6) AS mean,
       round(stddev_samp(capacity), 6) AS stddev, CAST(min(capacity) AS DOUBLE) AS min,
       CAST(max(capacity) AS DOUBLE) AS max
FROM fact
""")
def kpi_capacity(spark, sf):
    out = reports.kpis(star.fact_summary(star_inputs(spark, sf)))["capacity"]
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query("""
SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY 1
""")
def freq_desc(spark, sf):
    return aggregates.frequencies(table(spark, sf, "customer"), "c_mktsegment")


@query("""
SELECT c_nationkey, count(*) AS count FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def top10(spark, sf):
    return aggregates.top_k(table(spark, sf, "customer"), "c_nationkey", 10)


@query("""
SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_discount, l_tax, l_shipdate LIMIT 40
""")
def preview(spark, sf):
    return aggregates.preview(table(spark, sf, "lineitem"), 40, [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate"])


@query("SELECT * FROM part ORDER BY p_partkey LIMIT 5")
def head_sample(spark, sf):
    return aggregates.head(table(spark, sf, "part"), 5, "p_partkey")


def _relation(name, keys):
    return f"""
SELECT '{name}' AS table_name, count(*) AS distinct_keys,
       count(CASE WHEN k IN (SELECT c_custkey FROM customer) THEN 1 END) AS in_parent,
       count(CASE WHEN k NOT IN (SELECT c_custkey FROM customer) THEN 1 END) AS orphans
FROM (SELECT DISTINCT {keys})"""


@query(" UNION ALL ".join([
    _relation("customer", "c_custkey AS k FROM customer"),
    _relation("orders", "o_custkey AS k FROM orders"),
    _relation("events", "user_id AS k FROM events"),
    _relation("parts", "l_partkey AS k FROM lineitem")]))
def relationships(spark, sf):
    return joins.relationships({
        "customer": table(spark, sf, "customer").withColumnRenamed("c_custkey", "k"),
        "orders": table(spark, sf, "orders").withColumnRenamed("o_custkey", "k"),
        "events": table(spark, sf, "events").withColumnRenamed("user_id", "k"),
        "parts": table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "k"),
    }, "k", "customer")


@query(f"""
WITH {SUMMARY_CTES},
v AS (SELECT DISTINCT 'dim_transport' AS table_name, vehicle_id AS k FROM transport
      UNION ALL SELECT DISTINCT 'dim_passager', vehicle_id FROM passagers
      UNION ALL SELECT DISTINCT 'dim_incident', vehicle_id FROM incident
      UNION ALL SELECT DISTINCT 'fact_transport', vehicle_id FROM fact),
s AS (SELECT DISTINCT 'dim_stop' AS table_name, stop_id AS k FROM stops
      UNION ALL SELECT DISTINCT 'dim_passager', stop_id FROM passagers)
SELECT 'vehicle_id' AS key, table_name, count(*) AS distinct_keys,
       count(*) FILTER (WHERE k IN (SELECT vehicle_id FROM transport)) AS in_parent,
       count(*) FILTER (WHERE k NOT IN (SELECT vehicle_id FROM transport)) AS orphans
FROM v GROUP BY table_name
UNION ALL
SELECT 'stop_id', table_name, count(*),
       count(*) FILTER (WHERE k IN (SELECT stop_id FROM stops)),
       count(*) FILTER (WHERE k NOT IN (SELECT stop_id FROM stops))
FROM s GROUP BY table_name
""")
def relationship_report(spark, sf):
    return reports.relationship_report(star.build_star(star_inputs(spark, sf)))


FIT_FOUND = {("dim_gps", "latitude"): "(SELECT count(*) FROM gps WHERE abs(round(latitude, 8)) >= 100)",
             ("dim_gps", "longitude"): "(SELECT count(*) FROM gps WHERE abs(round(longitude, 8)) >= 1000)",
             ("dim_gps", "speed_kmh"): "(SELECT count(*) FROM gps WHERE abs(round(speed_kmh, 2)) >= 1000)",
             ("fact_transport", "latitude"): "(SELECT count(*) FROM fact WHERE abs(round(latitude, 8)) >= 100)",
             ("fact_transport", "longitude"): "(SELECT count(*) FROM fact WHERE abs(round(longitude, 8)) >= 1000)",
             ("fact_transport", "speed_kmh"): "(SELECT count(*) FROM fact WHERE abs(round(speed_kmh, 2)) >= 1000)"}
#: Columns whose type or width can be missed, by table; the other columns always fit.
FIT_CHECKED = {
    "dim_transport": ["vehicle_id", "type_transport", "company_name", "fuel_type", "status"],
    "dim_passager": ["passager_id", "stop_id", "timestamp", "vehicle_id"],
    "dim_gps": ["position_id", "latitude", "longitude", "route_id", "speed_kmh", "timestamp", "traffic_level", "vehicle_id"],
    "dim_incident": ["incident_id", "severity", "timestamp", "vehicle_id"],
    "dim_stop": ["stop_id", "latitude", "longitude", "name", "zone", "vehicle_id", "passager_id"],
    "fact_transport": ["vehicle_id", "company_name", "fuel_type", "status", "type_transport", "latitude", "longitude",
                       "speed_kmh", "traffic_level"]}
KEYS = {"dim_transport": "vehicle_id", "dim_passager": "passager_id", "dim_gps": "position_id",
        "dim_incident": "incident_id", "dim_stop": "stop_id", "fact_transport": "vehicle_id"}
ORPHANS = {("dim_passager", "stop_id"): "(SELECT count(DISTINCT stop_id) FROM passagers WHERE stop_id NOT IN (SELECT stop_id FROM stops))",
           ("dim_passager", "vehicle_id"): "(SELECT count(DISTINCT vehicle_id) FROM passagers WHERE vehicle_id NOT IN (SELECT vehicle_id FROM transport))",
           ("dim_gps", "vehicle_id"): "(SELECT count(DISTINCT vehicle_id) FROM gps WHERE vehicle_id NOT IN (SELECT vehicle_id FROM transport))",
           ("dim_incident", "vehicle_id"): "(SELECT count(DISTINCT vehicle_id) FROM incident WHERE vehicle_id NOT IN (SELECT vehicle_id FROM transport))",
           ("dim_stop", "vehicle_id"): "0"}


def _quality_sql() -> str:
    lines = [("key", t, k, "0") for t, k in KEYS.items()]
    lines += [("fit", t, c, FIT_FOUND.get((t, c), "0")) for t, columns in FIT_CHECKED.items() for c in columns]
    lines += [("reference", t, c, n) for (t, c), n in ORPHANS.items()]
    return f"WITH {SUMMARY_CTES} " + " UNION ALL ".join(
        f"SELECT '{check}' AS check, '{t}' AS table_name, '{c}' AS column, CAST({n} AS BIGINT) AS findings"
        for check, t, c, n in lines)


@query(_quality_sql())
def quality_report(spark, sf):
    """All lines, those without findings too."""
    return reports.quality_report(star.build_star(star_inputs(spark, sf)))


def _domain_sql() -> str:
    def outside(t, source, column, ok):
        return (f"SELECT 'domain' AS check, '{t}' AS table_name, '{column}' AS column,"
                f" count(*) FILTER (WHERE NOT coalesce({ok}, false)) AS findings FROM {source}")

    def one_of(c, values):
        return f"{c} IN ({', '.join(repr(v) for v in values)})"
    sizes = " OR ".join(f"(type_transport = '{k}' AND capacity IN ({', '.join(map(str, v))}))"
                        for k, v in schemas.CAPACITY_BY_TYPE.items())
    lat = "latitude IS NULL OR latitude BETWEEN {} AND {}".format(*schemas.LATITUDE_BOX)
    lon = "longitude IS NULL OR longitude BETWEEN {} AND {}".format(*schemas.LONGITUDE_BOX)
    parts = [outside("dim_transport", "transport", "fuel_type", one_of("fuel_type", schemas.FUEL_TYPES)),
             outside("dim_transport", "transport", "status", one_of("status", schemas.STATUSES)),
             outside("dim_transport", "transport", "type_transport", one_of("type_transport", schemas.CAPACITY_BY_TYPE)),
             outside("dim_transport", "transport", "capacity", sizes),
             outside("dim_gps", "gps", "latitude", lat), outside("dim_gps", "gps", "longitude", lon),
             outside("dim_gps", "gps", "traffic_level", one_of("traffic_level", schemas.TRAFFIC_LEVELS)),
             outside("dim_incident", "incident", "description", one_of("description", schemas.DESCRIPTIONS)),
             outside("dim_incident", "incident", "delay_minutes", "delay_minutes IS NULL OR delay_minutes BETWEEN 0 AND 60"),
             outside("dim_incident", "incident", "severity", "severity BETWEEN 1 AND 5"),
             outside("dim_stop", "stops", "latitude", lat), outside("dim_stop", "stops", "longitude", lon),
             outside("dim_stop", "stops", "zone", one_of("zone", schemas.ZONES)),
             "SELECT 'unique', 'dim_gps', 'vehicle_id, timestamp', (SELECT count(*) FROM (SELECT 1 FROM gps"
             " GROUP BY vehicle_id, timestamp HAVING count(*) > 1))"]
    return f"WITH {SUMMARY_CTES} " + " UNION ALL ".join(parts)


@query(_domain_sql())
def domain_report(spark, sf):
    return reports.domain_report(star.build_star(star_inputs(spark, sf)))


SQL_TEXT = """
SELECT n_name, c_mktsegment, count(*) AS customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
GROUP BY n_name, c_mktsegment HAVING count(*) > 1"""


@query(SQL_TEXT.format(customer="customer", nation="nation"))
def adhoc_sql(spark, sf):
    from starmart.plans import sql

    names = {n: sql.register(table(spark, sf, n), n) for n in ("customer", "nation")}
    return sql.query(spark, SQL_TEXT.format(**names))
