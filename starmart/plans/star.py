"""The star: five dimensions and a fact per vehicle, or a fact per passenger record.

Inputs are five frames named ``transport``, ``passagers``, ``gps``, ``incident`` and
``stops`` with the columns of ``schemas.RAW_SCHEMAS`` and, after the document store, a
technical ``_id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import cleaning, joins, keys, projection
from starmart.operators.aggregates import latest_max_by, stop_counts, summarise
from starmart.operators.filters import exclude_status, keep_valid_detail, require_keys
from starmart.operators.quality import conform, with_reasons
from starmart.schemas import SCHEMAS, defaults
from starmart.session import materialise
from starmart.sources import filesystem, warehouse

ID = "_id"
COORDINATES = ("latitude", "longitude")
# Fixed value: the status of a vehicle that is out of service.
OUT_OF_SERVICE = "hors service"
PASSAGER_ORDER = ["vehicle_id", "timestamp", "stop_id", "passenger_count", "boarding",
                  "alighting"]
GPS_ORDER = ["vehicle_id", "timestamp", "route_id", "latitude", "longitude", "speed_kmh",
             "traffic_level"]


def _identified(df: DataFrame, name: str, prefix: str, order: list[str]) -> DataFrame:
    """The technical id under its published name, or a dense id where there is none."""
    if ID in df.columns:
        return df.withColumnRenamed(ID, name)
    if name in df.columns:
        return df
    return keys.add_sequence(df, name, prefix, order)


def dim_transport(df: DataFrame) -> DataFrame:
    return df.select(*SCHEMAS["dim_transport"].names)


def dim_passager(df: DataFrame) -> DataFrame:
    df = projection.flag_to_int(_identified(df, "passager_id", "pa_", PASSAGER_ORDER),
                                "alighting", "boarding")
    return projection.parse_ts(df, "timestamp").select(*SCHEMAS["dim_passager"].names)


def dim_gps(df: DataFrame) -> DataFrame:
    df = projection.cast_cols(_identified(df, "position_id", "po_", GPS_ORDER),
                              {c: "double" for c in (*COORDINATES, "speed_kmh")})
    return projection.parse_ts(df, "timestamp").select(*SCHEMAS["dim_gps"].names)


def dim_incident(df: DataFrame) -> DataFrame:
    df = projection.rename(df, {"Incidents_id": "incident_id"})
    df = projection.cast_cols(df, {"severity": "string"})
    return projection.parse_ts(df, "timestamp").select(*SCHEMAS["dim_incident"].names)


def dim_stop(df: DataFrame) -> DataFrame:
    """Stops; the links to a vehicle and a passenger stay null unless they are there."""
    df = projection.cast_cols(df, {c: "double" for c in COORDINATES})
    df = projection.flag_to_bool(df, "shelter")
    absent = {c: "string" for c in ("vehicle_id", "passager_id") if c not in df.columns}
    if absent:
        df = projection.add_typed_null(df, absent)
    return df.select(*SCHEMAS["dim_stop"].names)


def _attach(fact: DataFrame, df: DataFrame, summary: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return joins.enrich(fact, summary(df), "vehicle_id")


def summary_fact(transport, passagers, gps, incidents, tie, stops=None, attach=_attach) -> DataFrame:
    """One row per vehicle: its attributes, sums, counts and latest position.

    Every summary leaves its aggregation partitioned by vehicle_id, which is how the joins
    need it, so the joins add no shuffle of their own. ``attach`` joins the summary of an input to the
    fact where inputs are more than plain frames.
    """
    fact = attach(transport, passagers, lambda df: summarise(
        df, "vehicle_id", {"total_passengers": "passenger_count"}, count_as="passenger_records"))
    if stops is not None:
        fact = joins.enrich(fact, stops.select("vehicle_id", "stops_count"), "vehicle_id")
    fact = attach(fact, incidents, lambda df: summarise(
        df, "vehicle_id", {"total_delay_minutes": "delay_minutes"}, count_as="incident_count"))
    fact = attach(fact, gps, lambda df: latest_max_by(
        df, "vehicle_id", "timestamp", tie, ["vehicle_id", *COORDINATES, "speed_kmh", "traffic_level"]))
    values = {c: v for c, v in defaults(SCHEMAS["fact_transport"]).items() if c in fact.columns}
    order = [c for c in SCHEMAS["fact_transport"].names if c in fact.columns]
    return cleaning.fill_map(fact, values).select(*order)


def fact_summary(inputs: dict[str, DataFrame]) -> DataFrame:
    """The live form of the fact, straight from the inputs."""
    gps = projection.parse_ts(inputs["gps"], "timestamp")
    return summary_fact(dim_transport(inputs["transport"]), inputs["passagers"], gps,
                        inputs["incident"], ID if ID in gps.columns else "route_id")


def _clean(df: DataFrame, key_cols, round_coordinates: bool) -> DataFrame:
    """Trim, require the keys, fill, drop copies (whatever their technical id), round.

    Keys are tested before missing text is filled, or the test could never fail.
    """
    df = require_keys(cleaning.blank_strings(df.drop(ID)), *key_cols)
    texts = {c: "Unknown" for c, t in df.dtypes if t == "string"}
    df = cleaning.fill_numeric(cleaning.fill_map(df, texts))
    return cleaning.round_floats(cleaning.dedupe(df),
                                 exclude=() if round_coordinates else COORDINATES)


def _summary_full(inputs, wanted, excluded, round_coordinates) -> dict[str, DataFrame]:
    def clean(name, *key_cols):
        return _clean(inputs[name], key_cols, round_coordinates)

    transport = dim_transport(clean("transport", "vehicle_id"))
    passagers = clean("passagers", "vehicle_id", "stop_id")
    gps = clean("gps", "vehicle_id")
    incidents = dim_incident(clean("incident", "Incidents_id", "vehicle_id"))
    # Numbering writes a table; it is done for the tables asked for, and the fact then
    # reads the written one instead of cleaning again.
    if wanted & {"dim_passager", "bridge_stop_passager"}:
        passagers = dim_passager(passagers)
    if "dim_gps" in wanted:
        gps = dim_gps(gps)
    tables = {"dim_transport": transport, "dim_passager": passagers, "dim_gps": gps,
              "dim_incident": incidents}
    if wanted & {"dim_stop", "bridge_stop_passager", "fact_transport"}:
        transport = tables["dim_transport"] = materialise(transport, "transport")  # read several times
        stops = keys.assign_round_robin(
            clean("stops", "stop_id"), "stop_id", transport, "vehicle_id")
        tables["dim_stop"] = dim_stop(stops)
    if "bridge_stop_passager" in wanted:
        bridge = joins.stop_passager_bridge(
            stops.select("stop_id", "vehicle_id"), passagers, unique_ids=True)
        tables["bridge_stop_passager"] = cleaning.fill_map(bridge, {"passager_id": "0"})
    if "fact_transport" in wanted:
        if excluded is not None:
            transport = exclude_status(transport, "status", excluded)
        fact = summary_fact(transport, passagers, projection.parse_ts(gps, "timestamp"), incidents,
                            "route_id", stop_counts(stops, passagers))
        tables["fact_transport"] = cleaning.round_floats(
            fact, exclude=() if round_coordinates else COORDINATES)
    return tables


def build_star(inputs: dict[str, DataFrame], variant: str = "summary",
               excluded_status: str | None = OUT_OF_SERVICE, round_coordinates: bool = False,
               tables=None) -> dict[str, DataFrame]:
    """The tables of the star; with ``tables`` only those, and no work for the others.

    ``summary`` takes the inputs as they are and keeps every vehicle. ``summary_full``
    cleans them first, numbers passenger records and positions, gives each stop a vehicle
    in turn, adds ``stops_count`` and the stop–passenger bridge, and leaves vehicles of
    ``excluded_status`` out of the fact.
    """
    names = ["dim_transport", "dim_passager", "dim_gps", "dim_incident", "dim_stop",
             "fact_transport"]
    if variant == "summary":
        make = {
            "dim_transport": lambda: dim_transport(inputs["transport"]),
            "dim_passager": lambda: dim_passager(inputs["passagers"]),
            "dim_gps": lambda: dim_gps(inputs["gps"]),
            "dim_incident": lambda: dim_incident(inputs["incident"]),
            "dim_stop": lambda: dim_stop(inputs["stops"]),
            "fact_transport": lambda: fact_summary(inputs),
        }
        return {n: make[n]() for n in tables or names}
    if variant == "summary_full":
        wanted = tables or [*names, "bridge_stop_passager"]
        built = _summary_full(inputs, set(wanted), excluded_status, round_coordinates)
        return {n: built[n] for n in wanted}
    raise ValueError(f"unknown variant: {variant}")


def build_detail_fact(inputs: dict[str, DataFrame],
                      out_of_service: str = OUT_OF_SERVICE) -> DataFrame:
    """One row per vehicle and passenger record, with the stop of that record; vehicles
    without records once.

    A record carries its own stop only. Pairing it with every stop of its vehicle grows with
    the square of the vehicle's records and says nothing that this table and the distinct
    (vehicle, stop) pairs of ``joins.vehicle_stops`` do not say together.
    """
    transport = cleaning.trim_strings(inputs["transport"].drop(ID))
    transport = keys.add_sequence(transport, "transport_id", "t",
                                  ["vehicle_id", *[c for c in SCHEMAS["dim_transport"].names
                                                   if c != "vehicle_id"]])
    people = cleaning.dedupe(cleaning.trim_strings(inputs["passagers"], distinct=False),
                             ignore=[ID])
    people = _identified(people, "passager_id", "p", PASSAGER_ORDER).select(
        "passager_id", "vehicle_id", "passenger_count", "stop_id")
    stops = cleaning.trim_strings(inputs["stops"].drop(ID)).select(
        "stop_id", F.col("name").alias("stop_name"), F.col("latitude").alias("stop_latitude"),
        F.col("longitude").alias("stop_longitude"), F.col("zone").alias("stop_zone"))
    incidents = cleaning.dedupe(
        cleaning.trim_strings(inputs["incident"], distinct=False), ignore=[ID])
    delays = summarise(dim_incident(incidents), "vehicle_id",
                       {"total_delay_minutes": "delay_minutes"},
                       {"incident_count": "incident_id"})

    vehicles = joins.enrich(transport, delays, "vehicle_id")
    rows = joins.enrich(joins.attach_many(vehicles, people, "vehicle_id"), stops, "stop_id")
    rows = keep_valid_detail(rows, "passager_id", "status", out_of_service,
                             ["stop_name", "stop_latitude", "stop_longitude"])
    rows = cleaning.fill_round(rows, {
        "passenger_count": 0, "stop_latitude": 0.0, "stop_longitude": 0.0,
        "total_delay_minutes": 0, "incident_count": 0, "stop_name": "Unknown",
        "stop_zone": "Unknown", "passager_id": "Unknown"}, 2)
    return rows.select(
        "transport_id", *SCHEMAS["dim_transport"].names, "passager_id", "passenger_count",
        "stop_id", "stop_name", "stop_latitude", "stop_longitude", "stop_zone",
        "total_delay_minutes", "incident_count")


def publishable(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables in their declared types, ready for a sink; NaN goes as null.

    A value that does not fit its type stops the job; ``publish`` sorts such rows out.
    """
    return {name: conform(cleaning.nan_to_null(df), SCHEMAS[name], extra="drop")
            if name in SCHEMAS else df for name, df in star.items()}


REASONS, REFUSED, ROW, TABLE = "__reasons", "__refused", "__row", "__table"
ASIDE = T.StructType([T.StructField(c, T.StringType()) for c in (TABLE, REASONS, ROW)])


def _sorted_out(name: str, df: DataFrame) -> tuple[DataFrame, T.StructType]:
    """The rows as they are stored, good and refused ones in one frame, and the table's schema. A
    refused row has nulls in the table's columns, and its reasons and full text beside them."""
    if name in SCHEMAS:
        checked, schema = with_reasons(cleaning.nan_to_null(df), SCHEMAS[name], REASONS), SCHEMAS[name]
    else:
        checked, schema = df.withColumn(REASONS, F.array().cast("array<string>")), df.schema
    bad = F.size(REASONS) > 0
    whole = F.to_json(F.struct(*[f"`{c}`" for c in df.columns]))
    parted = checked.select(
        *[F.when(~bad, F.col(f"`{c}`")).alias(c) for c in df.columns], bad.alias(REFUSED),
        F.lit(name).alias(TABLE), F.when(bad, F.array_join(REASONS, "; ")).alias(REASONS),
        F.when(bad, whole).alias(ROW))
    more = T.StructType([*schema.fields, T.StructField(REFUSED, T.BooleanType()), *ASIDE.fields])
    return conform(parted, more, extra="drop"), T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def publish(star: dict[str, DataFrame], root: str) -> DataFrame:
    """Store the tables in the warehouse ``root`` as declared, and set aside what cannot be stored.

    Every table is computed and written once: rows with a value that does not fit, a null key or a
    repeated key into a part of their own, with their reasons and the full row as JSON; the others
    in their declared types. When all tables are written and counted, one commit puts them in the
    place of the present ones; until then, and if anything fails, readers have the old tables. Rows
    set aside are read as the table ``quarantine`` (``table_name``, ``reasons``, ``row``). Returns rows
    per table: ``sent``, ``stored`` and ``quarantined``.
    """
    spark = next(iter(star.values())).sparkSession
    report = []

    def write(run: str) -> dict[str, warehouse.Stored]:
        out = {}
        for name, df in star.items():
            seen = Observation()
            rows, schema = _sorted_out(name, df)
            path = f"{run}/{name}"
            (rows.observe(seen, F.count("*").alias("n"), F.count_if(REFUSED).alias("bad"))
             .write.partitionBy(REFUSED).parquet(f"{root}/{path}"))
            here = set(filesystem.names(spark, f"{root}/{path}"))
            good, aside = ([p] if (p := f"{path}/{REFUSED}={x}").rsplit("/", 1)[1] in here else [] for x in ("false", "true"))
            out[name] = warehouse.Stored(good, schema.json(), {"aside": aside})
            sent, wrong, stored = seen.get["n"], seen.get["bad"], out[name].read(spark, root).count()
            if stored != sent - wrong:
                raise RuntimeError(f"{name}: {sent - wrong} rows sent, {stored} stored; nothing was replaced")
            report.append((name, sent, stored, wrong))
        aside = [p for t in out.values() for p in t.notes["aside"]]
        return {**out, "quarantine": warehouse.Stored(aside, ASIDE.json())}

    warehouse.in_one_run(spark, root, write)
    return spark.createDataFrame(report, "table_name string, sent long, stored long, quarantined long")


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the last publication that were set aside: ``table_name``, ``reasons`` and ``row``."""
    return warehouse.read(spark, root, "quarantine").withColumnsRenamed(
        {TABLE: "table_name", REASONS: "reasons", ROW: "row"})
