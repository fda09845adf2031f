"""Declared tables of the mart: types, keys, text widths and defaults.

Each target table is a ``StructType``; what plain types cannot say is kept in the
field metadata:

* ``pk``      the column is (part of) the primary key
* ``max_len`` widest text the column accepts
* ``default`` value that replaces a null when the table is published
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name, dtype, *, pk=False, max_len=None, default=None) -> T.StructField:
    """One declared column; keys are not nullable."""
    meta = {}
    if pk:
        meta["pk"] = True
    if max_len is not None:
        meta["max_len"] = max_len
    if default is not None:
        meta["default"] = default
    return T.StructField(name, dtype, not pk, meta)


def text(name, max_len=50, **kw) -> T.StructField:
    return column(name, T.StringType(), max_len=max_len, **kw)


def integer(name, **kw) -> T.StructField:
    return column(name, T.IntegerType(), **kw)


def long(name, **kw) -> T.StructField:
    return column(name, T.LongType(), **kw)


def number(name, precision, scale, **kw) -> T.StructField:
    return column(name, T.DecimalType(precision, scale), **kw)


def moment(name="timestamp") -> T.StructField:
    return column(name, T.TimestampType())


# Table names, column names, widths and precisions of the published mart.
SCHEMAS: dict[str, T.StructType] = {
    "dim_transport": T.StructType([
        text("vehicle_id", pk=True),
        integer("capacity"),
        text("company_name", 100),
        text("fuel_type"),
        text("status"),
        text("type_transport"),
    ]),
    "dim_passager": T.StructType([
        text("passager_id", pk=True),
        integer("alighting"),
        integer("boarding"),
        integer("passenger_count"),
        text("stop_id"),
        moment(),
        text("vehicle_id"),
    ]),
    "dim_gps": T.StructType([
        text("position_id", pk=True),
        number("latitude", 10, 8),
        number("longitude", 11, 8),
        text("route_id"),
        number("speed_kmh", 5, 2),
        moment(),
        text("traffic_level"),
        text("vehicle_id"),
    ]),
    "dim_incident": T.StructType([
        text("incident_id", pk=True),
        integer("delay_minutes"),
        text("description", None),
        text("severity"),
        moment(),
        text("vehicle_id"),
    ]),
    "dim_stop": T.StructType([
        text("stop_id", pk=True),
        number("latitude", 10, 8),
        number("longitude", 11, 8),
        text("name", 100),
        column("shelter", T.BooleanType()),
        text("zone"),
        text("vehicle_id"),
        text("passager_id"),
    ]),
    # Sums and counts are long: an int column would overflow long before the data does.
    "fact_transport": T.StructType([
        text("vehicle_id", pk=True),
        integer("capacity"),
        text("company_name", 100),
        text("fuel_type"),
        text("status"),
        text("type_transport"),
        long("total_passengers", default=0),
        long("passenger_records", default=0),
        long("stops_count", default=0),
        long("total_delay_minutes", default=0),
        long("incident_count", default=0),
        number("latitude", 10, 8, default=0.0),
        number("longitude", 11, 8, default=0.0),
        number("speed_kmh", 5, 2, default=0.0),
        text("traffic_level", default="Unknown"),
    ]),
    "operators": T.StructType([
        long("id", pk=True),
        text("operator_name", None),
        text("city", None),
        text("state_province", None),
        text("country", None),
    ]),
}

# Raw extracts, as read from their header files.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "transport": T.StructType([
        text("vehicle_id"), text("type_transport"), text("company_name", 100),
        integer("capacity"), text("fuel_type"), text("status"),
    ]),
    "passagers": T.StructType([
        integer("passenger_count"), moment(), text("vehicle_id"), text("stop_id"),
        text("boarding"), text("alighting"),
    ]),
    "gps": T.StructType([
        text("route_id"), text("vehicle_id"), moment(),
        column("latitude", T.DoubleType()), column("longitude", T.DoubleType()),
        column("speed_kmh", T.DoubleType()), text("traffic_level"),
    ]),
    "incident": T.StructType([
        text("Incidents_id"), text("vehicle_id"), moment(), text("description", None),
        integer("delay_minutes"), text("severity"),
    ]),
    "stops": T.StructType([
        text("stop_id"), text("name", 100), column("latitude", T.DoubleType()),
        column("longitude", T.DoubleType()), text("zone"), text("shelter"),
    ]),
}

# Header spellings found in older extracts and in the scraped catalogue.
HEADER_ALIASES: dict[str, str] = {
    "types_transport": "type_transport",
    "name_company": "company_name",
    "types_fuel": "fuel_type",
    "timeshamp": "timestamp",
    "speek_kmh": "speed_kmh",
    "incident_id": "Incidents_id",
}
OPERATOR_HEADERS: dict[str, str] = {
    "Operator Name (Short Name)": "operator_name",
    "City": "city",
    "State / Province": "state_province",
    "Country": "country",
}

# Domains the raw extracts are expected to stay within.
CAPACITY_BY_TYPE: dict[str, list[int]] = {
    "Bus interurbain": [60, 70, 80],
    "Taxi-Clin": [4, 7, 8],
    "Minicar": [20, 25, 30],
    "Car rapide": [20, 25, 30],
}
FUEL_TYPES = ["Diesel", "Essence", "Hybride"]
STATUSES = ["actif", "en maintenance", "hors service"]
TRAFFIC_LEVELS = ["Faible", "Modéré", "Élevé"]
ZONES = ["Zone Nord", "Centre-ville", "Banlieue", "Zone Sud", "Zone Est"]
DESCRIPTIONS = [
    "Panne moteur", "Crevaison", "Problème de freins",
    "Problème électrique", "Retard dû au trafic", "Accident mineur",
]
LATITUDE_BOX = (14.65, 14.85)
LONGITUDE_BOX = (-17.55, -17.25)
DELAY_RANGE = (0, 60)
SEVERITY_RANGE = (1, 5)

# Foreign keys as (child table, child column, parent table, parent column).
FOREIGN_KEYS = [
    ("dim_passager", "stop_id", "dim_stop", "stop_id"),
    ("dim_passager", "vehicle_id", "dim_transport", "vehicle_id"),
    ("dim_gps", "vehicle_id", "dim_transport", "vehicle_id"),
    ("dim_incident", "vehicle_id", "dim_transport", "vehicle_id"),
    ("dim_stop", "vehicle_id", "dim_transport", "vehicle_id"),
]


def primary_key(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.metadata.get("pk")]


def defaults(schema: T.StructType) -> dict[str, object]:
    return {f.name: f.metadata["default"] for f in schema if "default" in f.metadata}


def domain_rules(table: str) -> dict[str, Column]:
    """Conditions the columns of a published table are expected to meet; a null is not one of
    the expected values, but for coordinates and counts that a dimension may lack."""
    def one_of(name, values):
        return F.col(name).isin(values)

    def within(name, low, high):
        value = F.col(name).cast("double")
        return value.isNull() | value.between(low, high)
    place = {"latitude": within("latitude", *LATITUDE_BOX), "longitude": within("longitude", *LONGITUDE_BOX)}
    by_type = reduce(or_, [(F.col("type_transport") == kind) & F.col("capacity").isin(sizes)
                           for kind, sizes in CAPACITY_BY_TYPE.items()])
    return {
        "dim_transport": {"fuel_type": one_of("fuel_type", FUEL_TYPES), "status": one_of("status", STATUSES),
                          "type_transport": one_of("type_transport", list(CAPACITY_BY_TYPE)), "capacity": by_type},
        "dim_gps": {**place, "traffic_level": one_of("traffic_level", TRAFFIC_LEVELS)},
        "dim_incident": {"description": one_of("description", DESCRIPTIONS),
                         "delay_minutes": within("delay_minutes", *DELAY_RANGE),
                         "severity": F.col("severity").try_cast("int").between(*SEVERITY_RANGE)},
        "dim_stop": {**place, "zone": one_of("zone", ZONES)},
    }.get(table, {})
