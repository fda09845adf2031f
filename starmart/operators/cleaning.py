"""Trimming, filling, rounding and removing duplicates. Every function is one projection
or one hash aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import columns as C

FLOATS = (T.DoubleType, T.FloatType)
FILLED = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)


def _map_columns(df: DataFrame, kinds, fn, exclude=(), only=None) -> DataFrame:
    """Apply ``fn(column, type)`` to the columns of some types; the others pass unchanged."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        hit = isinstance(f.dataType, kinds) and f.name not in exclude
        if hit and (only is None or f.name in only):
            c = fn(c, f.dataType).alias(f.name)
        out.append(c)
    return df.select(*out)


def trim_strings(df: DataFrame, distinct: bool = True) -> DataFrame:
    """Trim every text column, then drop rows that have become equal."""
    trimmed = _map_columns(df, T.StringType, lambda c, _: F.trim(c))
    return trimmed.dropDuplicates() if distinct else trimmed


def blank_strings(df: DataFrame, exclude=()) -> DataFrame:
    """Trim text; what is blank becomes null."""
    return _map_columns(df, T.StringType, lambda c, _: C.blank_to_null(c), exclude)


def fill_strings(df: DataFrame, value: str = "Unknown", exclude=()) -> DataFrame:
    """Trim text; blank and null become ``value``."""
    return _map_columns(
        df, T.StringType, lambda c, _: F.coalesce(C.blank_to_null(c), F.lit(value)), exclude)


def fill_numeric(df: DataFrame, value=0, exclude=()) -> DataFrame:
    """Null to ``value`` in int, bigint, float and double columns only."""
    return _map_columns(
        df, FILLED, lambda c, t: F.coalesce(c, F.lit(value).cast(t)), exclude)


def fill_map(df: DataFrame, values: dict) -> DataFrame:
    """Null to a default given per column; the type of the column stays."""
    return df.select(*[
        F.coalesce(F.col(f"`{f.name}`"), F.lit(values[f.name]).cast(f.dataType)).alias(f.name)
        if f.name in values else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def round_floats(df: DataFrame, n: int = 2, cols=None, exclude=()) -> DataFrame:
    """Round double and float columns half up; all of them, or only ``cols``."""
    return _map_columns(df, FLOATS, lambda c, _: F.round(c, n), exclude, cols)


def fill_round(df: DataFrame, values: dict, n: int = 2, exclude=()) -> DataFrame:
    """Per-column defaults, then rounding of the floating-point columns."""
    return round_floats(fill_map(df, values), n, exclude=exclude)


def dedupe(df: DataFrame, cols=None, ignore=()) -> DataFrame:
    """One row per distinct value of ``cols`` (default: all columns but ``ignore``).

    Grouping on the compared columns lets every task drop its own copies before the
    shuffle, so a row copied a billion times still sends one row per task. The columns
    not compared come, together, from the smallest of the copies: the same row each run.
    """
    keys = list(cols) if cols is not None else [c for c in df.columns if c not in ignore]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    if len(rest) == 1:  # a numeric minimum aggregates by hashing, a struct needs a sort
        return df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0])).select(*df.columns)
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__rest"))
    return kept.select(*[
        F.col(c) if c in keys else F.col(f"__rest.{c}").alias(c) for c in df.columns
    ])


def nan_to_null(df: DataFrame) -> DataFrame:
    return _map_columns(df, FLOATS, lambda c, t: C.nan_to_null(c).cast(t))
