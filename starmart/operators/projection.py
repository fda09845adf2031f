"""Choosing, renaming and typing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import columns as C


def project(df: DataFrame, cols) -> DataFrame:
    """The given columns in the given order; a dict maps output name to input column."""
    if isinstance(cols, dict):
        return df.select(*[F.col(src).alias(out) for out, src in cols.items()])
    return df.select(*cols)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Old name to new name; names the frame lacks are skipped."""
    return df.withColumnsRenamed(names)


def rename_headers(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Map header spellings to column names, matching them without case or outer blanks."""
    wanted = {k.strip().lower(): v for k, v in mapping.items()}
    return df.select(*[
        F.col(f"`{c}`").alias(wanted.get(c.strip().lower(), c)) for c in df.columns
    ])


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    """All replacements in one projection; columns the frame lacks are ignored."""
    present = {c: e for c, e in exprs.items() if c in df.columns}
    return df.withColumns(present) if present else df


def cast_cols(df: DataFrame, dtypes: dict, lenient: bool = False) -> DataFrame:
    """Cast columns; ``lenient`` gives null where a value does not fit."""
    return _replace(df, {
        c: F.col(c).try_cast(t) if lenient else F.col(c).cast(t) for c, t in dtypes.items()
    })


def flag_to_int(df: DataFrame, *cols: str) -> DataFrame:
    return _replace(df, {c: C.flag_to_int(F.col(c)) for c in cols})


def flag_to_bool(df: DataFrame, *cols: str) -> DataFrame:
    return _replace(df, {c: C.flag_to_bool(F.col(c)) for c in cols})


def add_typed_null(df: DataFrame, dtypes: dict) -> DataFrame:
    """New columns that hold only nulls of the given type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in dtypes.items()})


def parse_ts(df: DataFrame, *cols: str, lenient: bool = False) -> DataFrame:
    """Turn text columns into timestamps where the frame has them."""
    return _replace(df, {
        c: C.parse_timestamp(F.col(c), df.schema[c].dataType, lenient)
        for c in cols if c in df.columns
    })
