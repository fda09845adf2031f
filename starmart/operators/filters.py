"""Row filters. They are plain predicates, so that they reach the scan where they can."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that have all of the keys."""
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def exclude_status(df: DataFrame, col: str, value) -> DataFrame:
    """Rows with another value; a null is not another value and drops too."""
    return df.filter(F.col(col) != F.lit(value))


def keep_valid_detail(df: DataFrame, person: str, status: str, bad_status, required) -> DataFrame:
    """Drop a row that names a person and is out of service or lacks a required column.

    Rows without a person stay whatever else they hold. With a person, an unknown status
    leaves the test unknown and the row drops, unless a column is missing as well, which
    drops it anyway.
    """
    broken = reduce(or_, [F.col(c).isNull() for c in required],
                    F.col(status) == F.lit(bad_status))
    return df.filter(~(F.col(person).isNotNull() & broken))


def search(df: DataFrame, term: str, cols=None) -> DataFrame | None:
    """Rows in which some text column contains ``term``, case-sensitively.

    ``None`` when there is no term or no text column to look into.
    """
    texts = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and (cols is None or f.name in cols)]
    if not term or not texts:
        return None
    return df.filter(reduce(or_, [F.col(f"`{c}`").contains(term) for c in texts]))


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """First row of each key in the given order.

    The ranked filter is recognised by the optimizer, which keeps one row per key in each
    task before the shuffle; a hot key is cut down where it lies.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__rn = 1").drop("__rn")
