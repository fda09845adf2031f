"""Column expressions used all over the mart. They take and return ``Column``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEMPORAL = (T.TimestampType, T.TimestampNTZType)


def blank_to_null(c: Column) -> Column:
    """Trimmed text; null when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def flag_to_int(c: Column) -> Column:
    """1 for true (boolean, or the text in any case), otherwise 0; null counts as false."""
    return F.when(F.lower(c.cast("string")) == "true", 1).otherwise(0)


def flag_to_bool(c: Column) -> Column:
    """Same reading of a flag as a boolean; null becomes false."""
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def parse_timestamp(c: Column, dtype: T.DataType, lenient: bool = False) -> Column:
    """Text to timestamp; a column that is a timestamp already passes unchanged.

    ``lenient`` gives null for text that is no timestamp instead of failing the job.
    """
    if isinstance(dtype, TEMPORAL):
        return c
    return F.try_to_timestamp(c) if lenient else F.to_timestamp(c)


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def megabytes(c: Column) -> Column:
    """Bytes as MiB, cut (not rounded) after two decimals."""
    return F.floor(c / F.lit(1048576.0) * 100) / 100


def iso_timestamp(c: Column) -> Column:
    """ISO text of a timestamp; the fraction appears only when there is one."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(c, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def number_text(c: Column) -> Column:
    """Shortest text of a double that reads back the same: plain from 0.0001 up to 1e16, with an
    exponent of two digits beyond, and always with a point or an exponent."""
    text = c.cast("double").cast("string")
    size = F.abs(c.cast("double"))
    digits = F.regexp_replace(F.regexp_replace(
        text.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.regexp_extract(text, "^(.*)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int")
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(
        F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return (F.when(~text.contains("E"), text)
            .when((size >= 1e-4) & (size < 1e16), digits)
            .otherwise(F.concat(mantissa, F.lit("e"), exponent)))


def document_text(c: Column, dtype: T.DataType) -> Column:
    """Text form of one document field; a missing value is the empty string."""
    if isinstance(dtype, TEMPORAL):
        value = iso_timestamp(c)
    elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        value = F.to_json(c)
    elif isinstance(dtype, T.BooleanType):
        value = F.initcap(c.cast("string"))
    elif isinstance(dtype, T.DoubleType):
        value = number_text(c)
    else:
        value = c.cast("string")
    return F.coalesce(value, F.lit(""))

