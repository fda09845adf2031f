"""Checks of a table against its declaration. Each returns the findings as a DataFrame."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.cleaning import fill_map
from starmart.operators.profiling import _per_column
from starmart.schemas import defaults, primary_key


def conform(df: DataFrame, schema: T.StructType, extra: str = "error",
            lenient: bool = False) -> DataFrame:
    """The frame with exactly the declared columns, matched by name and cast.

    A column that is not there comes as nulls. A column that is not declared is an error,
    or is left out with ``extra="drop"``.
    """
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown and extra == "error":
        raise ValueError(f"columns not declared: {', '.join(unknown)}")
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            value = F.lit(None).cast(f.dataType)
        elif lenient:
            value = F.col(f"`{f.name}`").try_cast(f.dataType)
        else:
            value = F.col(f"`{f.name}`").cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


def schema_gaps(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that are missing from the frame or not declared."""
    rows = [(c, "missing") for c in schema.names if c not in df.columns]
    rows += [(c, "extra") for c in df.columns if c not in schema.names]
    return df.sparkSession.createDataFrame(rows, "column string, finding string")


def apply_defaults(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Nulls to the declared defaults."""
    return fill_map(df, {c: v for c, v in defaults(schema).items() if c in df.columns})


def check_unique(df: DataFrame, cols) -> DataFrame:
    """Values of ``cols`` that occur more than once, with their number of rows."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")


def check_pk(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once or have a null part."""
    null_part = reduce(or_, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | null_part)


def check_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child keys the parent does not have, with their number of rows; null refers to
    nothing and is no orphan. Children are counted per key before the join."""
    used = (child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key"))
            .agg(F.count("*").alias("n")))
    known = parent.select(F.col(pk).alias("key"))
    return used.join(known, "key", "left_anti")


INTEGER_BITS = {"byte": 8, "short": 16, "integer": 32, "long": 64}


def _outside(c: Column, have: T.DataType, low: int, high: int) -> Column | None:
    """Not strictly between two whole numbers, compared in the column's own kind of number."""
    if isinstance(have, T.IntegralType):
        return None if high >= 2**63 else (c <= low) | (c >= high)
    if isinstance(have, T.DecimalType):
        return None if high >= 10**38 else (c <= F.lit(Decimal(low))) | (c >= F.lit(Decimal(high)))
    # A double cannot hold -2**63 - 1; the next one below -2**63 is the first outside.
    below = c < float(low) if low == -2**63 - 1 else c <= float(low)
    return F.isnan(c) | below | (c >= float(high))


def _misfit(c: Column, have: T.DataType, want: T.StructField) -> Column | None:
    """Whether a value cannot be stored as declared; ``None`` if every value can."""
    target = want.dataType
    if isinstance(target, T.StringType):
        width = want.metadata.get("max_len")
        return None if width is None else F.length(c.cast("string")) > width
    if have == target:
        return None
    if isinstance(have, T.NumericType) and isinstance(target, T.DecimalType):
        bound = 10 ** (target.precision - target.scale)
        rounded = c if isinstance(have, T.IntegralType) else F.round(c, target.scale)
        return _outside(rounded, have, -bound, bound)
    if isinstance(have, T.NumericType) and isinstance(target, T.IntegralType):
        top = 2 ** (INTEGER_BITS[target.typeName()] - 1)
        return _outside(c, have, -top - 1, top)
    return c.isNotNull() & c.try_cast(target).isNull()


def check_fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per declared column: values too long or out of range for the declared type.

    One pass; the values are only tested, so a bad one is counted and stops nothing.
    Numbers are compared with the range of the type: a trial cast raises an exception
    inside for every value that overflows, which took 30 times as long.
    """
    tests = _misfits(df, schema)
    checked = df.select(*[t.alias(n) for n, t in tests.items()])
    return _per_column(checked, list(tests), {"violations": F.count_if}, "violations long")


def _misfits(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    tests = {}
    for f in schema.fields:
        if f.name in df.columns:
            bad = _misfit(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f)
            if bad is not None:
                tests[f.name] = bad
    return tests


def with_reasons(df: DataFrame, schema: T.StructType, out: str = "__reasons") -> DataFrame:
    """Every row with what stands against storing it as declared: an array of
    ``<column>: does not fit``, ``<column>: null key`` and ``<columns>: repeated key``.

    All rows that share a repeated key have that reason: none of them is preferred.
    """
    keys = primary_key(schema)
    reasons = [F.when(bad, f"{c}: does not fit") for c, bad in _misfits(df, schema).items()]
    reasons += [F.when(F.col(k).isNull(), f"{k}: null key") for k in keys]
    if not keys:
        return df.withColumn(out, F.array_compact(F.array(*reasons, F.lit(None).cast("string"))))
    known = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    repeated = check_unique(known, keys).select(*keys, F.lit(True).alias(out))
    marked = df.join(repeated, keys, "left")
    reasons.append(F.when(F.col(out), f"{', '.join(keys)}: repeated key"))
    return marked.select(*df.columns, F.array_compact(F.array(*reasons)).alias(out))


def key_and_fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``check_pk`` and ``check_fit`` in one pass: per ``check`` and ``column`` the findings.

    Rows are grouped by key, with the misfits of each key counted on the way.
    """
    keys, tests = primary_key(schema), _misfits(df, schema)
    names = list(tests)
    grouped = df.groupBy(*keys).agg(F.count("*").alias("n"), *[
        F.count_if(tests[c]).alias(f"bad_{i}") for i, c in enumerate(names)])
    broken = (F.col("n") > 1) | reduce(or_, [F.col(k).isNull() for k in keys])
    lines = [F.struct(F.lit("key").alias("check"), F.lit(", ".join(keys)).alias("column"),
                      F.count_if(broken).alias("findings"))]
    lines += [F.struct(F.lit("fit").alias("check"), F.lit(c).alias("column"),
                       F.coalesce(F.sum(f"bad_{i}"), F.lit(0)).alias("findings"))
              for i, c in enumerate(names)]
    return grouped.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def check_references(tables: dict[str, DataFrame], references) -> DataFrame:
    """``check_fk`` of many references at once: per (child, column, parent, key) the number of
    values that the parent lacks, in the order given.

    Each child is read once for all its references, each parent once for all that refer to it.
    """
    spark = next(iter(tables.values())).sparkSession
    parents = {(p, k): i for i, (p, k) in enumerate(dict.fromkeys((p, k) for _, _, p, k in references))}
    children: dict[str, list] = {}
    for i, (child, fk, p, k) in enumerate(references):
        children.setdefault(child, []).append(F.struct(
            F.lit(i).alias("reference"), F.lit(parents[p, k]).alias("parent"),
            F.col(fk).cast("string").alias("key")))
    used = reduce(DataFrame.unionByName, [
        tables[child].select(F.inline(F.array(*own))) for child, own in children.items()])
    used = used.where("key IS NOT NULL").distinct()
    known = reduce(DataFrame.unionByName, [
        tables[p].select(F.lit(i).alias("parent"), F.col(k).cast("string").alias("key"))
        for (p, k), i in parents.items()])
    orphans = (used.join(known, ["parent", "key"], "left_anti").groupBy("reference")
               .agg(F.count("*").alias("findings")))
    names = spark.createDataFrame([(i, child, fk) for i, (child, fk, _, _) in enumerate(references)],
                                  "reference int, table_name string, column string")
    return names.join(orphans, "reference", "left").select(
        "table_name", "column", F.coalesce("findings", F.lit(0)).alias("findings"))


def check_domain(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule (a condition that must hold); unknown counts as broken."""
    checked = df.select(*[(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()])
    out = _per_column(checked, list(rules), {"violations": F.count_if}, "violations long")
    return out.withColumnRenamed("column", "rule")


def allowed_by_type(kind: str, value: str, allowed: dict[str, list]) -> Column:
    """The value is one of those allowed for the row's type."""
    return reduce(or_, [
        (F.col(kind) == t) & F.col(value).isin(values) for t, values in allowed.items()])


def reconcile(sent: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """Rows sent and rows found after loading, per table."""
    def rows(tables, sent, loaded):
        return [df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), sent.alias("sent"), loaded.alias("loaded"))
            for name, df in tables.items()]

    n, none = F.col("n"), F.lit(None).cast("long")
    counts = reduce(DataFrame.unionByName, rows(sent, n, none) + rows(loaded, none, n))
    return (counts.groupBy("table_name").agg(F.max("sent").alias("sent"),
                                             F.max("loaded").alias("loaded"))
            .withColumn("ok", F.col("sent").eqNullSafe(F.col("loaded"))))


def is_empty(df: DataFrame) -> DataFrame:
    """One row: whether there is nothing to publish. Found out here and now, from the first
    partitions that have a row."""
    return df.sparkSession.createDataFrame([(df.isEmpty(),)], "is_empty boolean")
