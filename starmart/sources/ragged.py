"""JSON documents whose keys change their type from batch to batch.

A schema found from all documents would have to read them all again with every batch, and makes text of
a key that is a number here and an object there. So documents are stored as variants, which keep every
value as it came. Each batch is asked once for the types of its keys; these are merged with those
known, and a type that widens is recorded with the batch that widened it. Columns are taken out of
the variants when the table is read: keys of one type in this type, keys of several as variants or
as their JSON text. Stored documents are never written or read again when a type widens.

A batch has a number; one that is not greater than the last one's has been taken up before.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources import filesystem, warehouse

REFUSED, BATCH = "__refused", "__batch"
STORED = T.StructType([T.StructField("doc", T.VariantType()), T.StructField(BATCH, T.LongType())])
ASIDE = T.StructType([T.StructField("line", T.StringType()), T.StructField(BATCH, T.LongType())])
HISTORY = "batch long, key string, before string, after string"


def parsed_type(text: str) -> T.DataType:
    """The type that ``schema_of_variant`` writes as text; objects are structs."""
    return T.DataType.fromDDL(re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: m[0] if m[0][0] == "`" else "STRUCT<", text))


def _digits(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (19, 0) if isinstance(t, T.LongType) else (t.precision - t.scale, t.scale)


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both without loss; a variant where there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    exact = (T.LongType, T.DecimalType)
    if isinstance(a, exact) and isinstance(b, exact):
        whole, scale = (max(x) for x in zip(_digits(a), _digits(b)))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.VariantType()
    if isinstance(a, T.DoubleType) or isinstance(b, T.DoubleType):
        other = b if isinstance(a, T.DoubleType) else a
        short = isinstance(other, T.DecimalType) and other.precision <= 15  # so much a double holds
        return T.DoubleType() if short else T.VariantType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        found = {f.name: f.dataType for f in a}
        for f in b:
            found[f.name] = merged_type(found.get(f.name, T.NullType()), f.dataType)
        return T.StructType([T.StructField(n, t) for n, t in sorted(found.items())])
    return T.VariantType()


def key_types(docs: DataFrame, doc: str = "doc") -> dict[str, T.DataType]:
    """The type of every key of the documents, in one pass that each task begins on its own. One
    line comes to the driver, as long as the list of keys."""
    found = docs.agg(F.schema_of_variant_agg(doc)).first()[0]
    kind = parsed_type(found) if found else T.NullType()
    return {f.name: f.dataType for f in kind} if isinstance(kind, T.StructType) else {}


def take_up(spark: SparkSession, root: str, name: str, lines: DataFrame, number: int) -> dict:
    """Store a batch of documents, one a line in the column ``value``, in the table ``name`` of a warehouse.

    Returns the ``version`` committed and the types that are ``new`` or wider, as (key, before, after).
    Blank and null lines are none; a line that is no JSON object, or names a key twice, goes to the
    table ``<name>_refused``. Empty objects and repeated documents are documents.
    """
    now = warehouse.snapshot(spark, root)
    stored, aside = now.tables.get(name), now.tables.get(f"{name}_refused")
    notes = stored.notes if stored else {"last": 0, "types": {}, "history": []}
    if number <= notes["last"]:
        return {"version": now.version, "new": []}
    changes: list[tuple[str, str | None, str]] = []

    def write(run: str) -> dict[str, warehouse.Stored]:
        path, line = f"{run}/{name}", F.col("value")
        rows = lines.where(F.length(F.trim(line)) > 0).select(line.alias("line"), F.when(
            F.ltrim(line).startswith("{"), F.try_parse_json(line)).alias("doc"))
        bad = F.col("doc").isNull()
        (rows.select("doc", F.when(bad, F.col("line")).alias("line"), F.lit(number).cast("long").alias(BATCH), bad.alias(REFUSED))
         .write.partitionBy(REFUSED).parquet(f"{root}/{path}"))
        here = set(filesystem.names(spark, f"{root}/{path}"))
        good, wrong = ([f"{path}/{p}"] if (p := f"{REFUSED}={x}") in here else [] for x in ("false", "true"))
        own = warehouse.Stored(good, STORED.json()).read(spark, root)
        types = {k: T.StructType.fromJson(json.loads(t))[0].dataType for k, t in notes["types"].items()}
        for key, kind in sorted(key_types(own).items()):
            before = types.get(key)
            after = kind if before is None else merged_type(before, kind)
            if after != before:
                types[key] = after
                changes.append((key, before.simpleString() if before else None, after.simpleString()))
        kept = {k: T.StructType([T.StructField("t", t)]).json() for k, t in types.items()}
        history = [*notes["history"], *[[number, *c] for c in changes]]
        return {name: warehouse.Stored([*(stored.paths if stored else []), *good], STORED.json(),
                                       {"last": number, "types": kept, "history": history}),
                f"{name}_refused": warehouse.Stored([*(aside.paths if aside else []), *wrong], ASIDE.json())}

    version = warehouse.in_one_run(spark, root, write, base=now.version)
    return {"version": version, "new": changes}


def _types(snapshot: warehouse.Snapshot, name: str) -> dict[str, T.DataType]:
    notes = snapshot.tables[name].notes
    return {k: T.StructType.fromJson(json.loads(t))[0].dataType for k, t in notes["types"].items()}


def widenings(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Which batch brought or widened the type of which key: ``batch``, ``key``, ``before`` (null for a
    new key), ``after``."""
    return spark.createDataFrame([tuple(r) for r in warehouse.snapshot(spark, root).tables[name].notes["history"]], HISTORY)


def _value(doc: Column, key: str, kind: str) -> Column:
    """A key of a variant, whatever characters are in its name."""
    quote = next((q for q in "'\"" if q not in key), None)
    if quote and "\\" not in key:
        return F.variant_get(doc, f"$[{quote}{key}{quote}]", kind)
    return F.element_at(doc.cast("map<string,variant>"), F.lit(key)).cast(kind)


def flatten(spark: SparkSession, root: str, name: str, conflicts: str = "variant", version: int | None = None) -> DataFrame:
    """All documents as a table with one column per key, in code-point order.

    A key of one type has this type; where a type is or holds a variant, because batches or documents
    differ, the column is a variant (``conflicts="variant"``) or JSON text (``"json"``), in which the text "1"
    and the number 1 differ. Keys that a document lacks are null. A key that differs from another by
    case only has a number after its name. With ``version`` as of that version of the warehouse.
    """
    if conflicts not in ("variant", "json"):
        raise ValueError(f"unknown form of conflicts: {conflicts}")
    snapshot = warehouse.snapshot(spark, root, version)
    docs, columns, seen = snapshot.tables[name].read(spark, root), [], {}
    for key, kind in sorted(_types(snapshot, name).items()):
        n = seen[key.lower()] = seen.get(key.lower(), 0) + 1
        doc = F.col("doc")
        if isinstance(kind, T.NullType):
            value = F.lit(None).cast("string")
        elif not _holds_variant(kind):
            value = _value(doc, key, kind.simpleString() if not _nested(kind) else _ddl(kind))
        else:
            value = _value(doc, key, "variant")
            value = F.to_json(value) if conflicts == "json" else value
        columns.append(value.alias(key if n == 1 else f"{key}_{n}"))
    return docs.select(*columns)


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType))


def _holds_variant(kind: T.DataType) -> bool:
    parts = [f.dataType for f in kind] if isinstance(kind, T.StructType) else (
        [kind.elementType] if isinstance(kind, T.ArrayType) else [])
    return isinstance(kind, T.VariantType) or reduce(lambda a, p: a or _holds_variant(p), parts, False)


def _ddl(kind: T.DataType) -> str:
    """A nested type as text, names quoted; parts that are always null are text."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join("`" + f.name.replace("`", "``") + "`: " + _ddl(f.dataType) for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return "string" if isinstance(kind, T.NullType) else kind.simpleString()
