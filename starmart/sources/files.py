"""CSV, Parquet and directory sources."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.columns import megabytes
from starmart.operators.projection import rename
from starmart.session import together
from starmart.sources import inference, quoted, warehouse
from starmart.sources.filesystem import listing


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None, *,
             infer: bool = True, multiline: bool = False, escape: str = '"',
             aliases: dict[str, str] | None = None, lenient: bool = False) -> DataFrame:
    """A CSV with a header.

    With ``schema`` the columns are found by header name, whatever their order, and cast;
    columns outside the schema are kept as text (a technical ``_id``, say). Without one the
    types are inferred, which costs a second pass, or stay text with ``infer=False``.
    A quote inside a quoted value is doubled, as ``save`` writes it and as most programs do;
    ``escape`` names another character that stands before it. ``multiline`` reads line breaks
    inside quotes, at the cost of another pass or two, so that is off unless asked for. Where quotes are
    doubled and no types are inferred, such files are read in splits (``quoted``); otherwise by
    one task each.
    """
    if multiline and escape == '"' and (schema is not None or not infer):
        raw = quoted.read_quoted(spark, path)
        if aliases:
            raw = rename(raw, aliases)
        return raw if schema is None else _typed(raw, schema, lenient)
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", escape)
    if multiline:
        reader = reader.option("multiLine", True)
    raw = reader.option("inferSchema", schema is None and infer).csv(path)
    if aliases:
        raw = rename(raw, aliases)
    return raw if schema is None else _typed(raw, schema, lenient)


def _typed(raw: DataFrame, schema: T.StructType, lenient: bool) -> DataFrame:
    others = [F.col(f"`{c}`") for c in raw.columns if c not in schema.names]
    typed = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)
        value = c.try_cast(f.dataType) if lenient else c.cast(f.dataType)
        typed.append(value.alias(f.name))
    return raw.select(*others, *typed)


def load_manifest(spark: SparkSession, paths: dict[str, str], **options) -> dict[str, DataFrame]:
    """Named CSV files; the first one that cannot be read stops the load and is named."""
    out = {}
    for name, path in paths.items():
        try:
            out[name] = read_csv(spark, path, **options)
        except AnalysisException as e:
            raise ValueError(f"dataset {name!r} cannot be read from {path}") from e
    return out


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the latest version of a warehouse, or a plain Parquet folder below the root."""
    if warehouse.is_warehouse(spark, root):
        return warehouse.read(spark, root, name)
    return spark.read.parquet(f"{root}/{name}")


def list_files(spark: SparkSession, directory: str, glob: str = "*.csv") -> DataFrame:
    """All plain files of a directory by name, empty and hidden ones included: path, bytes, MiB
    cut to two decimals, modification time and dataset name. File contents are not read."""
    found = spark.createDataFrame(listing(spark, directory, glob),
                                  "name string, path string, length long, changed long")
    return found.select(
        "name", "path", F.col("length").alias("size"),
        megabytes(F.col("length")).cast("double").alias("size_mb"),
        F.timestamp_millis("changed").alias("modified"),
        F.regexp_replace("name", r"\.csv", "").alias("collection"),
    ).orderBy("name")


def inspect_csv(spark: SparkSession, paths: list[str]) -> dict[str, dict]:
    """What each file holds, all files in one job: ``header`` (first line), ``lines`` that are not
    blank, ``multiline`` (some line has an odd number of quotes, so a value goes on in the
    next), and the least and greatest number of fields in a line (``low``, ``high``).

    The number of fields means something only in a file that is not multi-line.
    """
    if not paths:
        return {}
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(line, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = (spark.read.text(paths).select("*", F.col("_metadata.file_path").alias("path"), place.alias("place"))
            .where(F.length(F.rtrim("value")) > 0)
            .groupBy("path").agg(
                F.min_by("value", "place").alias("header"), F.count("*").alias("lines"),
                F.max(quotes % 2).alias("odd"), F.min(fields).alias("low"), F.max(fields).alias("high")).collect())
    return {unquote(urlparse(r["path"]).path): {
        "header": r["header"], "lines": r["lines"], "multiline": r["odd"] == 1, "low": r["low"], "high": r["high"]}
        for r in rows}


def _misfit(names: list[str], found: dict) -> str | None:
    if found["low"] == found["high"] == len(names):
        return None
    return f"the header has {len(names)} fields, its records have from {found['low']} to {found['high']}"


def least_split(spark: SparkSession) -> int:
    """Files of so many bytes are never split."""
    size = spark._jsparkSession.sessionState().conf()
    return min(size.filesOpenCostInBytes(), size.filesMaxPartitionBytes())


def load_directory(spark: SparkSession, directory: str, infer: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every CSV file of a directory as a dataset of text columns, named by file.

    Returns the datasets and a report with one row per file: loaded, empty (skipped), or failed
    with the reason, which may be that records have another number of fields than the header.
    The files are inspected together: one job over their lines and, for all files whose values hold
    line breaks, two more over their splits and records. All files are then read in splits, for which
    each large one with line breaks is looked at once more, several at a time. With ``infer`` the columns get the types
    that their values allow (``inference``), found for all files together in one more job. File
    names and one line of findings per file come to the driver, and one row per split of files
    with line breaks. Hidden files (names with ``.`` or ``_`` in front) hold no datasets: Spark does
    not read them, and the report says so.
    """
    listed = list_files(spark, directory).select("name", "path", "size", "collection").collect()
    place = {f["path"]: unquote(urlparse(f["path"]).path) for f in listed}
    sizes = {f["path"]: f["size"] for f in listed}
    uncut = least_split(spark)
    visible = [f["path"] for f in listed if f["size"] and f["name"][0] not in "._"]
    found = inspect_csv(spark, visible)
    several = [p for p in visible if place[p] in found and found[place[p]]["multiline"]]
    ends, seen = None, {}
    if several:
        ends = quoted.splits(spark, several)
        seen = quoted.inspect(ends, quoted.records(spark, several, ends))

    def read(path: str) -> tuple[DataFrame | None, str | None]:
        """The file as text columns, or why not; neither if it has no records."""
        own = found.get(place[path])
        if own is None:
            return None, None
        if not own["multiline"]:
            names = quoted.header_names(own["header"].rstrip("\r"))
            wrong = None if own["lines"] < 2 else _misfit(names, own)
            return (None if wrong or own["lines"] < 2 else read_csv(spark, path, infer=False)), wrong
        own = seen[place[path]]
        names = quoted.header_names(own["header"])
        wrong = _misfit(names, own) if own["records"] else None
        if wrong or not own["records"]:
            return None, wrong
        # Spark cuts a file otherwise when it reads it alone, unless it doesn't cut it at all
        alone = quoted.unsplit(path) if sizes[path] <= uncut else quoted.splits(spark, [path])
        return quoted.parsed(quoted.records(spark, path, alone), names), None

    def attempt(f) -> tuple[DataFrame | None, str | None]:
        try:
            return (None, "hidden") if f["name"][0] in "._" else read(f["path"])
        except Exception as e:  # a bad file must not stop the others
            return None, str(e).split("\n")[0]

    loaded, report = {}, []
    for f, (df, reason) in zip(listed, together(spark, attempt, listed)):
        if df is not None:
            loaded[f["path"]] = df
        report.append((f["name"], "loaded" if df is not None else "failed" if reason else "empty", reason))
    if infer and loaded:
        # all files with line breaks are read, as their splits are known for them together
        plain = [p for p in loaded if p not in several]
        counts = inference.class_counts(spark, plain, several, ends, max(len(df.columns) for df in loaded.values()))
        kinds: dict[str, dict[int, str]] = {}
        for r in inference.types(counts, "path", "position").collect():
            kinds.setdefault(unquote(urlparse(r["path"]).path), {})[r["position"]] = r["type"]
        loaded = {p: inference.typed(df, [kinds[place[p]][i] for i in range(len(df.columns))])
                  for p, df in loaded.items()}
    collection = {f["path"]: f["collection"] for f in listed}
    return ({collection[p]: df for p, df in loaded.items()},
            spark.createDataFrame(report, "name string, status string, error string"))


def column_types(spark: SparkSession, directory: str, glob: str = "*.csv") -> DataFrame:
    """Per file and column (``name``, ``position`` from 0, ``column``): how many values there are of each
    class of ``inference.CLASSES``, all files in one job after the two that ``load_directory`` inspects them
    with. Kept beside the data, the counts of earlier files need not be taken again."""
    listed = list_files(spark, directory, glob).where(
        "size > 0 AND NOT startswith(name, '.') AND NOT startswith(name, '_')").select("name", "path").collect()
    place = {f["path"]: unquote(urlparse(f["path"]).path) for f in listed}
    found = inspect_csv(spark, [f["path"] for f in listed])
    found = {p: found[x] for p, x in place.items() if x in found}
    several = [p for p, own in found.items() if own["multiline"]]
    headers = {p: own["header"].rstrip("\r") for p, own in found.items()}
    ends = None
    if several:
        ends = quoted.splits(spark, several)
        seen = quoted.inspect(ends, quoted.records(spark, several, ends))
        headers |= {p: seen[place[p]]["header"] for p in several}
    columns = {p: quoted.header_names(h) for p, h in headers.items()}
    names = spark.createDataFrame(
        [(place[f["path"]], f["name"], i, c) for f in listed for i, c in enumerate(columns.get(f["path"], []))],
        "place string, name string, position int, column string")
    if not columns:
        return names.select("name", "position", "column", *[F.lit(0).cast("long").alias(c) for c in inference.CLASSES])
    counts = inference.class_counts(spark, [p for p in columns if p not in several], several, ends,
                                    max(map(len, columns.values())))
    at = F.url_decode(F.replace(F.regexp_replace("path", "^[a-zA-Z0-9]+:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))
    return names.join(counts.withColumn("place", at).drop("path"), ["place", "position"]).select(
        "name", "position", "column", *[f"`{c}`" for c in inference.CLASSES])


def manifest_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each loaded dataset."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(n).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"))
        for n, df in tables.items()])
