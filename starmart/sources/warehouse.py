"""Tables that change together.

A warehouse folder has the data of every run in a folder of its own, ``data/<run>/<table>``, which
is never changed once written, and in ``_commits`` one small file per version that names the folder
of every table. A version comes into being by putting its file there, in one step and only if no
other run has done so. So a reader sees all tables of one version or all of another, whatever
fails in between, and readers of an old version go on reading it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmart.sources import filesystem

COMMITS, DATA = "_commits", "data"


class Conflict(RuntimeError):
    """Another run has committed since this one looked."""


@dataclass(frozen=True)
class Stored:
    """Where the rows of a table are, below the root: folders, and the columns to read there."""
    paths: list[str]
    schema: str
    notes: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        if not self.paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in self.paths])


@dataclass(frozen=True)
class Snapshot:
    version: int
    tables: dict[str, Stored]


def is_warehouse(spark: SparkSession, root: str) -> bool:
    return filesystem.exists(spark, f"{root}/{COMMITS}")


def _versions(spark: SparkSession, root: str) -> list[int]:
    found = [n.removesuffix(".json") for n in filesystem.names(spark, f"{root}/{COMMITS}")]
    return sorted(int(n) for n in found if n.isdigit())


def _manifest(root: str, version: int) -> str:
    return f"{root}/{COMMITS}/{version:012d}.json"


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The tables of a version, the latest unless one is named; none in a new warehouse."""
    if version is None:
        version = max(_versions(spark, root), default=0)
    if version == 0:
        return Snapshot(0, {})
    found = json.loads(filesystem.read_text(spark, _manifest(root, version)))
    return Snapshot(version, {n: Stored(**t) for n, t in found["tables"].items()})


def new_run() -> str:
    return f"{DATA}/{uuid4().hex}"


def commit(spark: SparkSession, root: str, tables: dict[str, Stored], base: int | None = None) -> int:
    """Make the next version, in which these tables are as given and all others as they were.

    With ``base`` the tables were derived from that version, so another run's version in between is
    a ``Conflict``; without it they replace whatever is there, and the commit is tried again on top.
    """
    while True:
        now = snapshot(spark, root)
        if base is not None and now.version != base:
            raise Conflict(f"version {now.version} was committed after {base}")
        whole = {n: asdict(t) for n, t in {**now.tables, **tables}.items()}
        if filesystem.put_if_absent(spark, _manifest(root, now.version + 1), json.dumps({"tables": whole})):
            return now.version + 1


def in_one_run(spark: SparkSession, root: str, write: Callable[[str], dict[str, Stored]],
               base: int | None = None) -> int:
    """Let ``write`` store tables below the folder of a new run, and commit what it returns. If any
    of it fails, the run's folder is deleted and nothing has changed."""
    run = new_run()
    try:
        return commit(spark, root, write(run), base)
    except BaseException:
        filesystem.delete(spark, f"{root}/{run}")
        raise


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    tables = snapshot(spark, root, version).tables
    if name not in tables:
        raise KeyError(f"no table {name!r} in {root}")
    return tables[name].read(spark, root)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete versions but for the last ``keep``, and folders that only those name. How many folders
    went. Runs that have not committed yet are left alone."""
    versions = _versions(spark, root)
    old, last = versions[:-keep], versions[-keep:]

    def paths(of: list[int]) -> set[str]:
        return {p for v in of for t in snapshot(spark, root, v).tables.values() for p in t.paths}
    gone = paths(old) - paths(last)
    for path in gone:
        filesystem.delete(spark, f"{root}/{path}")
    for v in old:
        filesystem.delete(spark, _manifest(root, v))
    return len(gone)
