"""Where intermediate tables of a job may be written."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: So many bytes of rows go to a Python worker at a time, about; a longer row goes alone.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Folders that this process had tables written to, for ``clean_up``.
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a session known to run in one process (``local`` or ``local[…]``) gets a folder of its
    own without that setting; anywhere else a machine-local folder may be invisible to the
    executors, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", None) or ""):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="starmart-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing folder below the shared root."""
    return f"{scratch_root(spark)}/{name}-{uuid4().hex}"


def materialise(df, name: str):
    """Write an expensive frame once to the shared folder and go on from the written table.

    Later steps then scan just the columns they need instead of repeating the work, and a
    lost executor costs a re-read, not a re-run.
    """
    path = scratch_dir(df.sparkSession, name)
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch of rows for Python in this session, unless it has a bound.

    Spark's own bounds are 10,000 rows and many megabytes, however long the rows. An executor holds each
    batch several times over: in Arrow's buffers, and two of them in the worker. For operators whose rows
    hold whole texts or what is made of these.
    """
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def together(spark: SparkSession, work: Callable, items: Iterable, at_once: int = 8) -> list:
    """What ``work`` returns for each item, in their order, the Spark jobs of several items at a time.

    Many small jobs one after another leave most cores idle. An error in one item is raised, and
    those not begun yet are left out.
    """
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def clean_up(spark: SparkSession) -> int:
    """Delete the tables that ``materialise`` has written so far, and say how many there were.

    Frames that still read them no longer work, so this comes at the end of a job.
    """
    from starmart.sources.filesystem import delete

    gone = 0
    while _written:
        gone += delete(spark, _written.pop())
    return gone
