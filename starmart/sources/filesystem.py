"""Folders through the cluster's own file-system layer: listing, deleting, replacing."""

from __future__ import annotations

from fnmatch import fnmatchcase
from uuid import uuid4

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def listing(spark: SparkSession, directory: str, glob: str) -> list[tuple[str, str, int, int]]:
    """Plain files directly in a folder: name, path, bytes, time of change in milliseconds.

    Empty and hidden files are listed like any other; the contents are not read.
    """
    fs, where = _at(spark, directory)
    return [(f.getPath().getName(), f.getPath().toString(), f.getLen(), f.getModificationTime())
            for f in fs.listStatus(where) if f.isFile() and fnmatchcase(f.getPath().getName(), glob)]


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; whether there was one."""
    fs, where = _at(spark, path)
    return bool(fs.delete(where, True))


def replace(spark: SparkSession, staged: str, final: str) -> None:
    """Put a complete folder in the place of another, which is deleted only afterwards."""
    fs, new = _at(spark, staged)
    _, place = _at(spark, final)
    old = None
    if fs.exists(place):
        _, old = _at(spark, f"{final}-old-{uuid4().hex}")
        if not fs.rename(place, old):
            raise OSError(f"{final} cannot be moved aside")
    if not fs.rename(new, place):
        if old is not None:
            fs.rename(old, place)
        raise OSError(f"{staged} cannot be put in the place of {final}")
    if old is not None:
        fs.delete(old, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return bool(fs.exists(where))


def names(spark: SparkSession, directory: str) -> list[str]:
    """What is in a folder; nothing if there is no such folder."""
    fs, where = _at(spark, directory)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, complete or not at all; whether there was none of that name.

    It is written beside its place and renamed. A rename that does not overwrite is one step in
    distributed file systems; a local folder looks first and renames then.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, place = _at(spark, path)
    _, draft = _at(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plainly = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(place), plainly)
        return True
    except Exception:
        if fs.exists(place):
            return False
        raise
    finally:
        fs.delete(draft, False)
