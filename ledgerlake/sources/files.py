"""Files of the shared store: listing, moving and deleting them, and the scratch tables of a piece of work."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import STAGES


def listing(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path, length, modified`` of all files below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).selectExpr("path", "length", "modificationTime as modified")


def literal(path: str) -> str:
    """``path`` for a reader, which takes paths for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_name(path: Column) -> Column:
    """A listing's name of a file from ``_metadata.file_path``, which is written as a URL: decoded, and with one slash after ``file:``."""
    return plain(F.url_decode(F.regexp_replace(path, r"\+", "%2B")))  # a plus is a plus there


def plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files and folders with all they hold; what is not there is no error."""
    for path in paths:
        store, where = _store(spark, path)
        store.delete(where, True)


def children(spark: SparkSession, folder: str) -> list[str]:
    store, where = _store(spark, folder)
    return sorted(s.getPath().toString() for s in store.listStatus(where)) if store.exists(where) else []


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file; one that is already at its new place stays."""
    store, where = _store(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if store.exists(where):
        store.mkdirs(target.getParent())
        if not store.rename(where, target):
            raise OSError(f"cannot move {path} to {to}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the staged tables that are written inside the block when it ends. Frames that read them end with it."""
    known = set(STAGES)
    try:
        yield
    finally:
        made = [p for p in STAGES if p not in known]
        delete(spark, made)
        STAGES[:] = [p for p in STAGES if p in known]
