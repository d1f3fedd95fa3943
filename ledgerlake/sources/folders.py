"""Folders of any file system that Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, hidden files aside, sorted; nothing if it is not there."""
    fs, folder = _of(spark, path)
    if not fs.exists(folder):
        return []
    found = (f.getPath().getName() for f in fs.listStatus(folder))
    return sorted(n for n in found if n[0] not in "._")


def drop(spark: SparkSession, path: str) -> None:
    fs, folder = _of(spark, path)
    fs.delete(folder, True)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as every reader understands it."""
    fs, folder = _of(spark, path)
    return fs.makeQualified(folder).toString().replace("file:/", "file:///", 1).replace("file://///", "file:///", 1)
