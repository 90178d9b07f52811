"""Folders that tables are written to, wherever the session's file systems keep them."""

from __future__ import annotations

from pyspark.sql import SparkSession

DONE = "_SUCCESS"


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, where = _at(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote this table has ended well."""
    files, where = _at(spark, f"{path}/{DONE}")
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table's folder; nothing happens if it is not there."""
    files, where = _at(spark, path)
    files.delete(where, True)
