"""Folders, through the file system that Spark uses for them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    files, where = _place(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete ``path`` with all below it."""
    files, where = _place(spark, path)
    files.delete(where, True)
