"""Names and folders, through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern: a listing, nothing is read."""
    fs, where = _at(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(where) or []]


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
