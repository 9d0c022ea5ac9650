"""Paths as Spark resolves them: against the default file system of the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, where


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, the same on the driver and all executors."""
    files, where = _located(spark, path)
    return files.makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _located(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Directories directly below a directory, by name."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().toString() for s in files.listStatus(where) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    files, where = _located(spark, path)
    files.delete(where, True)
