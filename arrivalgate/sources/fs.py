"""The one place that talks to the cluster's file system (Spark has no public
API for existence checks, listing and renaming)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it does not exist."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder into place unless something is there already."""
    fs, p = _at(spark, old)
    _, q = _at(spark, new)
    if not fs.exists(q):
        fs.rename(p, q)


def make(spark: SparkSession, path: str) -> None:
    """Make a folder and its parents, if they are not there."""
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and all it holds (nothing if it does not exist)."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def status(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of everything directly under ``path``, by name."""
    fs, p = _at(spark, path)
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))
