"""Paths of any store that Spark can open, through its own file system interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of what matches the pattern, by path; nothing for a pattern without a match."""
    p, fs = _at(spark, pattern)
    return sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.globStatus(p) or ())


def newest(spark: SparkSession, pattern: str) -> str | None:
    """The path changed last, the last by name of equal ones."""
    found = listed(spark, pattern)
    return max(found, key=lambda f: (f[2], f[0]))[0] if found else None


def make(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.delete(p, True)
