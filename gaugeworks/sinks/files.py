"""Files of a stored table: listing, moving and removing them by the file system of their path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Move one file. False if it is not there (any more); an existing target is left alone."""
    (p, fs), (q, _) = _path(spark, source), _path(spark, target)
    if not fs.exists(p):
        return False
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def remove(spark: SparkSession, path: str) -> bool:
    """Remove one file. False if it is not there (any more)."""
    p, fs = _path(spark, path)
    return fs.delete(p, False)
