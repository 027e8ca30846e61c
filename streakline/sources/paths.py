"""Path tests through the Hadoop file system, so any store Spark can reach works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match, in name order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(glob(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder and all below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
