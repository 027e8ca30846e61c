"""A ledger of files read, so that an intake reads new and changed files only.

A file is known by path, time and size, all from its listing: no content is read to find out. The
ledger is a versioned table, written after the rows it stands for are stored; an intake that
fails before that reads the same files again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.session import stage
from streakline.sources.snapshots import has_version, read_version, write_version

FILE = ["path", "modified", "size"]


def listed_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """``path, modified, size`` of the files below ``folder``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def new_files(spark: SparkSession, folder: str, ledger: str, stamp: str, pattern: str = "*.json") -> DataFrame:
    """Files that the ledger does not list as they are now; stored, so that all steps see the same ones."""
    found = listed_files(spark, folder, pattern)
    if has_version(spark, ledger, before=stamp):
        found = found.join(read_version(spark, ledger, before=stamp), FILE, "left_anti")
    return stage(found)


def intake(
    spark: SparkSession,
    folder: str,
    ledger: str,
    stamp: str,
    read: Callable[[list[str]], DataFrame],
    store: Callable[[DataFrame], object],
    pattern: str = "*.json",
) -> int:
    """``store(read(paths of new files))``, then the ledger; returns how many files were new.

    ``read`` gets all paths at once, as ``spark.read`` does. A run with the stamp of an earlier one
    starts from the ledger before it. Files that are gone stay in the ledger.
    """
    found = new_files(spark, folder, ledger, stamp, pattern)
    paths = [r["path"] for r in found.select("path").collect()]
    if not paths:
        return 0
    store(read(paths))
    known = read_version(spark, ledger, before=stamp) if has_version(spark, ledger, before=stamp) else found.limit(0)
    # A changed file replaces its older line.
    kept = known.join(found.select("path"), "path", "left_anti")
    write_version(kept.select(*FILE).unionByName(found.select(*FILE)), ledger, stamp)
    return len(paths)
