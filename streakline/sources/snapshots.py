"""Dated snapshots and versioned tables on a shared file system.

A version is a folder ``version=<number>_<stamp>_<attempt>``. Numbers grow over all writers
of a table, whatever their stamps look like, and every attempt has a folder of its own, so
nothing finished is ever written over. A version counts once its ``_SUCCESS`` marker is
there; readers see the last whole one while the next is written. Of several versions with one
stamp, as a retried job leaves them, the last counts. A job asks for the version ``before``
its own stamp, so a retry starts from where the first attempt did. The version before the last
serves as the archive; nothing is copied for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.operators.merge import status_columns
from streakline.session import write_packed
from streakline.sources.paths import delete, exists, glob

#: What was extracted, what a feed brought, and what of a feed was applied.
MODES = ("full", "update", "applied")


class NoSnapshot(FileNotFoundError):
    """No finished snapshot where one is needed."""


def _mode_dir(root: str, mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    return f"{root}/{mode}"


def _number(path: str) -> int:
    return int(path.rsplit("version=", 1)[1].split("_", 1)[0])


def stamp_of(path: str) -> str:
    return path.rsplit("version=", 1)[1].split("_", 1)[1].rsplit("_", 1)[0]


def versions(spark: SparkSession, folder: str, before: str | None = None) -> list[str]:
    """Finished versions below ``folder``, oldest first, the last of each stamp; not those of stamp ``before``."""
    found = [p.rsplit("/", 1)[0] for p in glob(spark, f"{folder}/version=*/_SUCCESS")]
    last = {stamp_of(p): p for p in sorted(found, key=_number)}
    return sorted((p for s, p in last.items() if s != before), key=_number)


def has_version(spark: SparkSession, folder: str, before: str | None = None) -> bool:
    return bool(versions(spark, folder, before))


def new_path(spark: SparkSession, folder: str, stamp: str) -> str:
    """A path above all others, finished or not."""
    taken = [_number(p) for p in glob(spark, f"{folder}/version=*")]
    return f"{folder}/version={max(taken, default=0) + 1:012d}_{stamp}_{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, folder: str, stamp: str) -> DataFrame:
    """Write ``df`` as a new version and return it as read back."""
    path = new_path(df.sparkSession, folder, stamp)
    write_packed(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_version(spark: SparkSession, folder: str, back: int = 0, before: str | None = None) -> DataFrame:
    """The last finished version, or the one ``back`` before it; with ``before``, not one of that stamp."""
    found = versions(spark, folder, before)
    if len(found) <= back:
        raise NoSnapshot(f"no finished version below {folder}")
    return spark.read.parquet(found[-1 - back])


def remove_old_versions(spark: SparkSession, folder: str, keep: int = 30) -> int:
    """Delete all but the last ``keep`` finished versions; returns how many went.

    Unfinished folders older than those go too. Readers of a deleted version fail, so keep
    as many as are written while the longest reader runs.
    """
    found = versions(spark, folder)
    if len(found) <= keep:
        return 0
    oldest = _number(found[-keep])
    old = [p for p in glob(spark, f"{folder}/version=*") if _number(p) < oldest]
    for path in old:
        delete(spark, path)
    return len(old)


def write_snapshot(df: DataFrame, root: str, mode: str, stamp: str) -> DataFrame:
    """A dated Parquet and CSV snapshot; the CSV is written from the Parquet, not computed again, and gzipped."""
    folder = _mode_dir(root, mode)
    stored = write_version(df, f"{folder}/parquet", stamp)
    stored.write.option("header", True).option("compression", "gzip").csv(new_path(df.sparkSession, f"{folder}/csv", stamp))
    return stored


def snapshot_stamp(spark: SparkSession, root: str, mode: str, before: str | None = None) -> str | None:
    """The stamp of the last snapshot."""
    found = versions(spark, f"{_mode_dir(root, mode)}/parquet", before)
    return stamp_of(found[-1]) if found else None


def latest_snapshot(spark: SparkSession, root: str, mode: str, before: str | None = None) -> DataFrame:
    return read_version(spark, f"{_mode_dir(root, mode)}/parquet", before=before)


def read_csv_snapshot(spark: SparkSession, root: str, mode: str, schema) -> DataFrame:
    found = versions(spark, f"{_mode_dir(root, mode)}/csv")
    if not found:
        raise NoSnapshot(f"no finished version below {root}/{mode}")
    return spark.read.schema(schema).option("header", True).csv(found[-1])


def scan_status_columns(spark: SparkSession, path: str) -> DataFrame:
    """Only id, status and kickoff are read from the file."""
    return status_columns(spark.read.parquet(path))


def scan_by_ids(spark: SparkSession, path: str, ids: DataFrame | Sequence[int]) -> DataFrame:
    """Rows of a Parquet file for the given ids.

    A Python list becomes an ``IN`` filter that reaches the Parquet reader; a
    frame of ids stays distributed and becomes a semi-join.
    """
    rows = spark.read.parquet(path)
    if isinstance(ids, DataFrame):
        return rows.join(ids, "api_fixture_id", "left_semi")
    return rows.where(F.col("api_fixture_id").isin(*ids))


def full_refresh(spark: SparkSession, parquet_path: str, folder: str, stamp: str) -> DataFrame:
    """Replace a table by the rows of a Parquet file; the rows it had become the archive."""
    if not exists(spark, parquet_path):
        raise FileNotFoundError(f"nothing to load at {parquet_path}")
    return write_version(spark.read.parquet(parquet_path), folder, stamp)


def archived(spark: SparkSession, folder: str) -> DataFrame:
    """The table as it was before the last refresh."""
    return read_version(spark, folder, back=1)
