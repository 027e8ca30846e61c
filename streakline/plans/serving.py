"""Stored streaks laid out for reads by type, by team and page by page.

The table is partitioned by ``streak_type`` and clustered by team name within, with Parquet Bloom
filters on it: a read by type opens one folder, a read by team skips the row groups that cannot
hold it. Pages go by key, not by offset: each starts after the last row of the one before, so
a page costs the same wherever it lies, and rows that come or go elsewhere do not shift it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from streakline.sources.snapshots import new_path, read_version

#: Longest first, then by name, then by id: the order of the ranked list.
PAGE_ORDER = ["current_streak_length", "team_name", "streak_id"]


def write_served(streaks: DataFrame, folder: str, stamp: str, files: int | None = None) -> DataFrame:
    """A new version of the served table."""
    spark = streaks.sparkSession
    by = ["streak_type", "team_name", "streak_id"]
    ranged = streaks.repartitionByRange(files, *by) if files else streaks.repartitionByRange(*by)
    path = new_path(spark, folder, stamp)
    (
        ranged.sortWithinPartitions(*by)
        .write.option("parquet.bloom.filter.enabled#team_name", "true")
        .option("parquet.enable.dictionary#team_name", "true")
        .partitionBy("streak_type")
        .parquet(path)
    )
    return read_version(spark, folder)


def served(spark: SparkSession, folder: str, streak_type: str | None = None, team_name: str | None = None) -> DataFrame:
    """Streaks of a type, of a team, of both, or all."""
    rows = read_version(spark, folder)
    if streak_type is not None:
        rows = rows.where(F.col("streak_type") == streak_type)
    return rows if team_name is None else rows.where(F.col("team_name") == team_name)


def _after(last: Row) -> Column:
    """Comes a row after ``last`` in ``PAGE_ORDER``? NULL names come first, as Spark sorts them."""
    length, name, id_ = (last[c] for c in PAGE_ORDER)
    later_name = F.col("team_name").isNotNull() if name is None else F.col("team_name") > name
    same_name = F.col("team_name").eqNullSafe(F.lit(name))
    tied = later_name | (same_name & (F.col("streak_id") > id_))
    return (F.col("current_streak_length") < length) | ((F.col("current_streak_length") == length) & tied)


def page(rows: DataFrame, size: int, last: Row | None = None) -> DataFrame:
    """The next ``size`` rows after ``last``, or the first ones, in ``PAGE_ORDER``; its last row asks for the next page."""
    left = rows if last is None else rows.where(_after(last))
    return left.orderBy(F.desc("current_streak_length"), "team_name", "streak_id").limit(size)
