"""Named source tables and the ways a model can be materialised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from streakline.operators.merge import incremental_append, replace_by_key, replace_model, rows_after
from streakline.operators.quality import Check, counted_write
from streakline.session import stage
from streakline.sources.buckets import has_map, read_map, update_buckets, write_buckets
from streakline.sources.snapshots import has_version, read_version, stamp_of, versions, write_version

# Where each declared source lives below the warehouse root.
SOURCES = {
    "raw.raw_fixtures": "raw/raw_fixtures",
    "raw.raw_fixtures_v1": "raw/raw_fixtures_v1",
    "etl.dim_countries": "dim/dim_countries",
    "etl.dim_leagues": "dim/dim_leagues",
    "etl.dim_league_seasons": "dim/dim_league_seasons",
    "etl.dim_teams": "dim/dim_teams",
}


def source_path(root: str, name: str) -> str:
    if name not in SOURCES:
        raise KeyError(f"unknown source: {name}")
    return f"{root}/{SOURCES[name]}"


def source_table(spark: SparkSession, root: str, name: str, before: str | None = None) -> DataFrame:
    return read_version(spark, source_path(root, name), before=before)


def materialize(
    df: DataFrame,
    how: str,
    name: str,
    root: str | None = None,
    stamp: str | None = None,
    keys: Sequence[str] = (),
    mark: str | None = None,
    checks: Sequence[Check] = (),
) -> DataFrame:
    """Keep a model as a ``view``, a ``table``, an ``incremental`` table or one in ``buckets``.

    Incremental: rows of ``df`` (only those above the high-water mark of column
    ``mark``, if given) replace the stored rows with the same keys. ``buckets`` does so too, but
    rewrites only the buckets that these rows fall into. The row-wise ones of
    ``checks`` are counted by the write and stored with its stamp (see ``counted_checks``).
    """
    spark = df.sparkSession
    if how == "view":
        view = name.replace("/", "_")
        df.createOrReplaceTempView(view)
        return spark.table(view)
    folder = f"{root}/{name}"
    if how == "table":
        return _checked(df, folder, root, stamp, checks)
    if how == "buckets":
        return _in_buckets(df, folder, stamp, keys, mark)
    if how != "incremental":
        raise ValueError(f"unknown materialisation: {how}")
    # A retry starts from the version before its own stamp, as the first attempt did.
    if has_version(spark, folder, before=stamp):
        stored = read_version(spark, folder, before=stamp)
        df = incremental_append(stored, df, keys, mark) if mark else replace_model(stored, df, keys)
    return _checked(df, folder, root, stamp, checks)


def _in_buckets(df: DataFrame, folder: str, stamp: str, keys: Sequence[str], mark: str | None) -> DataFrame:
    spark = df.sparkSession
    if not has_map(spark, folder, before=stamp):
        return write_buckets(df, folder, keys, stamp).read(spark)
    # Of the stored rows only the mark's column is read whole.
    stored = read_map(spark, folder, before=stamp).read(spark)
    feed = stage(rows_after(df, stored, mark) if mark else df)
    return update_buckets(feed, folder, stamp, lambda old, new: replace_by_key(old, new, keys)).read(spark)


COUNTS_DDL = "`table` string, `column` string, `check` string, failing bigint"


def _checked(df: DataFrame, folder: str, root: str, stamp: str, checks: Sequence[Check]) -> DataFrame:
    stored, counts = counted_write(df, checks, lambda rows: write_version(rows, folder, stamp))
    if counts:
        rows = [(c.table, c.column, c.kind, n) for c, n in counts.items()]
        found = df.sparkSession.createDataFrame(rows, COUNTS_DDL).coalesce(1)
        write_version(found, f"{root}/reports/row_checks/{rows[0][0]}", stamp)
    return stored


def counted_checks(spark: SparkSession, root: str, stamp: str, checks: Sequence[Check]) -> dict[Check, int]:
    """What writes of this stamp counted for ``checks``."""
    found: dict[tuple, int] = {}
    for table in dict.fromkeys(c.table for c in checks):
        folder = f"{root}/reports/row_checks/{table}"
        done = versions(spark, folder)
        if done and stamp_of(done[-1]) == stamp:
            found |= {(r["table"], r["column"], r["check"]): r["failing"] for r in spark.read.parquet(done[-1]).collect()}
    return {c: found[c[:3]] for c in checks if c[:3] in found}
