"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from streakline.sources.paths import delete

# Let Spark size and split what it can at run time. Partition counts are left to
# the cluster; adaptive execution merges small ones and splits skewed join sides.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "streakline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session whose executors share the driver's machine may go without one; it
    gets a temporary folder, once per session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|-cluster|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="streakline-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


#: Scratch paths given out within the open ``scratch_scope`` blocks, innermost last.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    path = f"{shared_dir(spark)}/streakline/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch tables made within the block are deleted after it.

    What is needed longer has to be stored elsewhere, or its path taken off the list that the block
    gets. Frames that read a deleted table fail, so nothing lazy may leave the block. If the
    block fails its tables stay, for a look at them.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.pop()
    for path in made:
        delete(spark, path)


#: Spark deletes the shuffle files of a query when it ends, not when the driver's memory is next collected.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Writes within the block leave no shuffle files behind; what is written is not shuffled again."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def write_packed(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """``df`` as Parquet packed by zstd, which takes less room than Spark's default, and no shuffle files beside it."""
    with shuffles_go(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").partitionBy(*by).parquet(path)


def stage(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Compute ``df`` once and cut its lineage.

    The rows are written as Parquet to the shared folder, so they outlive
    executors, every later reader sees the same ones, and counting them reads
    file footers only. ``by`` names columns to lay them out by, a folder per value; these come last.
    """
    return stage_at(df, scratch_path(df.sparkSession, "stage"), by)


def stage_at(df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    spark = df.sparkSession
    write_packed(df, path, by)
    return spark.read.schema(df.schema).parquet(path)


def _steps(df: DataFrame) -> list[tuple[str, str]]:
    """Name and text of each step of the plan."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [(re.match(r"[\s:+|-]*(\w*)", line).group(1), line) for line in lines]


def is_scan(df: DataFrame) -> bool:
    """Is ``df`` no more than a selection of stored rows, as cheap to read again as a copy of it?"""
    return {name for name, _ in _steps(df)} <= {"Project", "Filter", "Relation"}


def is_unshuffled(df: DataFrame) -> bool:
    """Does ``df`` come from stored rows row by row: a scan, but for lists taken apart, unions, and joins with a side
    that is said to be broadcast? Its rows lie as they are stored, and to read them again moves nothing."""
    steps = _steps(df)
    joined = all("strategy=broadcast" in line for name, line in steps if name == "Join")
    return joined and {name for name, _ in steps} <= {"Project", "Filter", "Relation", "Generate", "Union", "Join"}


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if its rows come unshuffled from stored ones, else staged."""
    return df if is_unshuffled(df) else stage(df)
