"""Fixture files: a country/league/season tree, a single update file, nested payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streakline.functions.scalars import slugify
from streakline.schemas import FLAT_FIXTURE_TEXT, METADATA_DDL, PAYLOAD_DDL, TEAM_PAYLOAD_DDL
from streakline.sources.paths import exists

_CORRUPT = "_corrupt_record"
TREE_LEVELS = ["country_slug", "league_slug", "season"]


def _parsed():
    """True for records that parsed.

    Spark refuses to read the corrupt-record column alone, as a bare count would;
    the second condition always holds and brings one real column along.
    """
    return F.col(_CORRUPT).isNull() & (F.length(F.coalesce("api_fixture_id", F.lit(""))) >= 0)


def _read_flat(spark: SparkSession, path: str, multi_line: bool, pattern: str | None = None) -> DataFrame:
    schema = T.StructType([*FLAT_FIXTURE_TEXT.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT)
    if multi_line:
        reader = reader.option("multiLine", True)
    if pattern:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.json(path)


def scan_fixture_tree(
    spark: SparkSession, base: str, pattern: str = "fixtures.json", multi_line: bool = True
) -> DataFrame:
    """All fixture files below ``base``; ``season`` is the name of the file's folder.

    Files that do not parse are left out; without any file the frame is empty.
    Array files (``multi_line``) are one task each; trees written by
    ``write_fixture_tree`` hold one record per line and can be split.
    """
    if not exists(spark, base):
        return spark.createDataFrame([], FLAT_FIXTURE_TEXT)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return (
        _read_flat(spark, base, multi_line, pattern)
        .withColumn("season", F.regexp_replace(folder, "^season=", ""))
        .where(_parsed())
        .drop(_CORRUPT)
    )


def unreadable_files(
    spark: SparkSession, base: str, pattern: str = "fixtures.json", multi_line: bool = True
) -> DataFrame:
    """The files ``scan_fixture_tree`` leaves records out of."""
    return (
        _read_flat(spark, base, multi_line, pattern)
        .select("api_fixture_id", _CORRUPT, F.col("_metadata.file_path").alias("path"))
        .where(~_parsed())
        .select("path")
        .distinct()
    )


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Record lines of the given files; what cannot be parsed is left out."""
    return _read_flat(spark, list(paths), False).where(_parsed()).drop(_CORRUPT)


def scan_update_file(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One array file (or a folder of record lines); empty if missing or unreadable."""
    if not exists(spark, path):
        return spark.createDataFrame([], FLAT_FIXTURE_TEXT)
    return (
        _read_flat(spark, path, multi_line)
        .where(_parsed())
        .drop(_CORRUPT)
    )


def _season_folders(spark: SparkSession, base: str, season: T.DataType) -> DataFrame:
    """The season folders that hold files, taken from the files' paths in Spark; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if not exists(spark, base):
        return spark.createDataFrame([], "country_slug string, league_slug string, season string")
    parts = F.split("path", "/")
    levels = [F.regexp_replace(F.element_at(parts, at - 4), f"^{name}=", "").alias(name) for at, name in enumerate(TREE_LEVELS)]
    found = files.load(base).select(*levels).distinct()
    return found.withColumn("season", F.col("season").cast(season))


def write_fixture_tree(df: DataFrame, base: str, overwrite: bool = True) -> None:
    """Fixtures as JSON lines below country/league/season folders.

    ``df`` has ``country``, ``league_name`` and ``season`` besides the record.
    Folders present in ``df`` are replaced, or left as they are with
    ``overwrite=False``; others are not touched. The rebalance hint gathers each
    folder's rows into few files and splits a folder that is too big for one.
    """
    rows = df.withColumns({"country_slug": slugify(F.col("country")), "league_slug": slugify(F.col("league_name"))})
    if not overwrite:
        rows = rows.join(_season_folders(df.sparkSession, base, df.schema["season"].dataType), TREE_LEVELS, "left_anti")
    (
        rows.drop("country", "league_name")
        .hint("rebalance", *TREE_LEVELS)
        .write.mode("overwrite" if overwrite else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*TREE_LEVELS)
        .json(base)
    )


def write_records(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Records as JSON lines; published only when all tasks are done. ``gzip`` makes about a tenth of them."""
    df.write.mode(mode).option("compression", compression).json(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYLOAD_DDL).json(path)


def read_metadata(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(METADATA_DDL).option("multiLine", multi_line).json(path)


def read_team_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TEAM_PAYLOAD_DDL).json(path)
