"""Jobs that fill a warehouse: the metadata tree into dimensions, first fixtures of new seasons.

Surrogate keys are resolved by joins on natural keys, level by level: each dimension is
stored before the next one looks its ids up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.operators import clean, dims, merge
from streakline.plans import jobs, worklists
from streakline.schemas import MIN_SEASON, REQUIRED_COLUMNS
from streakline.session import stage
from streakline.sources import fixture_files
from streakline.sources.snapshots import has_version, write_version
from streakline.sources.tables import source_path, source_table

# The columns of the stored dimensions.
DIMENSIONS = {
    "etl.dim_countries": "country_id bigint, country_name string, created_at timestamp_ntz",
    "etl.dim_leagues": "league_id bigint, api_league_id bigint, league_name string, country_id bigint, "
    "created_at timestamp_ntz, updated_at timestamp_ntz",
    "etl.dim_league_seasons": "league_season_id bigint, league_id bigint, season int, season_label string, start_date date, "
    "end_date date, fixtures_bootstrap_done boolean, fixtures_bootstrap_at timestamp_ntz, updated_at timestamp_ntz",
    "etl.dim_teams": "team_id bigint, api_team_id bigint, team_name string, team_code string, country_id bigint, "
    "created_at timestamp_ntz, updated_at timestamp_ntz",
}


def stored_dimension(spark: SparkSession, root: str, name: str, stamp: str) -> DataFrame:
    """The dimension as it was before this run; empty if there is none."""
    if has_version(spark, source_path(root, name), before=stamp):
        return source_table(spark, root, name, before=stamp)
    return spark.createDataFrame([], DIMENSIONS[name])


def metadata_load_job(
    spark: SparkSession, tree: DataFrame, root: str, stamp: str, now=None, min_season: int = MIN_SEASON
) -> dict[str, DataFrame]:
    """Countries, leagues, seasons and teams of the tree merged into the stored dimensions.

    Requested leagues that the catalog lacks go to ``reports/missing_leagues``. Returns the
    dimensions as stored.
    """
    tree = stage(tree)
    old = lambda name: stored_dimension(spark, root, name, stamp)
    keep = lambda name, df: write_version(df, source_path(root, name), stamp)
    out = {}

    merged = merge.insert_or_ignore(old("etl.dim_countries"), dims.flatten_countries(tree), ["country_name"], "country_id", now)
    out["etl.dim_countries"] = countries = keep("etl.dim_countries", merged)
    of_country = countries.select("country_id", "country_name")

    found = dims.flatten_leagues(tree).join(of_country, "country_name").drop("country_name")
    merged = merge.conditional_upsert(
        old("etl.dim_leagues"), found, ["api_league_id"], "league_id", ["league_name", "country_id"], now=now,
        order=["country_id", "league_name"],
    )
    out["etl.dim_leagues"] = leagues = keep("etl.dim_leagues", merged)

    found = dims.flatten_seasons(tree, min_season).join(leagues.select("league_id", "api_league_id"), "api_league_id")
    tracked = ["season_label", "start_date", "end_date"]
    merged = merge.conditional_upsert(
        old("etl.dim_league_seasons"), found.drop("api_league_id"), ["league_id", "season"], "league_season_id", tracked, now=now,
        order=["start_date", "end_date"],
    )
    merged = merged.withColumn("fixtures_bootstrap_done", F.coalesce("fixtures_bootstrap_done", F.lit(False)))
    out["etl.dim_league_seasons"] = keep("etl.dim_league_seasons", merged)

    found = dims.flatten_teams(tree, min_season).join(of_country, "country_name").drop("country_name")
    merged = merge.conditional_upsert(
        old("etl.dim_teams"), found, ["api_team_id"], "team_id", ["team_name", "team_code", "country_id"], now=now,
        order=["country_id", "team_name"],
    )
    out["etl.dim_teams"] = keep("etl.dim_teams", merged)
    write_version(dims.missing_leagues(tree), f"{root}/reports/missing_leagues", stamp)
    return out


def bootstrap_job(spark: SparkSession, payloads: DataFrame, root: str, stamp: str, now=None) -> int:
    """Payloads fetched for the bootstrap list to the raw table; returns how many fixtures it holds.

    Records are flattened, kept if their season is on the list, written to the fixture tree,
    and the tree is scanned, transformed and loaded. Seasons with fixtures are marked done.
    Rejected payloads and unreadable files are stored as reports.
    """
    source = lambda name: stored_dimension(spark, root, name, stamp)
    seasons = source("etl.dim_league_seasons")
    wanted = stage(worklists.bootstrap_worklist(seasons, source("etl.dim_leagues"), source("etl.dim_countries")))
    good, rejected = clean.split_payloads(payloads)
    write_version(rejected, f"{root}/reports/rejected_payloads", stamp)
    listed = wanted.select(
        F.col("country_name").alias("country"), "league_name", "api_league_id", F.col("season_year").alias("season"), "league_season_id"
    )
    fetched = stage(clean.flatten_payload(good).join(listed, ["api_league_id", "season"]))
    tree = f"{root}/fixtures"
    fixture_files.write_fixture_tree(fetched.select("country", "league_name", *REQUIRED_COLUMNS), tree)
    write_version(fixture_files.unreadable_files(spark, tree, "*.json", multi_line=False), f"{root}/reports/unreadable_files", stamp)
    jobs.transform_job(fixture_files.scan_fixture_tree(spark, tree, "*.json", multi_line=False), root, "full", stamp)
    loaded = jobs.load_raw(spark, root, stamp, now).count()
    done = merge.mark_bootstrap_done(seasons, fetched.select("league_season_id"), now)
    write_version(done, source_path(root, "etl.dim_league_seasons"), stamp)
    return loaded
