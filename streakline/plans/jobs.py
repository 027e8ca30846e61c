"""Whole jobs over a warehouse folder: transform, refresh, apply updates, build models.

Layout below the root: ``snapshots/{full,update}``, ``raw``, ``dim``, ``int``,
``mart``. Every table is written as a new version; a failed run leaves the last
whole one in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.operators import clean, dims, facts, merge, standings, streaks
from streakline.plans import marts
from streakline.plans.model_checks import MODELS, check_models, checks_of
from streakline.schemas import PLAYED_STATUS
from streakline.session import stage, stored
from streakline.sources.snapshots import (
    MODES,
    NoSnapshot,
    latest_snapshot,
    read_version,
    remove_old_versions,
    snapshot_stamp,
    write_snapshot,
    write_version,
)
from streakline.sources.tables import materialize, source_path, source_table

RAW = "raw.raw_fixtures"
#: Should a feed list a fixture twice, the finished record counts, then the later kickoff.
FINISHED_LAST = ["_finished", "kickoff_utc", "home_team_fulltime_goal", "away_team_fulltime_goal"]


#: How many versions of each table jobs leave; readers of older ones fail.
KEEP_VERSIONS = 30
KEPT_TABLES = [
    *MODELS.values(),
    "stg/stg_raw_fixtures",
    "staging/changed_fixtures",
    "reports/quality",
    "reports/blanked_values",
    *[f"snapshots/{mode}/{kind}" for mode in MODES for kind in ("parquet", "csv")],
    *[f"reports/row_checks/{model}" for model in MODELS],
]


def tidy(spark: SparkSession, root: str, keep: int = KEEP_VERSIONS) -> None:
    """Delete all but the last ``keep`` versions of what jobs write."""
    for name in KEPT_TABLES:
        remove_old_versions(spark, f"{root}/{name}", keep)


def transform_fixtures(records: DataFrame) -> DataFrame:
    """Flat records checked, typed and scored."""
    checked = clean.validate_schema(records)
    return clean.compute_results(clean.parse_kickoff(clean.cast_numeric_columns(checked)))


def transform_job(records: DataFrame, root: str, mode: str, stamp: str) -> int:
    """Transform, write the snapshot, return its row count (0, and nothing written, without records).

    Values that typing blanks are listed in ``reports/blanked_values``. The records are worked out once.
    """
    records = stored(records)
    if records.isEmpty():
        return 0
    write_version(clean.blanked_values(clean.validate_schema(records)), f"{root}/reports/blanked_values", stamp)
    return write_snapshot(transform_fixtures(records), f"{root}/snapshots", mode, stamp).count()


def load_raw(spark: SparkSession, root: str, stamp: str, now=None) -> DataFrame:
    """The latest full snapshot as the raw table; the table it replaces stays as the archive."""
    snapshot = latest_snapshot(spark, f"{root}/snapshots", "full")
    stamped = snapshot.withColumns({"created_at": merge.as_time(now), "updated_at": merge.as_time(now)})
    if "fixture_id" not in stamped.columns:
        stamped = stamped.withColumn("fixture_id", stamped["api_fixture_id"])
    return write_version(stamped, source_path(root, RAW), stamp)


def apply_played_updates(spark: SparkSession, root: str, stamp: str, now=None) -> int:
    """Bring changed fixtures of the latest update snapshot into the raw table and the snapshots.

    Returns how many update rows were applied; 0 if nothing changed, or if the feed is older
    than the full snapshot. The feed's own snapshot stays as it came.
    """
    snapshots = f"{root}/snapshots"
    fed, loaded = snapshot_stamp(spark, snapshots, "update"), snapshot_stamp(spark, snapshots, "full", before=stamp)
    if loaded is None:
        raise NoSnapshot(f"no full snapshot below {snapshots}")
    if fed is None or fed < loaded:
        return 0
    updates = latest_snapshot(spark, snapshots, "update")
    base = latest_snapshot(spark, snapshots, "full", before=stamp)
    listed = merge.only_known_ids(updates, stage(merge.changed_ids(base, updates)))
    finished = listed.withColumn("_finished", F.col("fixture_status") == PLAYED_STATUS)
    changed = merge.keep_last_per_key([finished], merge.FIXTURE_KEY, FINISHED_LAST).select(*listed.columns)
    # Written first: the count, the table and both snapshots read the same stored rows.
    applied = write_version(changed, f"{root}/staging/changed_fixtures", stamp)
    n = applied.count()
    if n == 0:
        return 0
    raw = source_table(spark, root, RAW, before=stamp)
    write_version(merge.coalesce_update(raw, applied, now=now), source_path(root, RAW), stamp)
    # Both sides hold each id once, so replacing is keep-last without regrouping the whole base.
    write_snapshot(merge.replace_by_key(base, applied, merge.FIXTURE_KEY), snapshots, "full", stamp)
    write_snapshot(applied, snapshots, "applied", stamp)
    return n


def build_models(spark: SparkSession, root: str, stamp: str, as_of=None) -> DataFrame:
    """Staging, intermediate tables and marts from the raw table and the dimensions."""
    source = lambda name: source_table(spark, root, name)
    fixtures = materialize(
        clean.stg_fixtures(source(RAW)),
        "incremental",
        "stg/stg_raw_fixtures",
        root,
        stamp,
        merge.FIXTURE_KEY,
        "updated_at",
    )
    seasons = dims.stg_league_seasons(source("etl.dim_league_seasons"), as_of)
    context = materialize(
        dims.league_context(
            seasons, dims.stg_leagues(source("etl.dim_leagues")), dims.stg_countries(source("etl.dim_countries"))
        ),
        "table",
        "int/int_league_context",
        root,
        stamp,
        checks=checks_of("int_league_context"),
    )
    teams = materialize(
        dims.int_teams(dims.stg_teams(source("etl.dim_teams"))), "table", "int/dim_teams", root, stamp, checks=checks_of("dim_teams")
    )
    enriched = materialize(
        facts.enrich_fixtures(fixtures, context, teams), "table", "int/int_fixtures", root, stamp, checks=checks_of("int_fixtures")
    )
    rows = materialize(
        facts.team_fixtures(enriched),
        "incremental",
        "int/fact_team_fixtures",
        root,
        stamp,
        ["fixture_id", "team_id"],
        checks=checks_of("fact_team_fixtures"),
    )
    materialize(facts.team_events(rows), "view", "int/fact_team_events")
    materialize(streaks.team_streaks(rows), "view", "int/fact_team_streaks")
    materialize(
        standings.team_running_table(standings.standings_input(rows, context)),
        "table",
        "int/int_teams_stats",
        root,
        stamp,
        checks=checks_of("int_teams_stats"),
    )
    checks = checks_of("mart_top_team_streaks")
    return materialize(marts.numbered_streaks(rows), "table", "mart/mart_top_team_streaks", root, stamp, checks=checks)


def full_refresh_job(spark: SparkSession, records: DataFrame, root: str, stamp: str, as_of=None, now=None) -> DataFrame:
    """Extracted records to marts: transform, load, models."""
    transform_job(records, root, "full", stamp)
    load_raw(spark, root, stamp, now)
    mart = build_models(spark, root, stamp, as_of)
    check_models(spark, root, stamp)
    tidy(spark, root)
    return mart


def daily_update_job(spark: SparkSession, records: DataFrame, root: str, stamp: str, as_of=None, now=None) -> DataFrame:
    """Fetched updates to marts: transform, apply what changed, models. An empty feed changes nothing."""
    if transform_job(records, root, "update", stamp):
        apply_played_updates(spark, root, stamp, now)
    mart = build_models(spark, root, stamp, as_of)
    check_models(spark, root, stamp)
    tidy(spark, root)
    return mart


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    """The stored mart in rank order."""
    return marts.rank_streaks(read_version(spark, f"{root}/mart/mart_top_team_streaks"))
