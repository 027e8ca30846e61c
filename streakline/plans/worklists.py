"""What to fetch next: bootstrap lists, stale fixtures and request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.ordered import number_all
from streakline.functions.scalars import as_time
from streakline.functions.sizing import broadcast_if_small
from streakline.schemas import IDS_PER_REQUEST, STALE_AFTER_HOURS
from streakline.session import stage


def season_catalog(league_seasons: DataFrame, leagues: DataFrame, countries: DataFrame) -> DataFrame:
    """League-seasons by country and league name, with the year they start in."""
    return (
        league_seasons.join(leagues, "league_id")
        .join(countries, "country_id")
        .select(
            "country_name",
            "league_name",
            "api_league_id",
            F.year("start_date").alias("season_year"),
            "league_season_id",
            "fixtures_bootstrap_done",
        )
    )


def bootstrap_worklist(league_seasons: DataFrame, leagues: DataFrame, countries: DataFrame) -> DataFrame:
    """League-seasons whose fixtures were never loaded."""
    catalog = season_catalog(league_seasons, leagues, countries)
    return catalog.where(~F.col("fixtures_bootstrap_done")).drop("fixtures_bootstrap_done")


def first_kickoffs(fixtures: DataFrame) -> DataFrame:
    """The first kickoff of every league and season."""
    return fixtures.groupBy("api_league_id", "season").agg(F.min("kickoff_utc").alias("first_kickoff"))


def fixture_ids(rows: DataFrame, column: str = "fixture_id") -> DataFrame:
    """Each id once."""
    return rows.select(column).distinct()


def is_stale(as_of=None, hours: int = STALE_AFTER_HOURS) -> Column:
    """Kicked off more than ``hours`` ago and still without a full-time score."""
    limit = F.timestamp_add("HOUR", F.lit(-hours), as_time(as_of))
    unknown = F.col("home_team_fulltime_goal").isNull() | F.col("away_team_fulltime_goal").isNull()
    return (F.col("kickoff_utc") < limit) & unknown


def stale_fixtures(fixtures: DataFrame, leagues: DataFrame, league_seasons: DataFrame, as_of=None) -> DataFrame:
    """Stale fixtures of current league-seasons.

    Both conditions are applied before the join, to the fixture scan and to the
    season list, so the join sees little on either side.
    """
    current = broadcast_if_small(
        league_seasons.where("is_current")
        .join(leagues, "league_id")
        .select("api_league_id", "season", "league_season_id")
    )
    return fixtures.where(is_stale(as_of)).join(current, ["api_league_id", "season"])


def stale_fixture_ids(fixtures: DataFrame, leagues: DataFrame, league_seasons: DataFrame, as_of=None) -> DataFrame:
    return stale_fixtures(fixtures, leagues, league_seasons, as_of).transform(fixture_ids, "api_fixture_id")


def refresh_windows(
    fixtures: DataFrame, leagues: DataFrame, league_seasons: DataFrame, as_of=None
) -> DataFrame:
    """Per league-season, the date of the earliest stale kickoff."""
    return (
        stale_fixtures(fixtures, leagues, league_seasons, as_of)
        .groupBy("league_season_id", "api_league_id", "season")
        .agg(F.to_date(F.min("kickoff_utc")).alias("from_date"))
    )


def league_season_requests(
    fixtures: DataFrame, leagues: DataFrame, league_seasons: DataFrame, as_of=None, to_date=None
) -> DataFrame:
    """The requests to make per league-season: from the earliest stale date to ``to_date``."""
    last_day = F.lit(str(to_date)).cast("date") if to_date is not None else as_time(as_of).cast("date")
    return refresh_windows(fixtures, leagues, league_seasons, as_of).select(
        "league_season_id",
        F.col("api_league_id").alias("league"),
        "season",
        F.col("from_date").cast("string").alias("from"),
        last_day.cast("string").alias("to"),
    )


def batch_ids(ids: DataFrame, column: str, size: int = IDS_PER_REQUEST) -> DataFrame:
    """Ids in ascending order, ``size`` to a batch, joined by ``-``."""
    numbered = number_all(stage(ids.select(column)), [column], "_nr")
    return (
        numbered.withColumn("batch", F.floor((F.col("_nr") - 1) / size))
        .groupBy("batch")
        .agg(
            F.array_join(F.array_sort(F.collect_list(column)).cast("array<string>"), "-").alias("ids"),
            F.count(F.lit(1)).alias("n_ids"),
        )
    )


def id_requests(
    fixtures: DataFrame,
    leagues: DataFrame,
    league_seasons: DataFrame,
    as_of=None,
    size: int = IDS_PER_REQUEST,
) -> DataFrame:
    """The requests to make by fixture id, for every stale fixture."""
    ids = stale_fixture_ids(fixtures, leagues, league_seasons, as_of)
    return batch_ids(ids, "api_fixture_id", size)
