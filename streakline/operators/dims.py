"""Dimensions: metadata flattening, staging projections and league context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.scalars import as_time, season_label, title_case
from streakline.schemas import MIN_SEASON

# --- Metadata tree --------------------------------------------------------------


def requested_leagues(tree: DataFrame) -> DataFrame:
    """(country, league) pairs with the first catalog match, NULL where there is none."""
    return (
        tree.select("country", F.explode("leagues").alias("l"))
        .select(
            "country",
            F.col("l.name").alias("league_name"),
            F.get(F.col("l.matches"), F.lit(0)).alias("match"),
        )
    )


def flatten_countries(tree: DataFrame) -> DataFrame:
    return tree.select(F.col("country").alias("country_name")).distinct()


def flatten_leagues(tree: DataFrame) -> DataFrame:
    return (
        requested_leagues(tree)
        .where(F.col("match").isNotNull())
        .select(F.col("country").alias("country_name"), "league_name", F.col("match.league.id").alias("api_league_id"))
        .distinct()
    )


def missing_leagues(tree: DataFrame) -> DataFrame:
    """Requested leagues the catalog does not know."""
    return (
        requested_leagues(tree)
        .where(F.col("match").isNull())
        .select("country", F.col("league_name").alias("league"))
        .distinct()
    )


def missing_from_catalog(requested: DataFrame, catalog: DataFrame) -> DataFrame:
    """The same for two flat tables: requested (country, league) pairs without a catalog row."""
    return requested.distinct().join(catalog, ["country", "league"], "left_anti")


def season_rows(seasons: DataFrame, min_season: int = MIN_SEASON) -> DataFrame:
    """Seasons with a usable year not before ``min_season``, with their label."""
    year = F.col("year").try_cast("int")
    return (
        seasons.withColumn("season", year)
        .where(F.col("season") >= min_season)
        .withColumns(
            {
                "season_label": season_label(F.col("season")),
                "start_date": F.col("start").try_cast("date"),
                "end_date": F.col("end").try_cast("date"),
            }
        )
        .drop("year", "start", "end")
    )


def _league_seasons(tree: DataFrame) -> DataFrame:
    return (
        requested_leagues(tree)
        .where(F.col("match").isNotNull())
        .select(
            F.col("country").alias("country_name"),
            F.col("match.league.id").alias("api_league_id"),
            F.explode("match.seasons").alias("s"),
        )
        .select("country_name", "api_league_id", "s.*")
    )


def flatten_seasons(tree: DataFrame, min_season: int = MIN_SEASON) -> DataFrame:
    return season_rows(_league_seasons(tree).drop("teams", "country_name"), min_season).distinct()


def flatten_team_payload(df: DataFrame) -> DataFrame:
    """Team lookups as name, id, code; entries without a team are left out."""
    return df.where(F.col("team").isNotNull()).select("team.name", "team.id", "team.code")


def valid_teams(df: DataFrame) -> DataFrame:
    """Drop teams without an id (NULL or 0) or without a name (NULL or empty)."""
    return df.where((F.col("id") != 0) & (F.col("name") != ""))


def flatten_teams(tree: DataFrame, min_season: int = MIN_SEASON) -> DataFrame:
    """Teams of the seasons kept, each with its country."""
    entries = (
        season_rows(_league_seasons(tree), min_season)
        .select("country_name", F.explode("teams").alias("entry"))
        .select("country_name", "entry.team")
    )
    flat = entries.where(F.col("team").isNotNull()).select(
        "country_name", "team.name", "team.id", "team.code"
    )
    return (
        valid_teams(flat)
        .select(
            F.col("id").alias("api_team_id"),
            F.col("name").alias("team_name"),
            F.col("code").alias("team_code"),
            "country_name",
        )
        .distinct()
    )


# --- Staging projections -----------------------------------------------------------


def stg_countries(df: DataFrame) -> DataFrame:
    return df.select("country_id", "country_name")


def stg_leagues(df: DataFrame) -> DataFrame:
    return df.select("league_id", "api_league_id", "league_name", "country_id")


def stg_teams(df: DataFrame) -> DataFrame:
    return df.select("team_id", "api_team_id", "team_name")


def stg_league_seasons(df: DataFrame, as_of=None) -> DataFrame:
    """Season columns plus ``is_current``: does ``as_of`` fall within the dates?"""
    today = as_time(as_of).cast("date")
    current = F.coalesce(today.between(F.col("start_date"), F.col("end_date")), F.lit(False))
    return df.select(
        "league_season_id",
        "league_id",
        "season",
        "season_label",
        "start_date",
        "end_date",
        current.alias("is_current"),
    )


def int_teams(stg: DataFrame, name: Column | None = None) -> DataFrame:
    """Conformed teams: both keys and the name in title case."""
    shown = title_case(F.col("team_name")) if name is None else name
    return stg.select("team_id", "api_team_id", shown.alias("team_name"))


# --- League context ------------------------------------------------------------------


def league_context(league_seasons: DataFrame, leagues: DataFrame, countries: DataFrame) -> DataFrame:
    """One row per league-season with its league and country.

    All three tables are small next to the facts; how to join them is left to
    the planner.
    """
    return (
        league_seasons.join(leagues, "league_id")
        .join(countries, "country_id")
        .select(
            "country_name",
            "league_name",
            "league_id",
            "api_league_id",
            "season",
            "league_season_id",
            "is_current",
        )
    )
