"""Enriched fixtures, team rows and event rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.ordered import CHUNK_ROWS, next_values
from streakline.functions.sizing import broadcast_if_small, is_small
from streakline.schemas import EVENT_CATALOG, Event

TEAM_KEY = ["team_id"]
FIXTURE_ORDER = ["kickoff_utc", "fixture_id"]
NEXT_FIXTURE = {"next_opponent_id": "opponent_id", "next_kickoff_utc": "kickoff_utc"}


def enrich_fixtures(fixtures: DataFrame, context: DataFrame, teams: DataFrame) -> DataFrame:
    """Fixtures with league-season and warehouse team ids.

    Inner joins: a fixture of an unknown league-season or team is left out.
    """
    league = broadcast_if_small(
        context.select("api_league_id", "season", "league_season_id", "league_name", "is_current")
    )
    small_teams = is_small(teams)

    def team(side: str) -> DataFrame:
        named = teams.selectExpr(
            f"api_team_id as {side}_api_id", f"team_id as {side}_id", f"team_name as {side}_name"
        )
        return F.broadcast(named) if small_teams else named

    return (
        fixtures.join(league, ["api_league_id", "season"])
        .join(team("home"), F.col("home_team_id") == F.col("home_api_id"))
        .join(team("away"), F.col("away_team_id") == F.col("away_api_id"))
        .selectExpr(
            "fixture_id",
            "league_season_id",
            "league_name",
            "season",
            "kickoff_utc",
            "home_id as home_team_id",
            "away_id as away_team_id",
            "home_name as home_team_name",
            "away_name as away_team_name",
            "home_team_fulltime_goal as home_ftg",
            "away_team_fulltime_goal as away_ftg",
            "home_team_halftime_goal as home_htg",
            "away_team_halftime_goal as away_htg",
            "home_fulltime_result as home_ftr",
            "away_fulltime_result as away_ftr",
            "home_halftime_result as home_htr",
            "away_halftime_result as away_htr",
            "updated_at",
            "is_played",
            "fixture_status",
            "is_current",
        )
    )


def unpivot_team_rows(fixtures: DataFrame) -> DataFrame:
    """One fixture row becomes two team rows, home view and away view."""

    def view(own: str, other: str) -> str:
        return f"""struct(
            {own}_team_id as team_id, {own}_team_name as team_name,
            {other}_team_id as opponent_id, {other}_team_name as opponent_name,
            {str(own == "home").lower()} as is_home,
            {own}_ftg as goals_for, {other}_ftg as goals_against,
            {own}_htg as halftime_goals_for, {other}_htg as halftime_goals_against,
            {own}_ftr as fulltime_result, {own}_htr as halftime_result)"""

    return fixtures.selectExpr(
        "fixture_id",
        "league_season_id",
        "league_name",
        "season",
        "kickoff_utc",
        "updated_at",
        "is_played",
        "is_current",
        f"inline(array({view('home', 'away')}, {view('away', 'home')}))",
    )


def next_fixture(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, hot: bool | None = None) -> DataFrame:
    """Each team row with the team's next opponent and kickoff, over all its fixtures."""
    return next_values(
        rows,
        TEAM_KEY,
        FIXTURE_ORDER,
        NEXT_FIXTURE,
        chunk_rows=chunk_rows,
        hot=hot,
    )


def team_fixtures(fixtures: DataFrame, chunk_rows: int = CHUNK_ROWS, hot: bool | None = None) -> DataFrame:
    """The team-row fact: unpivoted fixtures with the next fixture attached."""
    return _fact(next_fixture(unpivot_team_rows(fixtures), chunk_rows, hot))


def team_fixtures_of(sides: DataFrame, by: Column | None = None) -> DataFrame:
    """``team_fixtures`` of unpivoted rows; shuffled by ``by``, a function of the team, if no team is crowded."""
    if by is None:
        return _fact(next_fixture(sides))
    rows = sides.withColumn("_by", by).repartition("_by")
    return _fact(next_values(rows, ["_by", *TEAM_KEY], FIXTURE_ORDER, NEXT_FIXTURE, hot=False))


def _fact(rows: DataFrame) -> DataFrame:
    return rows.select(
        "fixture_id",
        "league_season_id",
        "league_name",
        "season",
        "team_id",
        "team_name",
        "opponent_id",
        "opponent_name",
        "is_home",
        "kickoff_utc",
        "goals_for",
        "goals_against",
        "halftime_goals_for",
        "halftime_goals_against",
        "fulltime_result",
        "halftime_result",
        "next_opponent_id",
        "next_kickoff_utc",
        "is_played",
        "is_current",
        "updated_at",
    )


def event_flags(catalog: Sequence[Event] = EVENT_CATALOG) -> dict[str, Column]:
    """One 0/1/NULL column per event, by event name."""
    return {e.name: F.expr(e.predicate).cast("int") for e in catalog}


def stack_events(
    rows: DataFrame,
    keep: Sequence[str],
    values: dict[str, str],
    catalog: Sequence[Event] = EVENT_CATALOG,
) -> DataFrame:
    """Side-by-side event columns as one row per event.

    ``values`` maps each output column to the pattern of its input columns, for
    instance ``{"event_flag": "{}", "streak_length": "{}_length"}``.
    """
    entries = []
    for e in catalog:
        parts = [f"'{e.name}' as event_name", f"'{e.streak_type}' as streak_type"]
        parts += [f"{pattern.format(e.name)} as {out}" for out, pattern in values.items()]
        entries.append(f"struct({', '.join(parts)})")
    return rows.selectExpr(*keep, f"inline(array({', '.join(entries)}))")


EVENT_COLUMNS = [
    "league_season_id",
    "league_name",
    "season",
    "fixture_id",
    "team_id",
    "team_name",
    "opponent_id",
    "opponent_name",
    "kickoff_utc",
    "goals_for",
    "goals_against",
    "fulltime_result",
    "is_home",
    "is_current",
    "is_played",
]


def team_events(rows: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG) -> DataFrame:
    """Played team rows, one row per event of the catalog."""
    played = rows.where("is_played").withColumns(event_flags(catalog))
    return stack_events(played, EVENT_COLUMNS, {"event_flag": "{}"}, catalog)
