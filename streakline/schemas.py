"""Entity schemas, required columns, statuses and the event catalog.

Times of the day are kept as ``timestamp_ntz`` holding UTC wall-clock time, so
results do not move with ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Event(NamedTuple):
    """One yes/no event of a team row: a name, a SQL predicate and a type."""

    name: str
    predicate: str
    streak_type: str


# --- Fixed values: these must stay as they are for results to be right -------

REQUIRED_COLUMNS = [
    "api_fixture_id",
    "api_league_id",
    "season",
    "kickoff_utc",
    "fixture_status",
    "home_team_id",
    "home_team_name",
    "away_team_id",
    "away_team_name",
    "home_team_halftime_goal",
    "away_team_halftime_goal",
    "home_team_fulltime_goal",
    "away_team_fulltime_goal",
]

INTEGER_COLUMNS = {
    "api_fixture_id": "bigint",
    "api_league_id": "bigint",
    "season": "int",
    "home_team_id": "bigint",
    "away_team_id": "bigint",
    "home_team_halftime_goal": "int",
    "away_team_halftime_goal": "int",
    "home_team_fulltime_goal": "int",
    "away_team_fulltime_goal": "int",
}

RESULT_COLUMNS = [
    "home_fulltime_result",
    "away_fulltime_result",
    "home_halftime_result",
    "away_halftime_result",
]

RESULT_VALUES = ["win", "draw", "loss"]
STREAK_TYPES = ["goal_streaks", "result_streaks", "special_streaks"]
PLAYED_STATUS = "FT"
SPECIAL_STATUSES = ["WO", "AWD"]
DEFAULT_STATUS = "NS"
MIN_SEASON = 2020
MIN_STREAK_LENGTH = 2
IDS_PER_REQUEST = 20
STALE_AFTER_HOURS = 2

EVENT_CATALOG = [
    Event("score_1goal", "goals_for >= 1", "goal_streaks"),
    Event("score_2goals", "goals_for >= 2", "goal_streaks"),
    Event("score_3goals", "goals_for >= 3", "goal_streaks"),
    Event("concede_1", "goals_against >= 1", "goal_streaks"),
    Event("concede_2", "goals_against >= 2", "goal_streaks"),
    Event("concede_3", "goals_against >= 3", "goal_streaks"),
    Event("goalless", "goals_for = 0", "special_streaks"),
    Event("clean_sheet", "goals_against = 0", "special_streaks"),
    Event("win", "fulltime_result = 'win'", "result_streaks"),
    Event("draw", "fulltime_result = 'draw'", "result_streaks"),
    Event("loss", "fulltime_result = 'loss'", "result_streaks"),
    Event("win_or_draw", "fulltime_result in ('win', 'draw')", "result_streaks"),
    Event("halftime_win", "halftime_result = 'win'", "special_streaks"),
    Event(
        "win_draw_over_1_5",
        "fulltime_result in ('win', 'draw') and goals_for + goals_against > 1.5",
        "special_streaks",
    ),
    Event(
        "win_draw_under_4_5",
        "fulltime_result in ('win', 'draw') and goals_for + goals_against < 4.5",
        "special_streaks",
    ),
]

# --- Schemas of what is read from outside ------------------------------------

# JSON numbers and texts both arrive as text; ``clean.cast_numeric_columns`` types them.
FLAT_FIXTURE_TEXT = T.StructType(
    [T.StructField(name, T.StringType()) for name in REQUIRED_COLUMNS]
)

PAYLOAD_DDL = (
    "fixture struct<id: bigint, date: string, status: struct<short: string>>, "
    "league struct<id: string, season: string>, "
    "teams struct<home: struct<id: bigint, name: string>, away: struct<id: bigint, name: string>>, "
    "score struct<halftime: struct<home: int, away: int>, fulltime: struct<home: int, away: int>>"
)

METADATA_DDL = (
    "country string, "
    "leagues array<struct<name: string, matches: array<struct<"
    "league: struct<id: bigint>, "
    "seasons: array<struct<year: string, start: string, end: string, "
    "teams: array<struct<team: struct<id: bigint, name: string, code: string>>>>>>>>>"
)

TEAM_PAYLOAD_DDL = "team struct<id: bigint, name: string, code: string>"

RAW_FIXTURES_DDL = (
    "fixture_id bigint, api_fixture_id bigint, api_league_id bigint, season int, "
    "kickoff_utc timestamp_ntz, fixture_status string, "
    "home_team_id bigint, home_team_name string, away_team_id bigint, away_team_name string, "
    "home_team_halftime_goal int, away_team_halftime_goal int, "
    "home_team_fulltime_goal int, away_team_fulltime_goal int, "
    "home_fulltime_result string, away_fulltime_result string, "
    "home_halftime_result string, away_halftime_result string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)
