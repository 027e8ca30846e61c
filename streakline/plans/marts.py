"""The marts: current streaks ranked, latest streaks, and the rows a client reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.functions.ordered import CHUNK_ROWS, number_all
from streakline.operators.streaks import current_streaks
from streakline.schemas import EVENT_CATALOG, MIN_STREAK_LENGTH, Event
from streakline.session import stage

DISPLAY_ORDER = ["team_id", "league_season_id", "event_name", "streak_type"]


def longer_than(streaks: DataFrame, length: int = MIN_STREAK_LENGTH) -> DataFrame:
    return streaks.where(F.col("current_streak_length") > length)


def display_ids(streaks: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Number the rows for display. The ids are not stable from run to run.

    The filtered rows (at most one per team and event) are computed once and
    stored, then counted and numbered from there.
    """
    return number_all(stage(streaks), DISPLAY_ORDER, "streak_id", chunk_rows=chunk_rows)


def rank_streaks(mart: DataFrame) -> DataFrame:
    """Longest first; ties by team name, then by display id."""
    return mart.orderBy(F.desc("current_streak_length"), "team_name", "streak_id")


MART_COLUMNS = ["streak_id", "league_name", "team_name", "event_name", "streak_type", "current_streak_length"]


def numbered_streaks(
    rows: DataFrame,
    min_length: int = MIN_STREAK_LENGTH,
    catalog: Sequence[Event] = EVENT_CATALOG,
    **options,
) -> DataFrame:
    """The mart's rows in no order, as a table stores them."""
    lengths = longer_than(current_streaks(rows, catalog, **options), min_length)
    return display_ids(lengths, options.get("chunk_rows", CHUNK_ROWS)).select(*MART_COLUMNS)


def top_team_streaks(
    rows: DataFrame,
    min_length: int = MIN_STREAK_LENGTH,
    catalog: Sequence[Event] = EVENT_CATALOG,
    **options,
) -> DataFrame:
    """From team rows to the ranked table of current streaks longer than ``min_length``."""
    return rank_streaks(numbered_streaks(rows, min_length, catalog, **options))


def latest_team_streaks(rows: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG, **options) -> DataFrame:
    """The latest streak count of every team and event, zeros included."""
    return current_streaks(rows, catalog, **options).select(
        "team_id", "team_name", "event_name", F.col("current_streak_length").alias("streak_count")
    )


# --- What a client reads -----------------------------------------------------------------


def list_streaks(mart: DataFrame) -> DataFrame:
    return mart.select(
        "streak_id",
        "streak_type",
        F.col("current_streak_length").alias("streak_count"),
        "event_name",
        "team_name",
        "league_name",
    )


def streaks_by_type(mart: DataFrame, streak_type: str) -> DataFrame:
    return list_streaks(mart).where(F.col("streak_type") == streak_type)
