"""The running league table: totals, rates, points and position after every match.

``rows`` are played team rows with ``league_id, season, team_id, date``,
a tie-break id, ``fulltime_result, goals_for, goals_against``. Totals include
all matches of the same date.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.functions.ordered import CHUNK_ROWS, bounded_join, row_numbers
from streakline.functions.scalars import half_up_hundredths
from streakline.functions.sizing import broadcast_if_small
from streakline.session import stage, stored

SEASON_KEY = ["league_id", "season"]
TEAM_SEASON_KEY = ["league_id", "season", "team_id"]

def completed_input(completed: DataFrame) -> DataFrame:
    """The same from the older layout (``clean.stg_completed_fixtures``): a wide match becomes two team rows."""

    def view(own: str, other: str) -> str:
        return f"""struct(
            {own}_team_id as team_id, {own}_team_name as team_name,
            {other}_team_id as opponent_id, {other}_team_name as opponent_name, {own}_fulltime_result as result,
            {own}_team_fulltime_goal as goals_scored, {other}_team_fulltime_goal as goals_conceded)"""

    return completed.selectExpr(
        "fixture_id",
        "to_date(date) as date",
        "date as kickoff_utc",
        "season",
        "league_id",
        "country",
        "league",
        f"inline(array({view('home', 'away')}, {view('away', 'home')}))",
    )


# Points per result: fixed values.
POINTS = {"win": 3, "draw": 1, "loss": 0}


def standings_input(team_rows: DataFrame, context: DataFrame) -> DataFrame:
    """Played team rows with league and country, dated by day."""
    league = broadcast_if_small(
        context.select("league_season_id", "league_id", F.col("country_name").alias("country"))
    )
    return (
        team_rows.where("is_played")
        .join(league, "league_season_id")
        .selectExpr(
            "fixture_id",
            "to_date(kickoff_utc) as date",
            "kickoff_utc",
            "season",
            "league_id",
            "country",
            "league_name as league",
            "team_id",
            "team_name",
            "opponent_id",
            "opponent_name",
            "fulltime_result as result",
            "goals_for as goals_scored",
            "goals_against as goals_conceded",
        )
    )


def measures() -> dict[str, Column]:
    """What a single match adds to each running total."""
    points = "case " + " ".join(f"when result = '{r}' then {p}" for r, p in POINTS.items()) + " else 0 end"
    return {
        "games_played": F.expr("1L"),
        "wins": F.expr("if(result = 'win', 1L, 0L)"),
        "losses": F.expr("if(result = 'loss', 1L, 0L)"),
        "draws": F.expr("if(result = 'draw', 1L, 0L)"),
        "goals_for": F.expr("cast(goals_scored as bigint)"),
        "goals_against": F.expr("cast(goals_conceded as bigint)"),
        "rolling_points": F.expr(f"cast({points} as bigint)"),
        "_scored_known": F.expr("if(goals_scored is not null, 1L, 0L)"),
        "_conceded_known": F.expr("if(goals_conceded is not null, 1L, 0L)"),
    }


def _attach(df: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``values``, one row per ``keys``; NULL keys match too."""
    named = values.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(named, same).drop(*[f"_of_{k}" for k in keys])


def running_totals(rows: DataFrame) -> DataFrame:
    """Add the running totals by date, same-date matches included.

    Matches are first summed per team and date (map-side), so a window holds at most one
    row per calendar day of a season, and the totals are joined back. NULL dates are a day
    of their own, before all others. ``rows`` are read twice: pass stored ones.
    """
    parts = measures()
    daily = rows.groupBy(*TEAM_SEASON_KEY, "date").agg(*[F.sum(c).alias(n) for n, c in parts.items()])
    days = (
        Window.partitionBy(*TEAM_SEASON_KEY)
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = daily.withColumns({n: F.sum(n).over(days) for n in parts})
    return _attach(rows, totals, [*TEAM_SEASON_KEY, "date"])


def rates(totals: DataFrame) -> DataFrame:
    """Win, loss and draw rates and goal averages, rounded half up to two places."""
    hundredths = {
        "rolling_win_rate": ("wins", "games_played"),
        "rolling_loss_rate": ("losses", "games_played"),
        "rolling_draw_rate": ("draws", "games_played"),
        "rolling_avg_goals_for": ("goals_for", "_scored_known"),
        "rolling_avg_goals_against": ("goals_against", "_conceded_known"),
    }
    cents = {f"_{n}": half_up_hundredths(F.col(a), F.col(b)) for n, (a, b) in hundredths.items()}
    return totals.withColumns(cents).withColumns({n: F.col(f"_{n}") / 100.0 for n in hundredths})


def tie_breaker(df: DataFrame) -> DataFrame:
    """Rounded win rate plus rounded draw rate, in hundredths."""
    return df.withColumn("_aggregator", F.col("_rolling_win_rate") + F.col("_rolling_draw_rate"))


def positions(df: DataFrame) -> DataFrame:
    """``position``: dense rank per league, season and matchday by points, then tie-breaker.

    Ranks are worked out over the distinct (points, tie-breaker) pairs, of which a matchday
    has few whatever the number of teams, and joined back. ``df`` is read twice.
    """
    keys = [*SEASON_KEY, "matchday"]
    table = Window.partitionBy(*keys).orderBy(F.desc("rolling_points"), F.desc("_aggregator"))
    scores = [*keys, "rolling_points", "_aggregator"]
    ranks = df.select(*scores).distinct().withColumn("position", F.dense_rank().over(table).cast("bigint"))
    return _attach(df, ranks, scores)


# The columns of the stored table.
COLUMNS = [
    "date",
    "matchday",
    "team_name",
    "team_id",
    "position",
    "league",
    "league_id",
    "country",
    "season",
    "result",
    "opponent_name",
    "opponent_id",
    "games_played",
    "wins",
    "losses",
    "draws",
    "goals_scored",
    "goals_conceded",
    "goals_for",
    "goals_against",
    "rolling_win_rate",
    "rolling_draw_rate",
    "rolling_loss_rate",
    "rolling_avg_goals_for",
    "rolling_avg_goals_against",
    "rolling_points",
]


def matchdays(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, hot: bool | None = None) -> DataFrame:
    """A team's matches of a season numbered by date and fixture id."""
    return row_numbers(rows, TEAM_SEASON_KEY, ["date", "fixture_id"], "matchday", chunk_rows, hot)


def running_rows(rows: DataFrame) -> DataFrame:
    """Matchday and running totals of ordinary team-seasons, in windows over one shuffle and one sort.

    Totals are over days: the frame takes in all matches of the same date, and NULL dates
    are a day of their own, before all others.
    """
    of_team = Window.partitionBy(*TEAM_SEASON_KEY)
    numbered = rows.withColumn("matchday", F.row_number().over(of_team.orderBy("date", "fixture_id")).cast("bigint"))
    days = of_team.orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.withColumns({n: F.sum(c).over(days) for n, c in measures().items()})


def league_positions(df: DataFrame) -> DataFrame:
    """``position`` as ``positions`` gives it, where a season has no more teams than a window may hold."""
    table = Window.partitionBy(*SEASON_KEY, "matchday").orderBy(F.desc("rolling_points"), F.desc("_aggregator"))
    return df.withColumn("position", F.dense_rank().over(table).cast("bigint"))


def team_running_table(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The whole chain from dated team rows to ranked running totals.

    Rows are exchanged twice: by team and season for the totals, by matchday for the positions.
    Team-seasons of more than ``chunk_rows`` matches are cut and summed by day apart, and where a
    season has more than ``chunk_rows`` teams positions come from the distinct scores. Both are
    told by one count per team and season.
    """
    rows = stored(rows)
    sizes = stage(rows.groupBy(*TEAM_SEASON_KEY).agg(F.count(F.lit(1)).alias("n")))
    seasons = sizes.groupBy(*SEASON_KEY).agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("teams"))
    most = seasons.agg(F.max("n").alias("n"), F.max("teams").alias("teams")).first()
    if (most["n"] or 0) <= chunk_rows:
        totals = running_rows(rows)
    else:
        crowded = stage(sizes.where(F.col("n") > chunk_rows).select(*TEAM_SEASON_KEY))
        ordinary = bounded_join(rows, crowded, TEAM_SEASON_KEY, "left_anti")
        cut_rows = stage(matchdays(bounded_join(rows, crowded, TEAM_SEASON_KEY, "left_semi"), chunk_rows, hot=True))
        totals = running_rows(ordinary).unionByName(running_totals(cut_rows))
    # Rates and tie-breakers are worked out after the exchange for the positions, which then carries totals alone.
    scored = tie_breaker(rates(totals.repartition(*SEASON_KEY, "matchday")))
    ranked = league_positions(scored) if (most["teams"] or 0) <= chunk_rows else positions(stage(scored))
    return ranked.select("fixture_id", *COLUMNS)
