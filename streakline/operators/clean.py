"""Flatten, check, cast and score fixture records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.scalars import parse_utc
from streakline.schemas import (
    DEFAULT_STATUS,
    INTEGER_COLUMNS,
    PLAYED_STATUS,
    REQUIRED_COLUMNS,
    RESULT_COLUMNS,
    SPECIAL_STATUSES,
)

SECTIONS = ["fixture", "teams", "score", "league"]


class MissingColumns(ValueError):
    """A frame lacks columns that later steps need."""


# --- Nested payloads ------------------------------------------------------------


def validate_payload(df: DataFrame) -> DataFrame:
    """Add ``missing``: the names of the sections a record lacks.

    With a fixed schema an empty object reads as a struct of NULLs, so a section
    counts as missing when it is NULL or all its own fields are. A score section
    whose halves are there but hold no goals yet is not missing.
    """
    absent = {}
    for section in SECTIONS:
        present = F.col(section).isNotNull()
        anything = F.lit(False)
        for field in df.schema[section].dataType.names:
            anything = anything | F.col(f"{section}.{field}").isNotNull()
        absent[section] = ~(present & anything)
    names = F.array_compact(F.array(*[F.when(absent[s], F.lit(s)) for s in SECTIONS]))
    return df.withColumn("missing", names)


def split_payloads(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete records, and the rejected ones with what they lack."""
    checked = validate_payload(df)
    return (
        checked.where(F.size("missing") == 0).drop("missing"),
        checked.where(F.size("missing") > 0),
    )


def flatten_payload(df: DataFrame) -> DataFrame:
    """Complete nested records as the 13 flat columns; the rest are left out."""
    good, _ = split_payloads(df)
    columns = {
        "api_fixture_id": F.col("fixture.id"),
        "api_league_id": F.col("league.id").try_cast("bigint"),
        "season": F.col("league.season").try_cast("int"),
        "kickoff_utc": parse_utc(F.col("fixture.date")),
        "fixture_status": F.coalesce("fixture.status.short", F.lit(DEFAULT_STATUS)),
    }
    for side in ("home", "away"):
        columns[f"{side}_team_id"] = F.col(f"teams.{side}.id")
        columns[f"{side}_team_name"] = F.col(f"teams.{side}.name")
    for part in ("halftime", "fulltime"):
        for side in ("home", "away"):
            columns[f"{side}_team_{part}_goal"] = F.col(f"score.{part}.{side}")
    return good.select(*[column.alias(name) for name, column in columns.items()])


# --- Schema and types -------------------------------------------------------------


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    return sorted(set(required) - set(df.columns))


def validate_schema(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``df`` itself if it has every required column; otherwise ``MissingColumns``."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumns(f"missing required columns: {', '.join(missing)}")
    return df


def _whole_number(column: Column, kind: str) -> Column:
    """Text or number as an integer; unreadable or fractional values give NULL."""
    as_text = F.trim(column.cast("string"))
    # Plain digits go straight to the integer, so long ids keep every digit.
    direct = as_text.try_cast("bigint")
    number = as_text.try_cast("double")
    through_double = F.when(number % 1 == 0, number.try_cast("bigint"))
    return F.coalesce(F.when(as_text.rlike(r"^[+-]?\d+$"), direct), through_double).try_cast(kind)


def cast_numeric_columns(df: DataFrame) -> DataFrame:
    """Ids, season and goals as nullable integers; absent columns are skipped."""
    present = {name: kind for name, kind in INTEGER_COLUMNS.items() if name in df.columns}
    done = {n for n, k in present.items() if df.schema[n].dataType.simpleString() == k}
    return df.withColumns(
        {n: _whole_number(F.col(n), k) for n, k in present.items() if n not in done}
    )


def fractional_values(df: DataFrame) -> DataFrame:
    """The rows ``cast_numeric_columns`` would blank because a number has a fraction."""
    suspects = []
    for name in INTEGER_COLUMNS:
        if name in df.columns:
            number = F.trim(F.col(name).cast("string")).try_cast("double")
            suspects.append(F.coalesce((number % 1 != 0) & ~F.isnan(number), F.lit(False)))
    anything = suspects[0]
    for suspect in suspects[1:]:
        anything = anything | suspect
    return df.where(anything)


def blanked_values(records: DataFrame) -> DataFrame:
    """``api_fixture_id, column, value`` of every value that typing turns into NULL: fractions, other
    text where a number is due, unreadable kickoffs."""
    lost = {n: _whole_number(F.col(n), k) for n, k in INTEGER_COLUMNS.items() if n in records.columns}
    if records.schema["kickoff_utc"].dataType.simpleString() == "string":
        lost["kickoff_utc"] = parse_utc(F.col("kickoff_utc"))
    entries = [
        F.when(
            F.col(n).isNotNull() & typed.isNull(),
            F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value")),
        )
        for n, typed in lost.items()
    ]
    found = records.select(
        F.col("api_fixture_id").cast("string").alias("api_fixture_id"), F.explode(F.array_compact(F.array(*entries))).alias("x")
    )
    return found.select("api_fixture_id", "x.*")


def parse_kickoff(df: DataFrame) -> DataFrame:
    """ISO-8601 text kickoffs as UTC wall-clock time; typed kickoffs stay."""
    kind = df.schema["kickoff_utc"].dataType.simpleString()
    return df.withColumn("kickoff_utc", parse_utc(F.col("kickoff_utc"))) if kind == "string" else df


def normalize_status(df: DataFrame, name: str = "status_upper") -> DataFrame:
    return df.withColumn(name, F.upper("fixture_status"))


# --- Results ------------------------------------------------------------------------


def outcome(own: str, other: str) -> str:
    """win, loss or draw from one side's view (SQL text); NULL unless both scores are known."""
    return f"case when {own} > {other} then 'win' when {own} < {other} then 'loss' when {own} = {other} then 'draw' end"


def _results_for(statuses: Sequence[str]) -> dict[str, Column]:
    listed = ", ".join(f"'{s}'" for s in statuses)
    found = {}
    for part in ("fulltime", "halftime"):
        for own, other in (("home", "away"), ("away", "home")):
            result = outcome(f"{own}_team_{part}_goal", f"{other}_team_{part}_goal")
            found[f"{own}_{part}_result"] = F.expr(
                f"case when upper(fixture_status) in ({listed}) then {result} end"
            )
    return {name: found[name] for name in RESULT_COLUMNS}


def _fill_results(df: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Set results where the status applies; keep what other rows already have."""
    results = _results_for(statuses)
    return df.withColumns(
        {n: F.coalesce(c, F.col(n)) if n in df.columns else c for n, c in results.items()}
    )


def special_results(df: DataFrame) -> DataFrame:
    """Results of walkovers and awarded matches only."""
    return _fill_results(df, SPECIAL_STATUSES)


def game_results(df: DataFrame) -> DataFrame:
    """Results of matches played to the end only (status in any case)."""
    return _fill_results(df, [PLAYED_STATUS])


def compute_results(df: DataFrame) -> DataFrame:
    """All four result columns anew; other statuses get NULL."""
    return df.withColumns(_results_for([PLAYED_STATUS, *SPECIAL_STATUSES]))


def upcoming_fixtures(df: DataFrame) -> DataFrame:
    return df.where(F.col("home_fulltime_result").isNull())


def step_counts(df: DataFrame) -> DataFrame:
    """Rows in all, and how many still wait for a result."""
    return df.agg(
        F.count(F.lit(1)).alias("fixtures"),
        F.count_if(F.col("home_fulltime_result").isNull()).alias("upcoming"),
    )


# --- Staging models -------------------------------------------------------------------


def stg_fixtures(df: DataFrame) -> DataFrame:
    """Raw fixtures plus ``is_played`` (exactly ``FT``; other spellings are not played)."""
    played = F.coalesce(F.col("fixture_status") == PLAYED_STATUS, F.lit(False))
    tail = [c for c in ("created_at", "updated_at") if c in df.columns]
    head = [c for c in df.columns if c not in tail]
    return df.select(*head, played.alias("is_played"), *tail)


def stg_completed_fixtures(df: DataFrame) -> DataFrame:
    """The older raw layout, finished matches only."""
    return df.where(F.col("match_status") == PLAYED_STATUS).withColumnsRenamed(
        {"match_date": "date", "match_status": "status"}
    )


def played_only(df: DataFrame) -> DataFrame:
    return df.where("is_played")


def current_played_only(df: DataFrame) -> DataFrame:
    return df.where("is_current and is_played")
