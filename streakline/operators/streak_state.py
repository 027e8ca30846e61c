"""Streaks that grow from saved state instead of from all matches.

What later rows need of a key's past is one row: how many rows it had, where the last one stands,
and per flag the last value and the row where the latest run started (see ``streaks`` for the rules). New
rows that all come after that place take their lengths from it; their windows hold nothing else.
Two states of one key merge by taking the later one, since the later was made from the earlier.

A key whose new rows reach back to its last place or before, or change a row it has, has to be
counted again from its own rows; no other key is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.ordered import row_numbers
from streakline.operators.facts import FIXTURE_ORDER, TEAM_KEY, event_flags
from streakline.operators.streaks import run_lengths
from streakline.schemas import EVENT_CATALOG, Event

ROW = "row_nr"


def whole_lengths(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], flags: dict[str, Column], hot: bool | None = None
) -> DataFrame:
    """All rows of some keys: ``row_nr``, the flags, and ``<flag>_length``; no key is too long for it."""
    lengths = run_lengths(rows, keys, order, flags, hot=hot)
    return row_numbers(lengths, keys, order, ROW, hot=hot)


def state_of(lengths: DataFrame, keys: Sequence[str], order: Sequence[str], flags: Sequence[str], shown: Sequence[str] = ()) -> DataFrame:
    """One row per key of ``lengths`` (as ``whole_lengths`` or ``extend`` give them).

    ``rows``, ``latest`` (the place of the last row), per flag ``last_``, ``start_`` and ``now_``
    (its length at the last row), and the ``shown`` columns of the last row. A plain aggregate.
    """
    # A row whose flag is set stands as far from the latest start as its length tells.
    started = [F.max(F.when(F.col(f) == 1, F.col(ROW) + 1 - F.col(f"{f}_length"))).alias(f"start_{f}") for f in flags]
    columns = [*[F.col(f).alias(f"last_{f}") for f in flags], *[F.col(f"{f}_length").alias(f"now_{f}") for f in flags]]
    place = F.struct(*order)
    last = F.max_by(F.struct(F.col(ROW).alias("rows"), place.alias("latest"), *columns, *shown), place)
    return lengths.groupBy(*keys).agg(last.alias("_last"), *started).select(*keys, "_last.*", *[f"start_{f}" for f in flags])


def extend(rows: DataFrame, state: DataFrame, keys: Sequence[str], order: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """``rows`` with ``row_nr``, flags and lengths, counted on from ``state``.

    All rows of a key must come after its ``latest``; a key without state starts anew.
    """
    names = list(flags)
    carried = state.select(*keys, F.col("rows").alias("_rows"), *[f"last_{f}" for f in names], *[f"start_{f}" for f in names])
    ordered = f"partition by {', '.join(keys)} order by {', '.join(order)}"
    so_far = f"{ordered} rows between unbounded preceding and current row"
    marked = (
        rows.withColumns(flags)
        .join(carried, list(keys), "left")
        .selectExpr(
            "*",
            f"coalesce(_rows, 0L) + row_number() over ({ordered}) as {ROW}",
            # The first new row follows the last one that was counted.
            *[f"{f} = 1 and lag({f}, 1, if(_rows is null, 0, last_{f})) over ({ordered}) = 0 as _s_{f}" for f in names],
        )
    )
    lengths = [
        f"if({f} = 1, {ROW} + 1 - coalesce(max(if(_s_{f}, {ROW}, null)) over ({so_far}), start_{f}, 1L), 0L) as {f}_length"
        for f in names
    ]
    return marked.selectExpr(*rows.columns, *names, *lengths, ROW)


def merged_state(old: DataFrame, new: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """States of the keys of both, made from rows that ``new`` adds to ``old``."""
    starts = [f"start_{f}" for f in flags]
    before = old.select(*keys, *[F.col(s).alias(f"_old_{s}") for s in starts])
    # New rows without a start leave the run that was open.
    grown = new.join(before, list(keys), "left").select(
        *[F.coalesce(c, f"_old_{c}").alias(c) if c in starts else F.col(c) for c in new.columns]
    )
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(grown)


def split_feed(feed: DataFrame, counted: Column, state: DataFrame, stored: DataFrame, keys: Sequence[str], order: Sequence[str], row_key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Keys that have to be counted again, and the ``counted`` rows of ``feed`` that others simply add.

    Again: keys with a row in ``feed`` that ``stored`` has, or that does not come after ``latest``.
    """
    known = feed.join(stored.select(*row_key), list(row_key), "left_semi").select(*keys)
    late = (
        feed.where(counted)
        .join(state.select(*keys, "latest"), list(keys))
        .where(F.struct(*order) <= F.col("latest"))
        .select(*keys)
    )
    again = known.unionByName(late).distinct()
    return again, feed.where(counted).join(again, list(keys), "left_anti")


# --- Fixture events ---------------------------------------------------------------------

SHOWN = ["team_name", "league_season_id", "league_name"]
KEPT = ["team_id", *SHOWN, "fixture_id", "kickoff_utc"]
COUNTED = "is_current and is_played"


def team_flags(catalog: Sequence[Event] = EVENT_CATALOG) -> dict[str, Column]:
    return event_flags(catalog)


def team_columns(catalog: Sequence[Event] = EVENT_CATALOG) -> list[str]:
    """What is stored of a counted team row."""
    return [*KEPT, ROW, *[e.name for e in catalog], *[f"{e.name}_length" for e in catalog]]


def team_lengths(rows: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG, hot: bool | None = None) -> DataFrame:
    """Counted team rows with flags and lengths side by side, from all rows of their teams."""
    return whole_lengths(rows.where(COUNTED), TEAM_KEY, FIXTURE_ORDER, event_flags(catalog), hot).select(*team_columns(catalog))


def more_team_lengths(rows: DataFrame, state: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG) -> DataFrame:
    """The same for rows that come after all that ``state`` has seen of their teams."""
    return extend(rows, state, TEAM_KEY, FIXTURE_ORDER, event_flags(catalog)).select(*team_columns(catalog))


def team_state(lengths: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG) -> DataFrame:
    return state_of(lengths, TEAM_KEY, FIXTURE_ORDER, [e.name for e in catalog], SHOWN)
