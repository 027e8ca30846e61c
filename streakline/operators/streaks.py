"""Run lengths of yes/no flags in ordered rows.

The rules for a flag that is 1, 0 or NULL:

* a run starts at a 1 whose predecessor is 0, or that comes first;
* the length at a row is its distance from the latest start (from the key's
  first row if none started yet), counting every row between;
* rows whose flag is not 1 have length 0.

So a NULL neither starts nor ends a run: 1, NULL, 1 gives 1, 0, 3. With
``null_resets=True`` a NULL counts as 0.

All flags of a row are handled side by side. For the fixture events this means
one shuffle and one sort of the team rows, instead of a shuffle of 15 times as
many event rows; events become rows only afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.ordered import CHUNK, CHUNK_ROWS, attach_carry, per_key
from streakline.operators.facts import (
    FIXTURE_ORDER,
    TEAM_KEY,
    event_flags,
    stack_events,
)
from streakline.schemas import EVENT_CATALOG, Event


def run_lengths(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flags: Sequence[str] | dict[str, Column],
    *,
    null_resets: bool = False,
    with_ids: bool = False,
    chunk_rows: int = CHUNK_ROWS,
    hot: bool | None = None,
) -> DataFrame:
    """Add ``<flag>_length`` for every flag, and ``<flag>_run`` (the run's number) on request.

    ``flags`` names 0/1/NULL columns, or maps new columns to expressions. The
    latter are worked out after the shuffle, which then carries only what they
    are made of. ``order`` must identify a row within its key.
    """
    made = flags if isinstance(flags, dict) else {}
    rules = (keys, order, list(flags), null_resets, with_ids)

    def whole(rows: DataFrame) -> DataFrame:
        return _whole_runs(rows.repartition(*keys).withColumns(made) if made else rows, *rules)

    def in_chunks(pieces: DataFrame) -> DataFrame:
        ready = pieces.repartition(*keys, CHUNK).withColumns(made) if made else pieces
        return _chunked_runs(ready, *rules)

    return per_key(df, keys, order, whole, in_chunks, chunk_rows, hot)


def _whole_runs(df: DataFrame, keys, order, flags, null_resets, with_ids) -> DataFrame:
    """Each key in one window: one sort serves all flags."""
    # As SQL text: one parsed expression per column keeps plan building quick
    # when many flags are handled at once.
    ordered = f"partition by {', '.join(keys)} order by {', '.join(order)}"
    so_far = f"{ordered} rows between unbounded preceding and current row"
    now = {f: f"coalesce({f}, 0)" if null_resets else f for f in flags}
    marked = df.selectExpr(
        "*",
        f"cast(row_number() over ({ordered}) as bigint) as _row",
        *[f"{now[f]} = 1 and lag({now[f]}, 1, 0) over ({ordered}) = 0 as _s_{f}" for f in flags],
    )
    lengths = [
        f"if({f} = 1, _row + 1 - coalesce(max(if(_s_{f}, _row, null)) over ({so_far}), 1L), 0L) as {f}_length"
        for f in flags
    ]
    numbers = [f"sum(if(_s_{f}, 1, 0)) over ({so_far}) as {f}_run" for f in flags] if with_ids else []
    return marked.selectExpr(*df.columns, *lengths, *numbers)


def _chunked_runs(pieces: DataFrame, keys, order, flags, null_resets, with_ids) -> DataFrame:
    """Each chunk in one window, with row count, open run and run number carried along."""
    ordered = f"partition by {', '.join(keys)}, {CHUNK} order by {', '.join(order)}"
    so_far = f"{ordered} rows between unbounded preceding and current row"
    now = {f: f"coalesce({f}, 0)" if null_resets else f for f in flags}

    # Within a chunk: starts that need no knowledge of the chunk before.
    marked = pieces.selectExpr(
        "*",
        f"cast(row_number() over ({ordered}) as bigint) as _row",
        *[f"{now[f]} = 1 and lag({now[f]}) over ({ordered}) = 0 as _s_{f}" for f in flags],
    )
    local = marked.selectExpr(
        *pieces.columns,
        "_row",
        *[f"max(if(_s_{f}, _row, null)) over ({so_far}) as _start_{f}" for f in flags],
        *([f"sum(if(_s_{f}, 1, 0)) over ({so_far}) as _starts_{f}" for f in flags] if with_ids else []),
        *([f"first({now[f]}) over ({so_far}) as _opening_{f}" for f in flags] if with_ids else []),
    )

    # One row per chunk, then from chunk to chunk.
    place = f"struct({', '.join(order)})"
    per_flag = {
        "first": "min_by({now}, {place})",
        "last": "max_by({now}, {place})",
        "start": "max(if(_s_{f}, _row, null))",
        "starts": "count_if(_s_{f})",
    }
    summary = marked.groupBy(*keys, CHUNK).agg(
        F.expr("count(1) as _rows"),
        *[
            F.expr(f"{text.format(f=f, now=now[f], place=place)} as _{name}_{f}")
            for f in flags
            for name, text in per_flag.items()
        ],
    )
    chunks = f"partition by {', '.join(keys)} order by {CHUNK}"
    earlier = f"{chunks} rows between unbounded preceding and 1 preceding"
    # Does the chunk's first row start a run, given how the chunk before ended?
    linked = summary.selectExpr(
        "*",
        f"sum(_rows) over ({earlier}) as _before",
        *[
            f"coalesce(_first_{f} = 1 and lag(_last_{f} = 0, 1, true) over ({chunks}), false) as _begins_{f}"
            for f in flags
        ],
    )
    # The latest start known at the chunk's end, counted from the key's first row.
    placed = linked.selectExpr(
        "*",
        *[
            f"coalesce(coalesce(_before, 0L) + _start_{f}, if(_begins_{f}, coalesce(_before, 0L) + 1, null)) as _latest_{f}"
            for f in flags
        ],
    )
    carry = placed.selectExpr(
        *keys,
        CHUNK,
        "_before",
        # Where the run open at the chunk's first row started, and how many runs began by then.
        *[
            f"coalesce(if(_begins_{f}, _before + 1, null), max(_latest_{f}) over ({earlier}), 1L) as _base_{f}"
            for f in flags
        ],
        *[
            f"sum(_starts_{f} + int(_begins_{f})) over ({earlier}) + int(_begins_{f}) as _runs_{f}"
            for f in flags
            if with_ids
        ],
    ).where("_before is not null")

    joined = attach_carry(local, carry, keys)
    lengths = [
        f"""if({f} = 1, coalesce(_before, 0L) + _row + 1
                - coalesce(coalesce(_before, 0L) + _start_{f}, _base_{f}, 1L), 0L) as {f}_length"""
        for f in flags
    ]
    # In a key's first chunk the first row's own start is not among the local ones.
    numbers = [
        f"_starts_{f} + coalesce(_runs_{f}, if(_opening_{f} = 1, 1L, 0L)) as {f}_run" for f in flags if with_ids
    ]
    return joined.selectExpr(*[c for c in pieces.columns if c != CHUNK], *lengths, *numbers)


# --- Fixture events -------------------------------------------------------------------

LENGTHS = {"event_flag": "{}", "streak_length": "{}_length"}


def team_run_lengths(rows: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG, **options) -> DataFrame:
    """Current, played team rows with all event flags and run lengths side by side."""
    current = rows.where("is_current and is_played")
    return run_lengths(current, TEAM_KEY, FIXTURE_ORDER, event_flags(catalog), **options)


def team_streaks(rows: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG, **options) -> DataFrame:
    """The streak fact: one row per team, fixture and event with the length so far."""
    keep = ["team_id", "team_name", "league_season_id", "league_name", "fixture_id", "kickoff_utc"]
    return stack_events(team_run_lengths(rows, catalog, **options), keep, LENGTHS, catalog)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The last row of every key, as a plain aggregate: merged map-side, so no key is too big."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_row")).select(
        *keys, "_row.*"
    )


def current_streaks(rows: DataFrame, catalog: Sequence[Event] = EVENT_CATALOG, **options) -> DataFrame:
    """Every team's run lengths at its latest fixture, one row per team and event.

    The latest row is found per team before events become rows.
    """
    names = [e.name for e in catalog]
    lengths = team_run_lengths(rows, catalog, **options)
    latest = latest_per_key(
        lengths,
        TEAM_KEY,
        FIXTURE_ORDER,
        ["team_name", "league_season_id", "league_name", *[f"{n}_length" for n in names]],
    )
    keep = ["team_id", "team_name", "league_season_id", "league_name"]
    return stack_events(latest, keep, {"current_streak_length": "{}_length"}, catalog)
