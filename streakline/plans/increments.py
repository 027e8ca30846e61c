"""Models kept up to date by what a feed touches, instead of built anew.

The raw table lies in buckets of fixtures: a feed reads and rewrites the buckets that it falls into.
Three further tables lie in buckets of teams (``sources.buckets``): the team rows with their next fixture,
the counted rows with their streak lengths, and one row of streak state per team. All have the same
number of buckets, so a feed touches the same ones in each.

A step reads the buckets of the teams that play in the changed fixtures. Teams that only play
on are extended from their state; teams with a backdated, moved or corrected match are counted again.
The mart needs the states alone. The result equals a full build over the same fixtures.

A fixture keeps its two teams. One whose league or team is no longer known stays as it is until
the next full build.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.functions.ordered import hot_keys
from streakline.operators import clean, dims, facts, merge, repair, streak_state
from streakline.operators.facts import FIXTURE_ORDER, TEAM_KEY
from streakline.plans import marts
from streakline.plans.jobs import FINISHED_LAST, KEEP_VERSIONS, RAW, transform_fixtures
from streakline.schemas import EVENT_CATALOG, PLAYED_STATUS, Event
from streakline.session import stage, stored
from streakline.sources import buckets
from streakline.sources.snapshots import remove_old_versions, write_version
from streakline.sources.tables import source_table

RAW_ROWS, ROWS, LENGTHS, STATE = "inc/raw_fixtures", "inc/team_fixtures", "inc/team_lengths", "inc/team_state"
MART = "mart/mart_top_team_streaks"


def start(
    fixtures: DataFrame, root: str, stamp: str, n_buckets: int = buckets.BUCKETS, catalog: Sequence[Event] = EVENT_CATALOG
) -> None:
    """A full build of the three tables from enriched fixtures."""
    spark = fixtures.sparkSession
    sides = facts.unpivot_team_rows(stored(fixtures))
    ordinary = hot_keys(sides, TEAM_KEY).isEmpty()
    # Without a crowded team one shuffle, by bucket, serves both the next fixtures and the write.
    by = buckets.bucket_of(TEAM_KEY, n_buckets) if ordinary else None
    rows = buckets.write_buckets(facts.team_fixtures_of(sides, by), f"{root}/{ROWS}", TEAM_KEY, stamp, n_buckets, lying=ordinary)
    lengths = buckets.write_buckets(
        streak_state.team_lengths(rows.read(spark), catalog), f"{root}/{LENGTHS}", TEAM_KEY, stamp, n_buckets
    )
    buckets.write_buckets(streak_state.team_state(lengths.read(spark), catalog), f"{root}/{STATE}", TEAM_KEY, stamp, n_buckets)


def apply(fixtures: DataFrame, root: str, stamp: str, catalog: Sequence[Event] = EVENT_CATALOG) -> int:
    """Bring changed enriched fixtures, each once, into the three tables; returns how many team rows came.

    A repeated step of one stamp starts from the versions before it, as the first try did.
    """
    spark = fixtures.sparkSession
    feed = stage(facts.unpivot_team_rows(fixtures))
    n = feed.count()
    if n == 0:
        return 0
    state_map = buckets.read_map(spark, f"{root}/{STATE}", before=stamp)
    touched = state_map.touched(feed)

    def repaired(old: DataFrame, new: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        rewritten = stage(repair.next_repairs(old, new.select(*[c for c in old.columns if c in new.columns])))
        return merge.replace_parts(old, rewritten, repair.TEAM_ROW)

    rows = buckets.update_buckets(feed, f"{root}/{ROWS}", stamp, repaired, touched)

    names = [e.name for e in catalog]
    length_map = buckets.read_map(spark, f"{root}/{LENGTHS}", before=stamp)
    stored, state = length_map.read(spark, touched), state_map.read(spark, touched)
    again, added = streak_state.split_feed(
        feed, F.expr(streak_state.COUNTED), state, stored, TEAM_KEY, FIXTURE_ORDER, repair.TEAM_ROW
    )
    again = stage(again)
    more = stage(streak_state.more_team_lengths(added.join(again, TEAM_KEY, "left_anti"), state, catalog))
    afresh = rows.read(spark, touched).join(again, TEAM_KEY, "left_semi")
    recounted = stage(streak_state.team_lengths(afresh, catalog))

    # Buckets of recounted teams are written anew; the others only get their new rows beside them.
    rewrite = set(length_map.touched(again))
    if rewrite:
        length_map = buckets.update_buckets(
            again, f"{root}/{LENGTHS}", stamp,
            lambda old, teams: old.join(teams, TEAM_KEY, "left_anti").unionByName(recounted),
            rewrite,
        )
    buckets.publish(spark, buckets.append_to(length_map, more, stamp), stamp)

    def restated(old: DataFrame, _: DataFrame) -> DataFrame:
        grown = streak_state.merged_state(old, streak_state.team_state(more, catalog), TEAM_KEY, names)
        return grown.join(again, TEAM_KEY, "left_anti").unionByName(streak_state.team_state(recounted, catalog))

    buckets.update_buckets(feed, f"{root}/{STATE}", stamp, restated, touched)
    return n


def team_fixtures(spark: SparkSession, root: str) -> DataFrame:
    return buckets.read_buckets(spark, f"{root}/{ROWS}")


def team_streaks(spark: SparkSession, root: str, catalog: Sequence[Event] = EVENT_CATALOG) -> DataFrame:
    """The streak fact, one row per team, fixture and event."""
    rows = buckets.read_buckets(spark, f"{root}/{LENGTHS}")
    return facts.stack_events(rows, streak_state.KEPT, {"event_flag": "{}", "streak_length": "{}_length"}, catalog)


def current_streaks(spark: SparkSession, root: str, catalog: Sequence[Event] = EVENT_CATALOG) -> DataFrame:
    """Every team's run lengths at its latest fixture, from the states alone."""
    rows = buckets.read_buckets(spark, f"{root}/{STATE}")
    return facts.stack_events(rows, ["team_id", *streak_state.SHOWN], {"current_streak_length": "now_{}"}, catalog)


def numbered_streaks(spark: SparkSession, root: str) -> DataFrame:
    """The mart's rows, as ``marts.numbered_streaks`` gives them."""
    return marts.display_ids(marts.longer_than(current_streaks(spark, root))).select(*marts.MART_COLUMNS)


# --- Jobs over a warehouse folder ---------------------------------------------------------


def _enriched(spark: SparkSession, raw: DataFrame, root: str, as_of=None) -> DataFrame:
    source = lambda name: source_table(spark, root, name)
    context = dims.league_context(
        dims.stg_league_seasons(source("etl.dim_league_seasons"), as_of),
        dims.stg_leagues(source("etl.dim_leagues")),
        dims.stg_countries(source("etl.dim_countries")),
    )
    teams = dims.int_teams(dims.stg_teams(source("etl.dim_teams")))
    return facts.enrich_fixtures(clean.stg_fixtures(raw), context, teams)


def start_job(spark: SparkSession, root: str, stamp: str, as_of=None, n_buckets: int = buckets.BUCKETS) -> None:
    """The tables of this module from the raw table and the dimensions. ``as_of`` tells which season is current;
    when it moves to another season, start anew."""
    raw = source_table(spark, root, RAW)
    buckets.write_buckets(raw, f"{root}/{RAW_ROWS}", merge.FIXTURE_KEY, stamp, n_buckets)
    start(_enriched(spark, raw, root, as_of), root, stamp, n_buckets)


def bring_in(updates: DataFrame, root: str, stamp: str, as_of=None, now=None) -> int:
    """Typed feed rows into the raw table and on into the team tables; returns how many fixtures changed.

    Only fixtures that have now been played or were moved count, and of a fixture that is
    listed twice the finished record, then the later kickoff.
    """
    spark = updates.sparkSession
    known = buckets.read_map(spark, f"{root}/{RAW_ROWS}", before=stamp)
    feed = stored(updates)
    base = known.read(spark, known.touched(feed))
    listed = merge.only_known_ids(feed, stage(merge.changed_ids(base, feed)))
    finished = listed.withColumn("_finished", F.col("fixture_status") == PLAYED_STATUS)
    changed = stage(merge.keep_last_per_key([finished], merge.FIXTURE_KEY, FINISHED_LAST).select(*listed.columns))
    n = changed.count()
    if n == 0:
        return 0
    touched = known.touched(changed)
    raw = buckets.update_buckets(
        changed, f"{root}/{RAW_ROWS}", stamp, lambda old, new: merge.coalesce_parts(old, new, now=now), touched
    )
    rows = raw.read(spark, touched).join(changed.select(*merge.FIXTURE_KEY), merge.FIXTURE_KEY, "left_semi")
    apply(_enriched(spark, rows, root, as_of), root, stamp)
    return n


def update_job(
    spark: SparkSession, records: DataFrame, root: str, stamp: str, as_of=None, now=None, keep: int = KEEP_VERSIONS
) -> DataFrame:
    """Fetched updates to the mart, at a cost that follows the feed and the number of teams.

    All but the last ``keep`` versions are deleted.
    """
    bring_in(transform_fixtures(records), root, stamp, as_of, now)
    mart = write_version(numbered_streaks(spark, root), f"{root}/{MART}", stamp)
    tidy(spark, root, keep)
    return mart


def tidy(spark: SparkSession, root: str, keep: int = KEEP_VERSIONS) -> None:
    for name in (RAW_ROWS, ROWS, LENGTHS, STATE):
        buckets.remove_unused(spark, f"{root}/{name}", keep)
    remove_old_versions(spark, f"{root}/{MART}", keep)


def raw_fixtures(spark: SparkSession, root: str) -> DataFrame:
    return buckets.read_buckets(spark, f"{root}/{RAW_ROWS}")
