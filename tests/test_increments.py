from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from streakline.operators import repair, streak_state
from streakline.operators.facts import next_fixture
from streakline.operators.streaks import run_lengths
from streakline.plans import increments
from streakline.session import scratch_path, stage
from streakline.sources import buckets

KEYS, ORDER, NAMES = ["team"], ["at", "id"], ["a", "b"]


def flags():
    return {"a": F.col("x"), "b": F.col("y")}


def random_rows(seed: int, teams: int = 12) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for team in range(teams):
        for _ in range(rng.randint(0, 25)):
            rows.append((team, rng.randint(0, 30), len(rows), rng.choice([0, 1, 1, None]), rng.choice([0, 1])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "team int, at int, id int, x int, y int")


def lengths(df) -> dict:
    return {(r["team"], r["id"]): (r["a"], r["b"], r["a_length"], r["b_length"]) for r in df.collect()}


def step(rows, stored, state):
    """One feed of new rows: all stored lengths and the state after it, and how many keys were counted again."""
    again, added = streak_state.split_feed(rows, F.lit(True), state, stored, KEYS, ORDER, ["team", "id"])
    again = stage(again)
    more = stage(streak_state.extend(added, state, KEYS, ORDER, flags()))
    inputs = ["team", "at", "id", "x", "y"]
    whole = stored.select(*inputs).join(again, KEYS, "left_semi").unionByName(rows.select(*inputs).join(again, KEYS, "left_semi"))
    afresh = stage(streak_state.whole_lengths(whole, KEYS, ORDER, flags(), hot=False))
    kept = stored.join(again, KEYS, "left_anti")
    grown = streak_state.merged_state(state, streak_state.state_of(more, KEYS, ORDER, NAMES), KEYS, NAMES)
    new_state = grown.join(again, KEYS, "left_anti").unionByName(streak_state.state_of(afresh, KEYS, ORDER, NAMES))
    return stage(kept.unionByName(more).unionByName(afresh)), stage(new_state), again.count()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_gives_the_same_lengths(spark, seed):
    """Rows in feeds at random: later ones, backdated ones, ties in time, teams not seen before."""
    rows = random_rows(seed)
    rng = random.Random(seed)
    feeds = [[], [], []]
    for r in rows:
        # Mostly in order of time, so that some teams only play on.
        feeds[rng.randrange(3) if rng.random() < 0.05 else min(2, r[1] // 11)].append(r)
    stored = stage(streak_state.whole_lengths(frame(spark, feeds[0]), KEYS, ORDER, flags(), hot=False))
    state = stage(streak_state.state_of(stored, KEYS, ORDER, NAMES))
    recounted = 0
    for feed in feeds[1:]:
        stored, state, n = step(frame(spark, feed), stored, state)
        recounted += n
    want = run_lengths(frame(spark, rows), KEYS, ORDER, flags(), hot=False)
    assert lengths(stored) == lengths(want)
    assert 0 < recounted < 24
    # The state tells what is current.
    last = {}
    for r in sorted(want.collect(), key=lambda r: (r["at"], r["id"])):
        last[r["team"]] = (r["a_length"], r["b_length"])
    assert {r["team"]: (r["now_a"], r["now_b"]) for r in state.collect()} == last


def test_null_neither_starts_nor_ends_across_feeds(spark):
    first = frame(spark, [(1, 1, 1, None, 0), (1, 2, 2, 1, 0), (2, 1, 3, 1, None), (3, 1, 4, 0, 1)])
    state = streak_state.state_of(streak_state.whole_lengths(first, KEYS, ORDER, flags(), hot=False), KEYS, ORDER, NAMES)
    later = frame(spark, [(1, 3, 5, None, 1), (1, 4, 6, 1, 1), (2, 2, 7, None, 1), (2, 3, 8, 1, 1), (3, 2, 9, 1, None), (3, 3, 10, 1, 1)])
    got = lengths(streak_state.extend(later, state, KEYS, ORDER, flags()))
    every = lengths(run_lengths(first.unionByName(later), KEYS, ORDER, flags(), hot=False))
    assert got == {k: v for k, v in every.items() if k[1] >= 5}


def test_hot_teams_are_cut(spark):
    rows = frame(spark, random_rows(5, 3))
    cut = streak_state.whole_lengths(rows, KEYS, ORDER, flags(), hot=True)
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, streak_state.whole_lengths(rows, KEYS, ORDER, flags(), hot=False).select(*cut.columns).collect()), key=str)


# --- Next fixtures ----------------------------------------------------------------------


def matches(spark, rows):
    return spark.createDataFrame(rows, "fixture_id bigint, team_id bigint, opponent_id bigint, kickoff_utc timestamp_ntz, goals int")


def test_only_neighbours_are_rewritten(spark):
    import datetime as dt

    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    rows = [(f, team, 100 + f, day(f % 40), f) for team in (1, 2, 3) for f in range(1, 40)]
    stored = stage(next_fixture(matches(spark, rows), hot=False))
    # Moved next to fixture 30, corrected in place, and new.
    changed = [(10, 1, 110, day(30), 10), (20, 2, 120, day(20), 99), (77, 2, 177, day(5), 7), (78, 4, 1, day(1), 0)]
    repaired = stage(repair.next_repairs(stored, matches(spark, changed), hot=False))
    assert {(r["team_id"], r["fixture_id"]) for r in repaired.collect()} == {
        (1, 10), (1, 9), (1, 29), (2, 20), (2, 77), (2, 5), (4, 78),
    }
    keys = {(f, t) for f, t, *_ in changed}
    whole = next_fixture(matches(spark, [r for r in rows if (r[0], r[1]) not in keys] + changed), hot=False)
    merged = stored.join(repaired.select(*repair.TEAM_ROW), repair.TEAM_ROW, "left_anti").unionByName(repaired)
    assert sorted(map(tuple, merged.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


# --- The three tables together -----------------------------------------------------------


def test_a_feed_touches_only_its_teams_buckets(spark, sf):
    from checks.queries import enriched

    root = scratch_path(spark, "test-increments")
    fixtures = stage(enriched(spark, sf))
    feed = stage(fixtures.where("is_played and is_current").orderBy("kickoff_utc", "fixture_id").limit(1))
    increments.start(fixtures.join(feed.select("fixture_id"), "fixture_id", "left_anti"), root, "1", 64)
    before = {t: buckets.read_map(spark, f"{root}/{t}") for t in (increments.ROWS, increments.LENGTHS, increments.STATE)}
    for _ in range(2):  # a retry changes nothing
        assert increments.apply(feed, root, "2") == 2
    for name, old in before.items():
        new = buckets.read_map(spark, f"{root}/{name}")
        assert len([b for b in new.folders if new.folders[b] != old.folders.get(b)]) <= 2
    assert increments.apply(feed.where("false"), root, "3") == 0
    other = scratch_path(spark, "test-increments")
    increments.start(fixtures, other, "1", 8)
    for read in (increments.team_streaks, increments.team_fixtures, increments.current_streaks):
        assert read(spark, root).exceptAll(read(spark, other)).count() == 0
        assert read(spark, root).count() == read(spark, other).count()


def test_later_matches_are_appended_beside(spark, sf):
    from checks.queries import enriched

    root = scratch_path(spark, "test-increments")
    fixtures = stage(enriched(spark, sf))
    last = stage(fixtures.where("is_played and is_current").orderBy(F.desc("kickoff_utc"), F.desc("fixture_id")).limit(1))
    increments.start(fixtures.join(last.select("fixture_id"), "fixture_id", "left_anti"), root, "1", 64)
    old = buckets.read_map(spark, f"{root}/{increments.LENGTHS}")
    increments.apply(last, root, "2")
    new = buckets.read_map(spark, f"{root}/{increments.LENGTHS}")
    # No stored length is written again.
    assert all(set(old.folders[b]) <= set(new.folders[b]) for b in old.folders) and new.folders != old.folders
