"""Marks with a ledger, digests of snapshots, ledgers of files, the serving layout."""

from __future__ import annotations

import json
import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from streakline.operators import digests, marks, merge
from streakline.plans import serving
from streakline.session import scratch_path, stage
from streakline.sources import fixture_files, ledger
from tests.test_plans import plan
from tests.test_sources import put, record

START = datetime(2024, 1, 1)
SOURCE = "api_fixture_id bigint, updated_at timestamp_ntz, status string"


def test_rows_of_the_marks_own_stamp_arrive_once_in_any_order(spark):
    rng = random.Random(2)
    rows = [(i, START + timedelta(hours=rng.randint(0, 60)), f"s{i}") for i in range(60)] + [(99, None, "no stamp")]
    for seed in range(2):
        order = random.Random(seed).sample(rows, len(rows))
        listed = marks.empty_ledger(spark.createDataFrame(rows, SOURCE), ["api_fixture_id"])
        taken = []
        # Every run sees what has come so far, in an order that has nothing to do with the stamps.
        for n in (20, 20, 45, 61):
            seen = spark.createDataFrame(order[:n], SOURCE)
            new = stage(marks.not_taken(seen, listed, ["api_fixture_id"], look_back="INTERVAL 3 DAYS"))
            listed = stage(marks.grown_ledger(listed, new, ["api_fixture_id"], look_back="INTERVAL 3 DAYS"))
            taken += [r["api_fixture_id"] for r in new.collect()]
        assert sorted(taken) == sorted(r[0] for r in rows)


def test_ledger_forgets_and_updates_come_again(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), SOURCE)
    old, late = frame((1, START, "a"), (2, START, "b")), START + timedelta(days=10)
    target, listed = marks.append_marked(old.limit(0), old, marks.empty_ledger(old, ["api_fixture_id"]), ["api_fixture_id"])
    new = frame((1, START, "a"), (2, late, "B"), (3, late, "c"))
    target, listed = marks.append_marked(stage(target), new, stage(listed), ["api_fixture_id"])
    assert sorted(map(tuple, target.select("api_fixture_id", "status").collect())) == [(1, "a"), (2, "B"), (3, "c")]
    # Rows from before the look-back are no longer listed, nor taken again.
    assert {r["api_fixture_id"] for r in listed.collect()} == {2, 3}
    assert marks.not_taken(new, stage(listed), ["api_fixture_id"]).collect() == []


SNAPSHOT = "api_fixture_id bigint, api_league_id bigint, season int, fixture_status string, kickoff_utc timestamp_ntz"


def snapshot(spark, change=lambda r: r):
    rows = [change([i, i % 5 if i % 7 else None, 2020 + i % 3, "NS" if i % 2 else "FT", START]) for i in range(120)]
    return spark.createDataFrame([tuple(r) for r in rows], SNAPSHOT)


def test_only_groups_that_differ_are_joined(spark):
    def change(r):
        if r[0] == 31:
            r[3] = "FT"
        if r[0] == 46:
            r[4] = None
        return r

    base, other = stage(snapshot(spark)), stage(snapshot(spark, change))
    groups = digests.differing_groups(base, other, digests.GROUPS, digests.STATUS)
    assert groups.count() == 1  # league 1, season 2021: both changes lie there
    left = digests.in_groups(base, digests.GROUPS, groups)
    assert {(r["api_league_id"], r["season"]) for r in left.collect()} == {(1, 2021)}
    got = digests.changed_ids_by_digest(base, other)
    assert {r[0] for r in got.collect()} == {31, 46} == {r[0] for r in merge.changed_ids(base, other).collect()}
    # Rows meet the list of groups before they meet each other.
    assert len(re.findall("LeftSemi", plan(got))) >= 2
    assert digests.changed_ids_by_digest(base, base).collect() == []


def test_null_groups_rows_moved_and_missing(spark):
    base = stage(snapshot(spark))
    less = stage(base.where("api_fixture_id <> 14"))
    groups = digests.differing_groups(base, less, digests.GROUPS, digests.STATUS)
    assert groups.count() == 1 and {r["api_league_id"] for r in digests.in_groups(base, digests.GROUPS, groups).collect()} == {None}
    assert digests.changed_ids_by_digest(base, less).collect() == []
    swapped = base.withColumn("kickoff_utc", F.when(F.col("api_fixture_id") == 1, None).otherwise(F.col("kickoff_utc")))
    assert {r[0] for r in digests.changed_ids_by_digest(base, stage(swapped)).collect()} == {1}
    none = base.limit(0)
    assert digests.changed_ids_by_digest(none, none).collect() == []


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    folder, book = tmp_path / "in", str(tmp_path / "ledger")
    lines = lambda *ids: "\n".join(json.dumps(record(i)) for i in ids)
    put(folder, lines(1, 2), "a.json")
    put(folder / "deep", lines(3), "b.json")
    seen = []

    def run(stamp):
        got = []
        store = lambda df: got.extend(int(r["api_fixture_id"]) for r in df.collect())
        n = ledger.intake(spark, str(folder), book, stamp, lambda paths: fixture_files.read_lines(spark, paths), store)
        seen.append((n, sorted(got)))

    run("1")
    run("2")
    put(folder, lines(1, 2, 7), "a.json")
    put(folder, lines(8), "c.json")
    run("3")
    run("4")
    # A retry reads what its first try read.
    run("3")
    assert seen == [(2, [1, 2, 3]), (0, []), (2, [1, 2, 7, 8]), (0, []), (2, [1, 2, 7, 8])]


def streaks(spark, n=300):
    rng = random.Random(4)
    kinds = ["goal_streaks", "result_streaks"]
    rows = [(i, "L", rng.choice(["A", "B", "Ü", None]) if i % 3 else f"team {i % 17}", "win", rng.choice(kinds), rng.randint(3, 9)) for i in range(n)]
    return spark.createDataFrame(
        rows, "streak_id bigint, league_name string, team_name string, event_name string, streak_type string, current_streak_length bigint"
    )


def test_reads_by_type_and_team_skip_files(spark):
    root = scratch_path(spark, "served")
    serving.write_served(streaks(spark), root, "1", files=4)
    text = plan(serving.served(spark, root, "goal_streaks", "team 3"))
    assert re.search(r"PartitionFilters: \[[^\]]*streak_type[^\]]*goal_streaks", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(team_name,team 3\)", text)
    got = {r["streak_id"] for r in serving.served(spark, root, "goal_streaks", "team 3").collect()}
    want = {r["streak_id"] for r in streaks(spark).where("streak_type = 'goal_streaks' and team_name = 'team 3'").collect()}
    assert got == want and want


def test_pages_join_to_the_whole_list(spark):
    root = scratch_path(spark, "served")
    rows = serving.write_served(streaks(spark, 70), root, "1")
    whole = [r["streak_id"] for r in rows.orderBy(F.desc("current_streak_length"), "team_name", "streak_id").collect()]
    found, last = [], None
    while part := serving.page(rows, 16, last).collect():
        found += [r["streak_id"] for r in part]
        last = part[-1]
    assert found == whole and len(whole) == 70
