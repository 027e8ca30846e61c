"""Updates of tables in buckets move what they change; rows that stay are written as they lie."""

import random

import pytest

from streakline.operators import facts, key_bits, merge, repair
from streakline.operators.merge import FIXTURE_KEY
from streakline.plans import increments
from streakline.session import stage
from streakline.sources import buckets, fixture_files
from streakline.streaming import updates
from tests.test_disk import plan, rows
from tests.test_sources import record
from tests.test_stream_held import typed


@pytest.fixture
def by_bitmaps(monkeypatch):
    """Keys count as many, their bitmaps as small."""
    monkeypatch.setattr(key_bits, "is_small", lambda df: "_bits" in df.columns)


@pytest.fixture
def plans(monkeypatch):
    """The plans of what is written into buckets, by table."""
    seen, write = [], buckets.write_packed

    def watched(df, path, *by):
        seen.append((path, plan(df)))
        write(df, path, *by)

    monkeypatch.setattr(buckets, "write_packed", watched)
    return lambda name: [text for path, text in seen if f"/{name}/" in path]


def test_rows_that_stay_are_written_as_they_lie(spark, tmp_path, by_bitmaps, plans, monkeypatch):
    table = spark.range(500).selectExpr("id as api_fixture_id", "cast(id as int) as goals")
    feed = stage(spark.range(0, 500, 9).selectExpr("id as api_fixture_id", "-1 as goals"))
    root = str(tmp_path / "rows")
    buckets.write_buckets(table, root, FIXTURE_KEY, "1", 4)
    made = buckets.update_buckets(feed, root, "2", merge.coalesce_parts)
    lying, _ = plans("rows")[-1].split("Exchange", 1)
    assert "Union" in lying and "FileScan" in lying
    expected = [(i, -1 if i % 9 == 0 else i) for i in range(500)]
    assert rows(made.read(spark)) == sorted(expected, key=str)
    # Once buckets have many files all of their rows are gathered.
    monkeypatch.setattr(buckets, "FILES_PER_BUCKET", 0)
    again = buckets.update_buckets(feed, root, "3", merge.coalesce_parts)
    assert "FileScan" not in plans("rows")[-1].split("Exchange", 1)[0]
    assert rows(again.read(spark)) == sorted(expected, key=str) and len(again.read(spark).inputFiles()) <= 4


def team_rows(spark, some):
    ddl = "fixture_id bigint, league_season_id bigint, league_name string, season int, kickoff_utc timestamp_ntz, home_team_id bigint, " \
        "away_team_id bigint, home_team_name string, away_team_name string, home_ftg int, away_ftg int, home_htg int, away_htg int, " \
        "home_ftr string, away_ftr string, home_htr string, away_htr string, updated_at timestamp_ntz, is_played boolean, is_current boolean"
    cells = [f"({i}L, 1L, 'x', 2024, timestamp_ntz '2024-01-{d:02d} 12:00:00', {h}L, {a}L, 'h', 'a', 1, 0, 0, 0, 'win', 'loss', 'draw', 'draw', "
             f"timestamp_ntz '2024-02-01 00:00:00', true, true)" for i, d, h, a in some]  # fmt: skip
    return stage(spark.sql(f"select * from values {', '.join(cells)} as t({', '.join(c.split()[0] for c in ddl.split(', '))})"))


def test_team_rows_are_shuffled_once_by_bucket(spark, tmp_path, plans):
    rng = random.Random(3)
    some = [(i, rng.randint(1, 9), *rng.sample(range(6), 2)) for i in range(60)]
    fixtures, root = team_rows(spark, some), str(tmp_path / "w")
    increments.start(fixtures, root, "1", 4)
    (text,) = plans("team_fixtures")
    assert text.count("Exchange") == 1
    assert rows(increments.team_fixtures(spark, root)) == rows(facts.team_fixtures(fixtures))


def test_repairs_join_whole_rows_of_changed_fixtures_only(spark, tmp_path, by_bitmaps, plans):
    rng = random.Random(4)
    some = [(i, rng.randint(1, 9), *rng.sample(range(6), 2)) for i in range(60)]
    later = [(i, 10 if i % 9 == 0 else d, h, a) for i, d, h, a in some] + [(70, 3, 1, 2)]
    fixtures, root = team_rows(spark, some), str(tmp_path / "w")
    increments.start(fixtures, root, "1", 4)
    increments.apply(team_rows(spark, [r for r in later if r not in some]), root, "2")
    assert rows(increments.team_fixtures(spark, root)) == rows(facts.team_fixtures(team_rows(spark, later)))
    # Rows of other fixtures are written as they lie.
    assert "FileScan" in plans("team_fixtures")[-1].split("Exchange", 1)[0]
    stored_rows = stage(facts.team_fixtures(fixtures))
    changed = stage(facts.unpivot_team_rows(team_rows(spark, [(9, 2, some[9][2], some[9][3])])))
    changed = changed.select(*[c for c in stored_rows.columns if c in changed.columns])
    assert rows(repair.next_repairs(stored_rows, changed)) == rows(repair.next_repairs(stored_rows, changed, hot=True))


def test_records_may_be_gzipped(spark, tmp_path):
    some = spark.createDataFrame([(str(i), "FT") for i in range(5)], "api_fixture_id string, fixture_status string")
    fixture_files.write_records(some, str(tmp_path / "in"), compression="gzip")
    assert list((tmp_path / "in").glob("*.json.gz")) and not list((tmp_path / "in").glob("*.json"))
    read = fixture_files.read_lines(spark, [str(tmp_path / "in")])
    assert rows(read.select("api_fixture_id", "fixture_status")) == rows(some)


def test_judged_records_are_held_without_another_shuffle(spark, tmp_path, plans):
    folder = str(tmp_path / "held")
    first = typed(spark, tmp_path / "in", [record(i, "NS", None, None) for i in range(40)], "a.json")
    second = typed(spark, tmp_path / "in", [record(i, "FT", 1, 0) for i in range(30, 50)], "b.json")
    for nth, feed in enumerate((first, second)):
        updates.judge_batch(feed, folder, f"s-{nth}", 4)
    assert len(plans("held")) == 2 and not any("Exchange hashpartitioning" in p or "REBALANCE" in p for p in plans("held"))
    held = [(r["api_fixture_id"], r["fixture_status"]) for r in buckets.read_buckets(spark, folder).collect()]
    assert sorted(held) == [(i, "NS" if i < 30 else "FT") for i in range(50)]
