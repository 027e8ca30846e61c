import random

import pytest

from streakline.operators.merge import FIXTURE_KEY
from streakline.plans.jobs import transform_fixtures
from streakline.plans import increments
from streakline.sources import buckets, fixture_files
from streakline.streaming import updates
from tests.test_sources import put, record
from tests.test_streaming import lines


def place(r):
    cells = [r["fixture_status"] == "FT", r["kickoff_utc"], *[v for c, v in r.items() if c not in ("api_fixture_id", "kickoff_utc")]]
    return [(c is not None, 0 if c is None else c) for c in cells]


def typed(spark, folder, records, name):
    put(folder, records, name)
    return transform_fixtures(fixture_files.scan_update_file(spark, str(folder / name)))


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_held_records_are_those_that_count(spark, tmp_path, seed):
    """Random records in three feeds, the last run twice: bests, late records and what is held, against brute force."""
    rng = random.Random(seed)
    some = [
        record(rng.choice([None, *range(4)]), *rng.choice([("FT", 1, 0), ("FT", 2, None), ("NS", None, None), ("PST", None, None), (None, 3, None)]),
               kickoff=rng.choice([None, *[f"2024-0{m}-01T12:00:00Z" for m in range(1, 4)]]))
        for _ in range(30)
    ]
    folder, so_far, bests = str(tmp_path / "held"), [], {}
    for nth in range(3):
        feed = typed(spark, tmp_path / "in", some[nth * 10 : nth * 10 + 10], f"{nth}.json")
        judged = [updates.judge_batch(feed, folder, f"stream-{nth}", 4).collect() for _ in range(1 + nth // 2)][-1]
        came = [r.asDict() for r in feed.collect() if r["api_fixture_id"] is not None]
        so_far += came
        late, held = [], []
        for i in {r["api_fixture_id"] for r in so_far}:
            rows = [r for r in so_far if r["api_fixture_id"] == i]
            top = {c: max((r for r in rows if r[c] is not None), key=place, default=None) for c in rows[0] if c != "api_fixture_id"}
            best = {"api_fixture_id": i, **{c: r and r[c] for c, r in top.items()}}
            telling = [max(rows, key=place)]
            telling += [r for r in top.values() if r]
            telling = [r for nth_, r in enumerate(telling) if r not in telling[:nth_]]
            held += telling
            late += [r for r in came if r["api_fixture_id"] == i and r not in telling and r != best]
            got = [r for r in judged if r["api_fixture_id"] == i and r["best"] is not None]
            assert len(got) == any(r["api_fixture_id"] == i for r in came)
            if got:
                assert got[0]["best"].asDict() == {c: v for c, v in best.items() if c != "api_fixture_id"}
                assert got[0]["changed"] == (bests.get(i) != best)
                bests[i] = best
        names = feed.columns
        assert ordered({c: r[c] for c in names} for r in judged if r["late"]) == ordered(late)
        assert ordered(r.asDict() for r in buckets.read_buckets(spark, folder).collect()) == ordered(held)


@pytest.mark.parametrize("keep_late", [False, True])
def test_stream_keeps_no_state_in_memory(spark, tmp_path, monkeypatch, keep_late):
    """What a fixture's best is made of lies in buckets, not in executors' state stores or Python groups."""
    root, brought = str(tmp_path / "w"), []
    raw = typed(spark, tmp_path / "in", [record(1), record(2)], "raw.json")
    buckets.write_buckets(raw, f"{root}/{increments.RAW_ROWS}", FIXTURE_KEY, "20240101_000000", 4)
    monkeypatch.setattr(increments, "bring_in", lambda updates, *_: brought.append(updates.collect()))
    for name, records in (("a", [record(1, "FT", 2, 1)]), ("b", [record(1, "NS", None, None), record(2, "FT", 0, 0)])):
        put(tmp_path / "incoming", lines(*records), f"{name}.json")
        stream = updates.stream_increments(spark, str(tmp_path / "incoming"), root, str(tmp_path / "progress"), keep_late=keep_late)
        stream.awaitTermination()
        assert all(not p["stateOperators"] for p in stream.recentProgress)
    assert [sorted(r["api_fixture_id"] for r in rows) for rows in brought] == [[1], [2] if keep_late else [1, 2]]
    assert all(r["home_team_fulltime_goal"] == 2 for rows in brought for r in rows if r["api_fixture_id"] == 1)
    (held,) = (tmp_path / "w" / updates.HELD).iterdir()
    assert buckets.read_buckets(spark, str(held)).count() == 2
    if keep_late:
        assert [(r["api_fixture_id"], r["fixture_status"]) for r in updates.late_records(spark, root).collect()] == [(1, "NS")]
