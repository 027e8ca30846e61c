import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from streakline.operators.standings import team_running_table

DDL = (
    "fixture_id bigint, date date, kickoff_utc timestamp_ntz, season int, league_id bigint, country string, league string, "
    "team_id bigint, team_name string, opponent_id bigint, opponent_name string, result string, goals_scored int, goals_conceded int"
)


def matches(seed, n=160):
    """Six teams, one of them in most rows; same-day matches and unknown goals occur."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        team = 1 if rng.random() < 0.5 else rng.randint(2, 6)
        goals = (rng.randint(0, 4), rng.randint(0, 4)) if rng.random() < 0.9 else (None, None)
        result = None if goals[0] is None else "win" if goals[0] > goals[1] else "loss" if goals[0] < goals[1] else "draw"
        out.append(
            (i, date(2024, 1, 1) + timedelta(days=rng.randint(0, 40)), None, 2024, rng.randint(1, 2), "C", "L",
             team, f"t{team}", 9, "o", result, *goals)
        )
    return out


def half_up(total, count):
    return None if not count else ((200 * total + count) // (2 * count)) / 100


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[4], r[3], r[7])].append(r)
    out, tables = {}, defaultdict(set)
    for key, own in groups.items():
        when = lambda r: r[1] or date.min  # noqa: E731  no date comes first
        own.sort(key=lambda r: (when(r), r[0]))
        for day, r in enumerate(own, 1):
            seen = [s for s in own if when(s) <= when(r)]
            games = len(seen)
            wins, losses, draws = (sum(s[11] == x for s in seen) for x in ("win", "loss", "draw"))
            known = [s for s in seen if s[12] is not None]
            gf, ga = (sum(s[c] for s in known) if known else None for c in (12, 13))
            w, l, d = half_up(wins, games), half_up(losses, games), half_up(draws, games)
            points = 3 * wins + draws
            score = (points, round(w * 100) + round(d * 100))
            tables[(key[0], key[1], day)].add(score)
            out[(r[0], key[2])] = (
                day, games, wins, losses, draws, gf, ga, w, l, d,
                half_up(gf, len(known)), half_up(ga, len(known)), points, (key[0], key[1], day), score,
            )
    return {
        k: (*v[:13], 1 + sum(s > v[14] for s in tables[v[13]])) for k, v in out.items()
    }


COLUMNS = [
    "matchday", "games_played", "wins", "losses", "draws", "goals_for", "goals_against", "rolling_win_rate",
    "rolling_loss_rate", "rolling_draw_rate", "rolling_avg_goals_for", "rolling_avg_goals_against", "rolling_points", "position",
]


def with_nulls(rows):
    """Some matches without a date, a season or a league."""
    blank = {1: 7, 3: 11, 4: 13}
    return [tuple(None if n in blank and i % blank[n] == 0 else v for n, v in enumerate(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("chunk_rows", [10, 4_000_000])
@pytest.mark.parametrize("rows", [matches(3), with_nulls(matches(5))])
def test_against_brute_force(spark, rows, chunk_rows):
    df = team_running_table(spark.createDataFrame(rows, DDL), chunk_rows=chunk_rows)
    got = {(r.fixture_id, r.team_id): tuple(r[c] for c in COLUMNS) for r in df.collect()}
    assert got == brute(rows)


def test_no_rows(spark):
    assert team_running_table(spark.createDataFrame([], DDL)).collect() == []


def test_many_small_chunks_share_the_tasks_of_a_shuffle(spark, monkeypatch):
    """Chunks of two rows, exactly that long, through no more range partitions than a shuffle has."""
    from streakline.functions import ordered

    asked = []
    ranged = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, n, *by: asked.append(n) or ranged(df, n, *by))
    df = spark.range(0, 200).selectExpr("id", "id % 3 as k", "pmod(id * 7919, 200) as at")
    pieces = ordered.cut(df, ["k"], ["at"], 100, 2).collect()
    assert asked == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    sizes = defaultdict(list)
    for r in pieces:
        sizes[r[ordered.CHUNK]].append((r["k"], r["at"]))
    assert max(map(len, sizes.values())) == 2 and len(pieces) == 200
    placed = [r for chunk in sorted(sizes) for r in sorted(sizes[chunk])]
    assert placed == sorted(placed)
