import pytest

from streakline.operators import clean

DDL = (
    "n int, fixture_status string, home_team_fulltime_goal int, away_team_fulltime_goal int, "
    "home_team_halftime_goal int, away_team_halftime_goal int"
)
FULL = ["home_fulltime_result", "away_fulltime_result"]
HALF = ["home_halftime_result", "away_halftime_result"]


def frame(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DDL)


def values(df, columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("n").collect()]


@pytest.mark.parametrize(
    "status, home, away, expected",
    [
        ("WO", 3, 0, ("win", "loss")),
        ("WO", 0, 3, ("loss", "win")),
        ("WO", 1, 1, ("draw", "draw")),
        ("AWD", 2, 2, ("draw", "draw")),
        ("awd", 2, 1, ("win", "loss")),
        ("FT", 2, 1, (None, None)),
    ],
)
def test_special_results(spark, status, home, away, expected):
    assert values(clean.special_results(frame(spark, (status, home, away, None, None))), FULL) == [expected]


def test_game_results(spark):
    done = clean.game_results(frame(spark, ("FT", 2, 1, 1, 1), ("ft", 0, 1, 0, 0), ("WO", 3, 0, None, None)))
    assert values(done, FULL + HALF) == [
        ("win", "loss", "draw", "draw"),
        ("loss", "win", "draw", "draw"),
        (None, None, None, None),
    ]


def test_compute_results_mixed(spark):
    done = clean.compute_results(
        frame(
            spark,
            ("FT", 2, 0, 1, 0),
            ("WO", 3, 0, None, None),
            ("AB", 1, 1, 0, 0),
            ("FT", None, None, None, None),
            ("FT", 2, None, 1, None),
            (None, 1, 0, 1, 0),
        )
    )
    none = (None,) * 4
    assert values(done, FULL + HALF) == [
        ("win", "loss", "win", "loss"),
        ("win", "loss", None, None),
        none,
        none,
        none,
        none,
    ]


def test_results_are_recomputed_not_kept(spark):
    stale = frame(spark, ("NS", 1, 0, None, None)).selectExpr("*", "'win' as home_fulltime_result")
    assert values(clean.compute_results(stale), ["home_fulltime_result"]) == [(None,)]


def test_special_then_game_results_equals_compute_results(spark):
    rows = frame(spark, ("FT", 2, 0, 1, 0), ("WO", 3, 0, None, None), ("ABD", 1, 1, 0, 0))
    two_steps = clean.game_results(clean.special_results(rows))
    assert values(two_steps, FULL + HALF) == values(clean.compute_results(rows), FULL + HALF)


def test_upcoming_and_counts(spark):
    done = clean.compute_results(frame(spark, ("FT", 2, 0, 1, 0), ("NS", None, None, None, None)))
    assert clean.upcoming_fixtures(done).count() == 1
    assert tuple(clean.step_counts(done).first()) == (2, 1)


def test_played_is_case_sensitive(spark):
    staged = clean.stg_fixtures(frame(spark, ("FT", 1, 0, 0, 0), ("ft", 1, 0, 0, 0), ("WO", 1, 0, 0, 0), (None, 1, 0, 0, 0)))
    assert values(staged, ["is_played"]) == [(True,), (False,), (False,), (False,)]
