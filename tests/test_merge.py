from datetime import datetime

import pytest

from streakline.operators import merge

OLD, NOW = datetime(2024, 1, 1), datetime(2024, 2, 1)
FIXTURE = "api_fixture_id bigint, fixture_status string, kickoff_utc timestamp_ntz"
K1, K2 = datetime(2024, 5, 1, 15), datetime(2024, 5, 2, 15)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_changed_ids(spark):
    base = spark.createDataFrame(
        [(1, "NS", K1), (2, "NS", K1), (3, "FT", K1), (4, None, K1), (5, "NS", None), (6, "NS", K1), (7, "NS", K1), (9, "NS", K1)],
        FIXTURE,
    )
    updates = spark.createDataFrame(
        [(1, "FT", K1), (2, "NS", K2), (3, "FT", K1), (4, "FT", K1), (5, "NS", None), (6, "NS", K1), (7, "ft", K1), (8, "FT", K1), (9, "FT", K2)],
        FIXTURE,
    )
    assert rows(merge.changed_ids(base, updates), "api_fixture_id") == [(1,), (2,), (4,), (5,), (9,)]
    assert rows(merge.change_counts(base, updates)) == [(3, 3)]
    assert 8 not in [r[0] for r in rows(merge.diff_join(base, updates), "api_fixture_id")]


def test_coalesce_update(spark):
    target = spark.createDataFrame(
        [(1, "NS", None, "keep", OLD), (2, "NS", 5, "keep", OLD), (3, "NS", None, None, OLD)],
        "api_fixture_id bigint, fixture_status string, goals int, note string, updated_at timestamp_ntz",
    )
    source = spark.createDataFrame(
        [(1, "FT", 2, 7), (2, "FT", None, 7), (9, "FT", 1, 7)],
        "api_fixture_id bigint, fixture_status string, goals int, unknown_column int",
    )
    done = merge.coalesce_update(target, source, now=NOW)
    assert done.columns == target.columns
    assert rows(done, "api_fixture_id") == [(1, "FT", 2, "keep", NOW), (2, "FT", 5, "keep", NOW), (3, "NS", None, None, OLD)]
    with pytest.raises(ValueError, match="api_fixture_id"):
        merge.coalesce_update(target, source.drop("api_fixture_id"))
    assert merge.coalesce_update(target, source.select("api_fixture_id", "unknown_column")) is target


def test_coalesce_update_with_repeats(spark):
    target = spark.createDataFrame([(1, "NS")], "api_fixture_id bigint, fixture_status string")
    source = spark.createDataFrame([(1, "1H", 1), (1, "FT", 3), (1, "HT", 2)], "api_fixture_id bigint, fixture_status string, seq int")
    assert rows(merge.coalesce_update(target, source, order=["seq"])) == [(1, "FT")]


def test_insert_or_ignore(spark):
    target = spark.createDataFrame([(4, "Spain", OLD)], "country_id bigint, country_name string, created_at timestamp_ntz")
    source = spark.createDataFrame([("Spain",), ("Italy",), ("Italy",), ("England",)], "country_name string")
    done = merge.insert_or_ignore(target, source, ["country_name"], "country_id", NOW)
    assert rows(done, "country_id") == [(4, "Spain", OLD), (5, "England", NOW), (6, "Italy", NOW)]
    empty = merge.insert_or_ignore(target.limit(0), source, ["country_name"], "country_id", NOW)
    assert [r[:2] for r in rows(empty, "country_id")] == [(1, "England"), (2, "Italy"), (3, "Spain")]


LEAGUE = "league_id bigint, api_league_id bigint, league_name string, country_id bigint, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_conditional_upsert(spark):
    target = spark.createDataFrame(
        [(1, 10, "A", 1, OLD, OLD), (2, 20, "B", 1, OLD, OLD), (3, 30, None, 1, OLD, OLD), (4, 40, "D", None, OLD, OLD)], LEAGUE
    )
    source = spark.createDataFrame(
        [(10, "A", 1), (20, "B2", 1), (30, "C", 1), (40, "D", 2), (1234, "TestLeague", 10)],
        "api_league_id bigint, league_name string, country_id bigint",
    )
    args = (target, source, ["api_league_id"], "league_id", ["league_name", "country_id"])
    done = merge.conditional_upsert(*args, now=NOW)
    assert rows(done, "league_id") == [
        (1, 10, "A", 1, OLD, OLD),
        (2, 20, "B2", 1, OLD, NOW),
        (3, 30, None, 1, OLD, OLD),
        (4, 40, "D", None, OLD, OLD),
        (5, 1234, "TestLeague", 10, NOW, NOW),
    ]
    untouched = merge.conditional_upsert(*args, now=NOW, touch=False)
    assert rows(untouched, "league_id")[1] == (2, 20, "B2", 1, OLD, OLD)
    safe = merge.conditional_upsert(*args, now=NOW, null_safe=True)
    assert [r[2:4] for r in rows(safe, "league_id")][2:4] == [("C", 1), ("D", 2)]


def test_upsert_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, 10, "A", 1, OLD, OLD)], LEAGUE)
    source = spark.createDataFrame(
        [(10, "B", 1, 1), (10, "C", 1, 2), (20, "X", 1, 2), (20, "Y", 1, 1)],
        "api_league_id bigint, league_name string, country_id bigint, seq int",
    )
    done = merge.conditional_upsert(
        target, source, ["api_league_id"], "league_id", ["league_name", "country_id"], now=NOW, order=["seq"]
    )
    assert [r[:3] for r in rows(done, "league_id")] == [(1, 10, "C"), (2, 20, "X")]


def test_keep_last_and_replace(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None, 1), (3, "c", 1)], "k int, v string, extra int")
    assert rows(merge.keep_last_per_key([old, new], ["k"]), "k") == [(1, "a", None), (2, None, 1), (3, "c", 1)]
    assert rows(merge.replace_by_key(old, new.drop("extra"), ["k"]), "k") == [(1, "a"), (2, None), (3, "c")]


def test_high_water_mark(spark):
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, m int")
    target = spark.createDataFrame([(1, 10), (2, 20)], "k int, m int").selectExpr("k", "m")
    assert rows(merge.rows_after(source, target, "m")) == [(3, 30)]
    assert merge.rows_after(source, target.limit(0), "m").count() == 3
    changed = spark.createDataFrame([(1, 15), (2, 25), (4, 30)], "k int, m int")
    assert rows(merge.incremental_append(target, changed, ["k"], "m"), "k") == [(1, 10), (2, 25), (4, 30)]


def test_mark_bootstrap_done(spark):
    seasons = spark.createDataFrame([(1, False), (2, True), (3, False)], "league_season_id bigint, fixtures_bootstrap_done boolean")
    done = spark.createDataFrame([(1,), (1,)], "league_season_id bigint")
    got = merge.mark_bootstrap_done(seasons, done, NOW)
    assert rows(got, "league_season_id") == [(1, True, NOW), (2, True, None), (3, False, None)]


def test_union_and_concat(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(merge.union_ids(a, b), "k") == [(1,), (2,), (3,)]
    assert merge.concat_frames(a, b, b.selectExpr("k", "1 as x")).columns == ["k", "x"]
