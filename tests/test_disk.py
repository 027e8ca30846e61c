"""What writes and updates leave on disk: packed tables, no shuffle files, and no shuffle of rows that stay."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from streakline.operators import key_bits, merge, standings
from streakline.session import is_unshuffled, stage, stored
from streakline.sources import buckets, snapshots

DDL = "k int, n bigint, v string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def by_bitmaps(monkeypatch):
    """Keys count as many, their bitmaps as small."""
    monkeypatch.setattr(key_bits, "is_small", lambda df: "_bits" in df.columns)


def shuffle_files(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_writes_are_packed_and_leave_no_shuffle_files(spark, tmp_path):
    spark.sparkContext._jvm.System.gc()
    before = shuffle_files(spark)
    shuffled = spark.range(1000).selectExpr("id", "id % 7 as k").repartition(5, "k")
    staged = stage(shuffled)
    kept = snapshots.write_version(shuffled, str(tmp_path / "t"), "1")
    made = buckets.write_buckets(shuffled, str(tmp_path / "b"), ["k"], "1", 4).read(spark)
    assert shuffle_files(spark) <= before
    for df in (staged, kept, made):
        assert df.count() == 1000
        found = pq.ParquetFile(df.inputFiles()[0].removeprefix("file://")).metadata
        assert found.row_group(0).column(0).compression == "ZSTD"


def test_rows_that_come_unshuffled_are_not_stored(spark):
    some = stage(spark.range(9).selectExpr("id", "id * 2 as v"))
    assert stored(lists := some.selectExpr("explode(array(id, v)) as x")) is lists
    beside = some.unionByName(some.join(F.broadcast(some.select("id")), "id", "left_anti"))
    assert is_unshuffled(beside) and not is_unshuffled(some.join(some.select("id"), "id")) and not is_unshuffled(some.distinct())


@pytest.mark.parametrize("seed", [1, 2])
def test_parts_by_bitmaps(spark, by_bitmaps, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, rng.randint(-70_000, 70_000), rng.randint(-9, 9)])
    target, source = ([(key(), key(), str(i)) for i in range(300)] for _ in range(2))
    source += target[:60]
    a, b = (stage(spark.createDataFrame(some, DDL)) for some in (target, source))
    inside, outside, exact = key_bits.parted(a, b, ["k"])
    listed = {k for k, *_ in source} - {None}
    assert exact and rows(inside) == sorted((r for r in target if r[0] in listed), key=str)
    assert rows(outside) == sorted((r for r in target if r[0] not in listed), key=str)
    assert "Exchange hashpartitioning" not in plan(inside) + plan(outside)
    assert not key_bits.parted(a, b, ["k", "n"]).exact and key_bits.parted(a, b, ["v"]) is None
    assert key_bits.parted(a.distinct(), b, ["k"]) is None


@pytest.mark.parametrize("keys", [["k"], ["k", "n"], ["n"]])
def test_updates_by_bitmaps_are_those_by_joins(spark, by_bitmaps, keys):
    """Repeated keys and NULL ones, on both sides; rows that are not stored take the plain join."""
    some = [(1, 1, "a"), (1, 1, "a2"), (1, 2, "b"), (-5, 1, "e"), (0, 0, None), (None, 1, "c"), (3, None, "d"), (40_000, 7, "f")]
    other = [(1, 1, "A"), (1, 1, "A2"), (0, 0, "Z"), (None, 1, "C"), (3, None, "D"), (40_001, 8, "G")]
    plain = [spark.createDataFrame(r, DDL) for r in (some, other)]
    kept = [stage(df) for df in plain]
    for change in (merge.replace_by_key, merge.coalesce_update, merge.without):
        assert rows(change(*kept, keys)) == rows(change(*plain, keys))
        assert change(*kept, keys).schema.simpleString() == change(*plain, keys).schema.simpleString()
    assert rows(merge.replace_by_key(kept[0], kept[1].limit(0), keys)) == rows(plain[0].select(*keys, *[c for c in "knv" if c not in keys]))


def test_only_new_rows_are_joined_to_a_growing_table(spark, by_bitmaps):
    old = stage(spark.range(100).selectExpr("id as k", "id as at"))
    new = stage(spark.range(90, 110).selectExpr("id as k", "id + 50 as at"))
    done = merge.incremental_append(old, new, ["k"], "at")
    assert "Exchange hashpartitioning" not in plan(done)
    assert rows(done) == sorted([(i, i) for i in range(90)] + [(i, i + 50) for i in range(90, 110)], key=str)


def test_rates_come_after_the_exchange(spark, tmp_path):
    cells = "1L as league_id, 2024 as season, 5L as team_id, date '2024-01-01' as date, 9L as fixture_id, 'win' as result, 1 as goals_scored, " \
        "0 as goals_conceded, 't' as team_name, 6L as opponent_id, 'o' as opponent_name, 'c' as country, 'l' as league"
    text = plan(standings.team_running_table(stage(spark.sql(f"select {cells}"))))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "100.0" in above and "100.0" not in below
