from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from streakline.operators import merge
from streakline.plans import jobs
from streakline.session import scratch_path
from streakline.sources import buckets
from streakline.sources.paths import exists
from streakline.sources.snapshots import NoSnapshot, versions, write_version

KEY = ["api_fixture_id"]


def table(spark, n=200):
    return spark.range(n).selectExpr("id as api_fixture_id", "cast(id * 10 as int) as goals", "cast(null as string) as note")


def update(old, new):
    return merge.coalesce_update(old, new, KEY)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def root(spark):
    root = scratch_path(spark, "test-buckets")
    buckets.write_buckets(table(spark), root, KEY, "1", 16)
    return root


def feed(spark, ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "api_fixture_id bigint, note string")


def test_only_touched_buckets_are_read_and_written(spark, root):
    before = buckets.read_map(spark, root)
    new = feed(spark, [3, 7])
    touched = before.touched(new)
    read = before.read(spark, touched)
    assert {f.split("bucket=")[1].split("/")[0] for f in read.inputFiles()} == {str(b) for b in touched}
    after = buckets.update_buckets(new, root, "2", update)
    assert {b for b in before.folders if before.folders[b] != after.folders[b]} == set(touched) and len(touched) < 3
    assert rows(after.read(spark)) == rows(update(table(spark), new))
    # Files of untouched buckets are the very same ones.
    kept = [b for b in before.folders if b not in touched]
    assert sorted(before.read(spark, kept).inputFiles()) == sorted(after.read(spark, kept).inputFiles())


def test_a_retry_starts_where_the_first_try_did(spark, root):
    add = lambda old, new: old.join(new.select(*KEY), KEY, "left").withColumn("goals", F.col("goals") + 1)
    for _ in range(2):
        buckets.update_buckets(feed(spark, range(200)), root, "2", add)
    assert rows(buckets.read_buckets(spark, root).select("goals")) == [(10 * i + 1,) for i in range(200)]
    assert rows(buckets.read_buckets(spark, root, before="2").select("goals")) == [(10 * i,) for i in range(200)]


def test_replacing_and_inserting(spark, root):
    new = table(spark, 210).where("api_fixture_id >= 190").withColumn("note", F.lit("x"))
    after = buckets.update_buckets(new, root, "2", lambda old, f: merge.replace_by_key(old, f, KEY))
    assert rows(after.read(spark).where("note = 'x'").select(*KEY)) == [(i,) for i in range(190, 210)]
    assert after.read(spark).count() == 210


def test_appended_rows_stand_beside(spark, root):
    before = buckets.read_map(spark, root)
    more = table(spark, 230).where("api_fixture_id >= 200")
    buckets.publish(spark, buckets.append_to(before, more, "2"), "2")
    after = buckets.read_map(spark, root)
    assert rows(after.read(spark)) == rows(table(spark, 230))
    assert all(set(before.folders[b]) <= set(after.folders[b]) for b in before.folders)
    # An update of such a bucket folds its folders into one.
    folded = buckets.update_buckets(feed(spark, range(230)), root, "3", update)
    assert all(len(p) == 1 for p in folded.folders.values()) and folded.read(spark).count() == 230


def test_a_bucket_may_become_empty(spark, root):
    gone = buckets.update_buckets(feed(spark, range(200)), root, "2", lambda old, new: old.join(new, KEY, "left_anti"))
    assert gone.folders == {} and buckets.read_buckets(spark, root).collect() == []
    assert buckets.read_buckets(spark, root).columns == table(spark).columns
    back = buckets.update_buckets(table(spark, 3), root, "3", lambda old, new: old.unionByName(new))
    assert rows(back.read(spark)) == rows(table(spark, 3))


def test_empty_feed_and_empty_table(spark, root):
    before = buckets.read_map(spark, root)
    assert buckets.update_buckets(feed(spark, []), root, "2", update) == before
    assert not buckets.has_map(spark, f"{root}/other")
    with pytest.raises(NoSnapshot):
        buckets.read_map(spark, f"{root}/other")
    none = buckets.write_buckets(table(spark, 0), f"{root}/none", KEY, "1", 4)
    assert none.read(spark).collect() == [] and buckets.read_buckets(spark, f"{root}/none").columns == table(spark).columns


def test_null_keys_and_no_key_in_the_feed(spark, root):
    odd = table(spark, 3).unionByName(table(spark, 2).withColumn("api_fixture_id", F.lit(None).cast("bigint")))
    made = buckets.write_buckets(odd, f"{root}/odd", KEY, "1", 4)
    assert made.read(spark).where("api_fixture_id is null").count() == 2 and made.read(spark).count() == 5
    with pytest.raises(Exception, match="api_fixture_id"):
        buckets.update_buckets(feed(spark, [1]).drop("api_fixture_id"), root, "2", update)


def test_old_folders_go(spark, root):
    first = buckets.read_map(spark, root)
    for stamp in ("2", "3"):
        last = buckets.update_buckets(feed(spark, [3, 7]), root, stamp, update)
    assert buckets.remove_unused(spark, root, keep=1) > 0
    assert rows(buckets.read_buckets(spark, root)) == rows(last.read(spark))
    replaced = [p for b in first.folders if first.folders[b] != last.folders[b] for p in first.folders[b]]
    assert replaced and not any(exists(spark, p) for p in replaced)


def test_jobs_leave_the_last_versions(spark, tmp_path):
    root = str(tmp_path)
    for stamp in ("1", "2", "3"):
        for name in ("raw/raw_fixtures", "snapshots/full/parquet", "other"):
            write_version(spark.range(1), f"{root}/{name}", stamp)
    jobs.tidy(spark, root, keep=2)
    left = {name: len(versions(spark, f"{root}/{name}")) for name in ("raw/raw_fixtures", "snapshots/full/parquet", "other")}
    assert left == {"raw/raw_fixtures": 2, "snapshots/full/parquet": 2, "other": 3}
