"""Steps that move keys first and whole rows only where these tell to."""

from pyspark.sql import functions as F

from streakline.operators import merge
from streakline.plans import jobs
from streakline.sources import fixture_files, snapshots
from tests.test_sources import put, record

DDL = "k int, n int, v string"


def test_model_replaces_all_but_keys_that_are_gone(spark):
    stored = spark.createDataFrame([(1, 1, "a"), (1, 1, "a2"), (2, 1, "b"), (None, 1, "c"), (3, None, "d"), (4, 1, "e")], DDL)
    built = spark.createDataFrame([(2, 1, "B"), (4, 1, "E"), (4, 1, "E2"), (5, 1, "F"), (None, 1, "C"), (3, None, "D")], DDL)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    for source in (built, built.limit(0)):
        assert rows(merge.replace_model(stored, source, ["k", "n"])) == rows(merge.replace_by_key(stored, source, ["k", "n"]))
    few = merge.replace_model(spark.range(1000).withColumn("v", F.lit("x")), spark.range(1000).withColumn("v", F.lit("y")), ["id"])
    # No stored row is shuffled once it is known which keys are gone.
    assert "Exchange hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()


def test_records_are_worked_out_once(spark, tmp_path):
    put(tmp_path, [record(1), record(2, "NS", "x", None)], "a.json")
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda v: seen.add(1) or v, "string").asNondeterministic()
    records = fixture_files.scan_update_file(spark, str(tmp_path / "a.json")).withColumn("season", count("season"))
    root = str(tmp_path / "w")
    assert jobs.transform_job(records, root, "full", "20240101_000000") == 2
    assert seen.value == 2
    assert snapshots.latest_snapshot(spark, f"{root}/snapshots", "full").count() == 2
    schema = snapshots.latest_snapshot(spark, f"{root}/snapshots", "full").schema
    assert snapshots.read_csv_snapshot(spark, f"{root}/snapshots", "full", schema).count() == 2
    assert list((tmp_path / "w" / "snapshots" / "full").glob("csv/*/*.csv.gz"))
