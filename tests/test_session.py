import pytest

from streakline.functions.sizing import broadcast_if_small, is_small, measured_bytes
from streakline.session import is_scan, scratch_path, scratch_scope, shared_dir, stage, stage_at
from streakline.sources.paths import exists


def test_shared_folder_is_the_one_the_session_names(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    named = before or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == (named.rstrip("/") if named else shared_dir(spark))
    assert shared_dir(spark) == shared_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_staged_rows_have_no_lineage(spark):
    df = spark.range(100).selectExpr("id", "rand() as r")
    staged = stage(df)
    assert staged.schema.simpleString() == df.schema.simpleString()
    # Read twice, the same random numbers: they were computed once.
    assert sorted(staged.collect()) == sorted(staged.collect())
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()


def test_sizes_count_texts_and_rows(spark):
    short = spark.range(1000)
    assert is_small(short) and not is_small(short, 1_000)
    texts = short.selectExpr("id", "repeat('x', 10000) as text", "array(1, 2, 3) as list", "cast(null as string) as none")
    assert 10_000_000 < measured_bytes(texts) < 11_000_000
    assert measured_bytes(texts.limit(0)) == 0
    assert "broadcast" in broadcast_if_small(short)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(short, 1)._jdf.queryExecution().logical().toString()


def test_a_cluster_must_name_the_shared_folder(spark):
    class Elsewhere:
        conf = spark.conf

        class sparkContext:
            master = "k8s://host"
            getCheckpointDir = staticmethod(lambda: None)

    before = spark.conf.get("spark.checkpoint.dir", None)
    if before is None:
        with pytest.raises(RuntimeError, match="checkpoint"):
            shared_dir(Elsewhere)


def test_scans_are_told_from_work(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(9).selectExpr("id", "id * 2 as v").write.parquet(path)
    rows = spark.read.parquet(path)
    assert is_scan(rows) and is_scan(rows.where("v > 3").selectExpr("v + 1 as w"))
    assert not is_scan(rows.groupBy("id").count()) and not is_scan(rows.join(rows.select("id"), "id"))
    assert not is_scan(rows.selectExpr("explode(array(id, v)) as x"))


def test_scratch_tables_of_a_block_go(spark):
    kept = scratch_path(spark, "kept")
    with scratch_scope(spark) as made:
        first = stage(spark.range(3))
        out = stage_at(first.selectExpr("id + 1 as id"), kept)
        with scratch_scope(spark):
            inner = stage(spark.range(2)).inputFiles()[0]
        assert not exists(spark, inner) and len(made) == 1
    assert not exists(spark, made[0]) and sorted(r[0] for r in out.collect()) == [1, 2, 3]
    with pytest.raises(ValueError), scratch_scope(spark) as made:
        stage(spark.range(1))
        raise ValueError
    assert exists(spark, made[0])
