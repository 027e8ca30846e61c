from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from streakline.operators import key_bits, quality
from streakline.operators.quality import Check
from tests.test_plans import plan

EDGE = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**63 - 1, -(2**63), None, None]


def _keys(spark, values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}").repartition(4)


def test_repeats_as_counted(spark):
    rng = random.Random(1)
    for values in (
        EDGE,
        EDGE + EDGE,
        [rng.randrange(-50_000, 50_000) for _ in range(400)],
        [rng.randrange(-(2**63), 2**63) for _ in range(200)] + EDGE,
        [7] * 300 + list(range(100)),
        [],
    ):
        found = {r.k: r.occurrences for r in key_bits.repeated_keys(_keys(spark, values), "k").collect()}
        assert found == {k: n for k, n in Counter(values).items() if n > 1 and k is not None}


def test_orphans_as_counted(spark):
    rng = random.Random(2)
    near = [rng.randrange(-40_000, 40_000) for _ in range(300)]
    for child, parent in ((EDGE, EDGE[::2]), (near, near[:250] + EDGE), (near, []), ([], near), (EDGE, EDGE), ([5] * 90, [6])):
        found = key_bits.orphaned_keys(_keys(spark, child), "k", _keys(spark, parent), "k").collect()
        assert {r.k: r.failing for r in found} == {k: n for k, n in Counter(child).items() if k is not None and k not in set(parent)}


def test_types_are_kept(spark):
    df = _keys(spark, [1, 1, 2], "int")
    assert dict(key_bits.repeated_keys(df, "k").dtypes) == {"k": "int", "occurrences": "bigint"}
    orphans = key_bits.orphaned_keys(df, "k", _keys(spark, [2]), "k")
    assert [tuple(r) for r in orphans.collect()] == [(1, 2)] and dict(orphans.dtypes)["k"] == "int"


def test_only_suspect_buckets_are_grouped(spark):
    """Two million keys in order, one of them twice: one bucket of 32,768 keys is looked at one by one."""
    df = spark.range(0, 2_000_000, 1, 8).select(F.col("id").alias("k")).unionByName(_keys(spark, [1_234_567]))
    suspects = key_bits.repeat_suspects(df, "k")
    assert suspects.count() == 1
    assert key_bits._in_buckets(df, "k", suspects).count() == 32_769
    assert [tuple(r) for r in key_bits.repeated_keys(df, "k").collect()] == [(1_234_567, 2)]
    # One bitmap per task and bucket crosses the network, not a row per key.
    bitmaps = key_bits.key_bitmaps(df, "k")
    assert plan(bitmaps).count("Exchange hashpartitioning") == 1 and "partial_bitmap_construct_agg" in plan(bitmaps)
    assert bitmaps.count() == 63
    parent = spark.range(0, 2_000_000, 1, 3).where("id <> 777").select("id")
    assert key_bits.orphan_suspects(df, "k", parent, "id").count() == 1
    assert [tuple(r) for r in key_bits.orphaned_keys(df, "k", parent, "id").collect()] == [(777, 1)]


def test_report_through_bitmaps(spark):
    rows = [(1, 10, "a"), (2, 10, "a"), (2, 99, "b"), (None, None, None), (None, 99, "c")]
    tables = {
        "child": spark.createDataFrame(rows, "id int, parent int, name string"),
        "parent": spark.createDataFrame([(10,), (11,)], "id bigint"),
    }
    checks = [
        Check("child", "id", "unique"),
        Check("child", "name", "unique"),
        Check("child", "parent", "relationship", (), ("parent", "id")),
        Check("child", "id", "not_null"),
        Check("parent", "id", "unique"),
    ]
    found = sorted(map(tuple, quality.quality_report(tables, checks, bitmaps=True).collect()))
    assert found == sorted(map(tuple, quality.quality_report(tables, checks).collect()))
    assert ("child", "parent", "relationship", 2) in found and ("child", "name", "unique", 1) in found
