from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from streakline.llm import exact


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()


def brute(rows) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r["text"])].append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            out.append((i, best, len(ids), i == best and left > 0, hashlib.sha256(text).hexdigest()))
            left -= i == best
    return sorted(out, key=str)


def result(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"bucket_bytes": 2_000},
        # Half the keys collide, and every key is dealt over parts.
        {"key": lambda t: (len(t) % 5) << 61, "fan": 3, "bucket_bytes": 20_000},
    ],
    ids=["plain", "split buckets", "collisions"],
)
def test_odd_rows(odd, options):
    assert result(exact.grouped(odd, **options)) == brute(odd.collect())


def test_one_text_in_many_tasks(spark):
    rows = [(i, ("Same text" if i % 3 else "SAME TEXT") if i % 2 else f"other {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(40)
    assert result(exact.grouped(docs, fan=4)) == brute(docs.collect())


def test_only_ascii_case_is_lost(spark):
    docs = spark.createDataFrame([(1, "É x"), (2, "é X"), (3, "É X"), (4, "K"), (5, "k"), (6, "K")], "doc_id int, text string")
    assert {r["doc_id"] for r in exact.grouped(docs).where("kept").collect()} == {2, 3, 5, 6}


def test_long_texts(spark):
    long_ = "word " * 25_000 + "w" * 1_000_000
    docs = spark.createDataFrame([(1, long_), (2, long_.upper()), (3, long_ + "!"), (4, None), (5, "")], "doc_id bigint, text string")
    assert result(exact.grouped(docs)) == brute(docs.collect())


def test_directory_covers_every_key_once(spark):
    keys = spark.range(2_000).select(F.xxhash64("id").alias("h"), F.lit(10).cast("bigint").alias("bytes"))
    buckets = exact.directory(keys, bucket_bytes=200)
    placed = exact.in_buckets(keys, buckets)
    sizes = placed.groupBy("bucket").agg(F.sum("bytes").alias("b")).collect()
    assert placed.count() == 2_000 and max(r["b"] for r in sizes) <= 200
    assert sorted(r["bucket"] for r in buckets.collect()) == list(range(buckets.count()))
    assert buckets.select("depth").distinct().count() > 1


def test_drop_duplicates_keeps_columns(odd):
    kept = exact.drop_duplicates(odd)
    assert kept.columns == odd.columns
    want = sorted((r[0] is None, r[0] or 0, r[4]) for r in brute(odd.collect()) if r[3])
    got = [(r["doc_id"] is None, r["doc_id"] or 0, hashlib.sha256(lowered(r["text"])).hexdigest()) for r in kept.collect()]
    assert sorted(got) == want


def test_empty_table(none):
    assert exact.grouped(none).collect() == [] and exact.drop_duplicates(none).collect() == []
