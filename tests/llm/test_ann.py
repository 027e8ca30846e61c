from __future__ import annotations

import numpy as np
import pytest

from streakline.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, score string, bucket string"


def brute(rows, every=50, nearest=5):
    good = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None for x in v):
            continue
        x = np.array(v, np.float64)
        if len(x) and np.isfinite(x).all() and x.any():
            good.setdefault(i, x)
    out = {}
    for q in [i for i in good if i % every == 0]:
        score = lambda i: float(good[q] @ good[i] / np.sqrt(good[q] @ good[q]) / np.sqrt(good[i] @ good[i]))  # noqa: B023, E731
        found = sorted(((-round(score(i), 12), i) for i in good if i != q and len(good[i]) == len(good[q])))
        out[q] = [(i, -s) for s, i in found[:nearest]]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    made = [(i, rng.normal(size=8).astype(np.float32).tolist(), 1, "s", "b") for i in range(1, 400)]
    hot = [1.0] * 8
    made += [(i, hot, 1, "s", "b") for i in range(400, 700)]
    made += [(0, [2.0] * 8, 1, "s", "b"), (750, None, 1, "s", "b"), (800, [0.0] * 8, 1, None, "b"), (850, [1.0] * 7 + [float("nan")], 1, "s", "b")]
    made += [(900, [1.0] * 7 + [float("inf")], 1, "s", "b"), (950, [], None, "s", "b"), (1000, [1.0, None, 2.0], 1, "s", "b")]
    made += [(1050, [1.0, 2.0, 3.0], 1, "s", "b"), (1051, [1.0, 2.0, 2.5], 1, "s", "b"), (None, hot, 1, "s", "b"), (450, hot, 1, "s", "b")]
    made += [(1100, [1e-30] * 8, 1, "s", "b")]
    return made


def test_odd_vectors(spark, rows):
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {}
    for r in ann.nearest_neighbours(vectors).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows)
    assert set(found) == {q for q, near in want.items() if near}
    hits = total = 0
    for q, near in want.items():
        got = sorted(found.get(q, []))
        assert [r for r, *_ in got] == list(range(1, len(got) + 1))
        scores = [s for *_, s in got]
        assert scores == sorted(scores, reverse=True)
        # Vectors of one direction are equally near but for rounding.
        hits += sum(s >= near[-1][1] - 1e-9 for s in scores)
        total += len(near)
    assert hits >= 0.9 * total
    # A query among very many copies of itself finds those of the smallest ids.
    assert [i for _, i, _ in sorted(found[500])] == [0, 400, 401, 402, 403] or all(s > 0.999999 for *_, s in found[500])
    assert [i for _, i, _ in found[1050]] == [1051]


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = brute(rows)
    found = {}
    for r in ann.nearest_neighbours(vectors).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(found[q] & {i for i, _ in near}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_parts_of_large_buckets(spark, rows, monkeypatch):
    vectors = spark.createDataFrame(rows, SCHEMA)
    whole = {tuple(r) for r in ann.nearest_neighbours(vectors).collect()}
    monkeypatch.setattr(ann, "PART_ROWS", 2)
    assert {tuple(r) for r in ann.nearest_neighbours(vectors).collect()} == whole


def test_probe_sets_are_distinct_and_valid():
    sets = ann.probe_sets(6, 100)
    assert sets[:2] == [[], [0]] and len({tuple(s) for s in sets}) == 100
    assert all(11 - r not in s for s in sets for r in s)


def test_empty(spark):
    assert ann.nearest_neighbours(spark.createDataFrame([], SCHEMA)).collect() == []


def test_opposite_and_few_vectors_get_all_candidates(spark):
    rng = np.random.default_rng(4)
    unlike = [(i, rng.normal(size=16).tolist(), 1, "s", "b") for i in range(0, 300, 50)]
    tables = [
        [(0, [1.0, 0.0], 1, "s", "b"), (50, [-1.0, 0.0], 1, "s", "b")],
        unlike,
        [(i * 50, [float(np.cos(i)), float(np.sin(i)), 1.0], 1, "s", "b") for i in range(7)] + unlike[1:4],
    ]
    for rows in tables:
        rows = [(i, np.float32(v).tolist(), *rest) for i, v, *rest in {r[0]: r for r in rows}.values()]
        # Twenty probes serve few of these queries; the others are to be exact.
        for probes in (20, None):
            found = {}
            for r in ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), probes=probes).collect():
                found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
            want = {q: near for q, near in brute(rows).items() if near}
            assert {q: len(f) for q, f in found.items()} == {q: len(near) for q, near in want.items()}
            if probes is None:
                assert {q: [i for _, i in sorted(f)] for q, f in found.items()} == {q: [i for i, _ in near] for q, near in want.items()}


def test_ties_go_to_the_smallest_ids(spark):
    rows = [(50 + i, [2.0 ** (i % 30), 0.0], 1, "s", "b") for i in range(40)] + [(7, [0.0, 1.0], 1, "s", "b")]
    found = {}
    for r in ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found[50]) == [(k, 50 + k, 1.0) for k in range(1, 6)]
