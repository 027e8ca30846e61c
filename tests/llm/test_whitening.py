from __future__ import annotations

import math
import random

import numpy as np
import pytest

from streakline.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, part string, n string"


def frame(spark, vectors, ids=None):
    rows = [(i, v, 0, "x", "x", "x") for i, v in zip(ids or range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(vectors) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviations = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    return centred, deviations, values[::-1], vectors_[:, ::-1]


def check(spark, vectors, ids=None, components=None):
    made = whitening.whiten(frame(spark, vectors, ids)).collect()
    kept = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    centred, deviations, values, axes = brute(kept)
    k = components or min(32, len(values))
    assert len(made) == k * len(kept)
    assert {r["n"] for r in made} == {len(kept)} and {r["component"] for r in made} == set(range(1, k + 1))
    assert sorted(r["deviation"] for r in made if r["component"] == 1) == sorted(deviations)
    assert max(r["identity_error"] for r in made) < 1e-9
    for c in range(1, k + 1):
        own = sorted(abs(r["whitened"]) for r in made if r["component"] == c)
        want = np.sort(np.abs(centred @ axes[:, c - 1]) / math.sqrt(values[c - 1]))
        assert np.allclose(own, want, atol=1e-7)
        assert all(abs(r["explained"] / (values[c - 1] / values.sum()) - 1) < 1e-9 for r in made if r["component"] == c)
    return made


def test_against_numpy(spark):
    rng = random.Random(3)
    check(spark, [[rng.gauss(0, 1 + j) for j in range(6)] for _ in range(300)])


def test_more_dimensions_than_components(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("embedding").collect()
    check(spark, [r[0] for r in rows])


def test_ill_conditioned(spark):
    rng = random.Random(4)
    base = [[rng.gauss(0, 1000), rng.gauss(0, 1), rng.gauss(0, 0.05)] for _ in range(400)]
    check(spark, base)


def test_rank_deficient(spark):
    rng = random.Random(5)
    rows = [[rng.randint(-50, 50), rng.randint(-5, 5)] for _ in range(100)]
    made = whitening.whiten(frame(spark, [[float(a), float(b), float(a), 7.0] for a, b in rows])).collect()
    assert {r["component"] for r in made} == {1, 2} and max(r["identity_error"] for r in made) < 1e-4


def test_odd_vectors(spark):
    rng = random.Random(6)
    good = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(50)]
    odd = [None, [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0]]
    vectors = [*good, *odd, good[0], good[0]]
    made = check(spark, vectors, [None, *range(1, len(vectors) - 1), 1])
    assert sum(r["vec_id"] is None for r in made) == 3 and sum(r["vec_id"] == 1 for r in made) == 6
    other = whitening.whiten(frame(spark, [*good, [], [1.0], [1.0] * 5]))
    assert {r["n"] for r in other.collect()} == {50}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]], ids=["none", "one", "equal", "null"])
def test_nothing_varies(spark, vectors):
    out = whitening.whiten(frame(spark, vectors) if vectors else spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and out.columns[0] == "vec_id" and len(out.columns) == 7


def test_large_entries(spark):
    made = check(spark, [[float(2**12 * i), float(i * i)] for i in range(40)], components=2)
    assert all(isinstance(r["deviation"], int) for r in made)
    huge = whitening.whiten(frame(spark, [[2.0**30 * i, 1.0] for i in range(30)])).collect()
    assert any(r["deviation"] is None for r in huge) and len(huge) == 30
    assert whitening.whiten(frame(spark, [[1e38, 1.0], [1.0, 2.0], [2.0, 1.0]])).first()["n"] == 2
