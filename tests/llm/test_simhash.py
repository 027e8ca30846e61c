from __future__ import annotations

import re

import numpy as np
import xxhash

from streakline.llm import simhash
from streakline.llm.components import components
from tests.llm.conftest import odd_rows


def fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps):
    linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    root = np.arange(len(fps))
    while True:
        new = np.where(linked, root[None, :], len(fps)).min(axis=1)
        if (new == root).all():
            return root
        root = new


def expected(rows):
    fps = np.array([fingerprint(t) for _, t, *_ in rows], np.uint64)
    root = roots(fps)
    least = {}
    for (i, *_), r in zip(rows, root.tolist(), strict=True):
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    return [(i, f"{f:016x}", least[r]) for (i, *_), f, r in zip(rows, fps.tolist(), root.tolist(), strict=True)]


def near_fingerprints(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    near = np.repeat(base[: n // 3], 3)
    for _ in range(3):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64))
    dense = base[0] ^ (np.uint64(1) << rng.integers(0, 12, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 12, 200).astype(np.uint64))
    return np.unique(np.concatenate([base, near, dense]))


def test_odd(odd):
    found = sorted(map(tuple, simhash.near_duplicates(odd).collect()), key=str)
    assert found == sorted(expected(odd_rows()), key=str)


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, simhash.near_duplicates(documents).collect())) == sorted(expected(rows))


def test_shard_links_are_exact():
    fps = near_fingerprints(900, 1)
    assert (simhash.link_shard(fps, np.ones(len(fps), bool)) == roots(fps)).all()


def test_shards_together_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_FINGERPRINTS", 100)
    fps = near_fingerprints(600, 2)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = {r["node"]: r["root"] for r in components(simhash.links(table)).collect()}
    root = roots(fps)
    groups = {}
    for f, r in zip(fps.view(np.int64).tolist(), root.tolist(), strict=True):
        groups.setdefault(r, set()).add(f)
    mine = {}
    for f in fps.view(np.int64).tolist():
        mine.setdefault(found.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_quarters_find_every_link(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 2**64, 300, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 5), replace=False))) for c in np.repeat(centres, 5)]
    fps = np.unique(np.array(near, np.uint64))
    want = {(int(fps[i]), int(fps[j])) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 3}
    monkeypatch.setattr(simhash, "SHARD_FINGERPRINTS", 20)
    monkeypatch.setattr(simhash, "WHOLE_DEPTH", 2)
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint").repartition(3)
    edges = simhash.links(frame).collect()
    sets = {int(x): int(x) for x in fps}

    def root(x):
        while sets[x] != x:
            x = sets[x]
        return x

    for r in edges:
        a, b = r["a"] % 2**64, r["b"] % 2**64
        sets[root(max(a, b))] = root(min(a, b))
    found = {frozenset(x for x in sets if root(x) == r) for r in {root(x) for x in sets}}
    plain = {int(x): int(x) for x in fps}
    sets = plain
    for a, b in want:
        sets[root(max(a, b))] = root(min(a, b))
    assert found == {frozenset(x for x in sets if root(x) == r) for r in {root(x) for x in sets}} and want


def test_visits_do_not_grow_with_the_depth(monkeypatch):
    rng = np.random.default_rng(7)
    sample, fps = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (32_768, 5_000))
    for depth in (6, 10, 14):
        rows, shards, own = simhash.visits(fps, simhash.shard_trees(sample, depth))
        assert len(rows) == 4 * len(fps) and own.all()
        largest = np.unique(shards, return_counts=True)[1].max()
        assert largest < 5_000 * 40 / 2**depth + 200
    rows, _, own = simhash.visits(fps, simhash.shard_trees(sample, 3))
    assert own.sum() == len(fps) and len(rows) < 6 * len(fps)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 200), (200, 300), (None, 1)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = dict.fromkeys(range(61), 0) | dict.fromkeys(range(100, 140), 100) | {200: 200, 300: 200}
    assert found == want


def test_one_of_each_group_stays(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = odd_rows()
    groups = {}
    for (i, *_), root in zip(rows, roots(np.array([fingerprint(t) for _, t, *_ in rows], np.uint64)).tolist(), strict=True):
        groups.setdefault(root, []).append(i)
    ids = [r["doc_id"] for r in kept.collect()]
    least = [min((x for x in g if x is not None), default=None) for g in groups.values()]
    assert sorted(ids, key=str) == sorted(least, key=str)


def test_empty(none):
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.keep_one(none).collect() == []
