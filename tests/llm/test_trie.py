from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from streakline.llm import trie

CLASHING = ["id", "pos", "key", "prior", "level", "p1", "depth", "length", "part", "parent"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, " + ", ".join(f"{c} string" for c in CLASHING)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], SCHEMA).repartition(3)


def digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows) -> list[tuple]:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), digest(role or "", text or ""), (role or "", text or "")))
    lists = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = lists.get(family, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        children = sum(len(p) == len(path) + 1 for p in below)
        out.append((min(convs), len(path), parent, len(convs), children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df) -> list[tuple]:
    assert df.columns == trie.NODE
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in [*range(-4, 12), *range(100, 130), 205, 310]:
        same = rng.random() < 0.6
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            text = f"turn {t}" if same else rng.choice(["a", "bb", "ünï", f"own {c}"])
            rows.append((c, t, "user" if t % 2 else None, text))
    return rows


@pytest.mark.parametrize("block, part_rows", [(8, 1_000_000), (2, 2), (3, 1)])
def test_against_brute_force(spark, block, part_rows):
    rows = random_rows(block)
    assert result(trie.prefix_trie(frame(spark, rows), block, part_rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", None), (1, 0, None, "b"), (1, 0, None, "b"), (1, 0, "a", "c"), (2, 5, None, None), (None, 1, "user", "lost")]
    rows += [(100, 1, "user", "x" * 100_000 + "é" * 3), (101, 1, "user", "x"), (102, 1, "user", "x"), (7, None, None, None)]
    rows += [(103, t, "user", f"{t}") for t in range(40)] + [(100, t, "user", f"{t}") for t in range(2, 40)]
    assert result(trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_many_equal_conversations(spark):
    rows = [(100 * c, t, "user", f"t{t}") for c in range(60) for t in range(20)]
    assert result(trie.prefix_trie(frame(spark, rows), 8, 7)) == brute(rows)


def test_conversations_without_turns(spark):
    # No family head, and fewer turns than are taken from it.
    rows = [(c, 0, "user", "only") for c in range(501, 540) if zlib.crc32(str(c).encode()) % 6]
    made = result(trie.prefix_trie(frame(spark, rows)))
    assert made == brute(rows) and len(made) == 1 and made[0][5] == 1


def test_ends_in_pieces(spark):
    ends = spark.range(500).selectExpr("cast(if(id % 7 = 0, 'b', 'a') as binary) as key", "id as conv_id")
    got = {bytes(r["key"]): r["ends_sha256"] for r in trie.digests_of_ends(ends, piece_bytes=100).collect()}
    ids = {b"a": [i for i in range(500) if i % 7], b"b": list(range(0, 500, 7))}
    assert got == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in ids.items()}


def test_empty_table(spark):
    assert result(trie.prefix_trie(frame(spark, []))) == []


def test_one_rollup_aggregates_all_prefixes(spark):
    convs, turns = trie.rebuilt(trie.stage(trie.numbered_turns(frame(spark, random_rows(1)))))
    rows = convs.join(trie.laid_out(turns, 8).where("block = 0"), "conv_id", "left").selectExpr("*", "cast('' as binary) as prior")
    plan = trie._rollup(rows, trie._columns(8), "count(1) as n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Aggregate") == 2
