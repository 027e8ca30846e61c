import random

import pytest

from streakline.functions.ordered import CHUNK, cut, hot_keys, next_values, number_all, previous_values, row_numbers
from streakline.operators.streaks import latest_per_key, run_lengths

CASES = [
    ([1, 1, 0, 1], [1, 2, 0, 1]),
    ([0, 0, 1], [0, 0, 1]),
    ([1, None, 1], [1, 0, 3]),
    ([None, 1, 1], [0, 2, 3]),
    ([0, None, 1, 1], [0, 0, 3, 4]),
    ([None], [0]),
    ([1], [1]),
]


def brute(flags):
    """The stated rules, one row at a time: lengths and run numbers."""
    lengths, runs, before, start, run = [], [], 0, 0, 0
    for i, now in enumerate(flags):
        if now == 1 and before == 0:
            start, run = i, run + 1
        lengths.append(i - start + 1 if now == 1 else 0)
        runs.append(run)
        before = now
    return lengths, runs


def frame(spark, sequences):
    rows = [(k, i // 3, i, f, f) for k, flags in sequences.items() for i, f in enumerate(flags)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, id int, a int, b int")


def found(df, *columns):
    out = {}
    for r in df.orderBy("k", "id").collect():
        out.setdefault(r.k, []).append(tuple(r[c] for c in columns))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_hand_made_cases(spark, hot):
    sequences = {str(i): flags for i, (flags, _) in enumerate(CASES)}
    df = run_lengths(frame(spark, sequences), ["k"], ["t", "id"], ["a"], hot=hot, chunk_rows=2)
    got = found(df, "a_length")
    assert {k: [v for (v,) in rows] for k, rows in got.items()} == {str(i): want for i, (_, want) in enumerate(CASES)}


def test_null_resets(spark):
    df = frame(spark, {"x": [1, None, 1], "y": [None, 1, 1]})
    for hot in (False, True):
        got = found(run_lengths(df, ["k"], ["t", "id"], ["a"], null_resets=True, hot=hot, chunk_rows=2), "a_length")
        assert got == {"x": [(1,), (0,), (1,)], "y": [(0,), (1,), (2,)]}


def skewed_sequences(seed):
    """One key holds most of the rows; one key is NULL."""
    rng = random.Random(seed)
    pick = lambda n, p: [None if rng.random() < 0.1 else int(rng.random() < p) for _ in range(n)]
    return {"hot": pick(600, 0.8), "all": [1] * 90, "none": [0] * 40, None: pick(70, 0.5), **{f"k{i}": pick(i, 0.6) for i in range(1, 12)}}


@pytest.mark.parametrize("chunk_rows, hot", [(8, True), (8, None), (40, True), (40, None), (1000, True), (1000, None), (8, False)])
def test_against_brute_force(spark, chunk_rows, hot):
    sequences = skewed_sequences(chunk_rows)
    df = frame(spark, sequences).withColumnRenamed("b", "other").selectExpr("*", "1 - other as b")
    done = run_lengths(df, ["k"], ["t", "id"], ["a", "b"], with_ids=True, hot=hot, chunk_rows=chunk_rows)
    got = found(done, "a_length", "a_run", "b_length", "b_run")
    for k, flags in sequences.items():
        opposite = [None if f is None else 1 - f for f in flags]
        assert got[k] == list(zip(*brute(flags), *brute(opposite))), k


def test_chunks_are_in_order_and_even(spark):
    df = cut(frame(spark, skewed_sequences(5)), ["k"], ["t", "id"], 40)
    chunks = [c for (c,) in found(df, CHUNK)["hot"]]
    assert chunks == sorted(chunks) and len(set(chunks)) > 20
    total = sum(map(len, skewed_sequences(5).values()))
    assert df.count() == total
    assert max(r["count"] for r in df.groupBy(CHUNK).count().collect()) < total / 10


def test_one_time_for_all_rows_is_cut_too(spark):
    df = frame(spark, {"x": [1] * 400}).selectExpr("k", "0 as t", "id", "a")
    done = run_lengths(df, ["k"], ["t", "id"], ["a"], hot=None, chunk_rows=20)
    assert [v for (v,) in found(done, "a_length")["x"]] == list(range(1, 401))


@pytest.mark.parametrize("chunk_rows, hot", [(10, True), (50, None)])
def test_numbers_and_neighbours(spark, chunk_rows, hot):
    sequences = skewed_sequences(9)
    df = frame(spark, sequences)
    options = {"hot": hot, "chunk_rows": chunk_rows}
    order = ["t", "id"]
    numbered = found(row_numbers(df, ["k"], order, "rn", **options), "rn")
    ahead = found(next_values(df, ["k"], order, {"na": "a", "nid": "id"}, **options), "na", "nid")
    behind = found(previous_values(df, ["k"], order, {"pa": "a"}, default=0, **options), "pa")
    plain = found(previous_values(df, ["k"], order, {"pa": "a"}, default=0, hot=False), "pa")
    for k, flags in sequences.items():
        n = len(flags)
        assert numbered[k] == [(i + 1,) for i in range(n)]
        assert ahead[k] == [(flags[i + 1], i + 1) if i + 1 < n else (None, None) for i in range(n)]
        assert behind[k] == plain[k] == [(flags[i - 1],) if i else (0,) for i in range(n)]


def test_number_all(spark):
    df = spark.range(0, 500).selectExpr("id", "pmod(id * 7919, 500) as place")
    for chunk_rows in (10, 10_000):
        rows = number_all(df, ["place"], "nr", start=1, chunk_rows=chunk_rows).collect()
        assert sorted((r.place, r.nr) for r in rows) == [(i, i + 1) for i in range(500)]


def test_hot_keys(spark):
    df = frame(spark, {"a": [1] * 10, "b": [1], None: [1] * 12})
    assert {(r.k, r.rows) for r in hot_keys(df, ["k"], 9).collect()} == {("a", 10), (None, 12)}
    assert hot_keys(df, ["k"], 12).isEmpty() and hot_keys(df.limit(0), ["k"], 1).isEmpty()


def test_latest_per_key(spark):
    df = frame(spark, {"x": [1, 0, None], "y": [0, 1]})
    got = latest_per_key(df, ["k"], ["t", "id"], ["id", "a"])
    assert {r.k: (r.id, r.a) for r in got.collect()} == {"x": (2, None), "y": (1, 1)}
