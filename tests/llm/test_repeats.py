from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from streakline.llm import repeats, substrings, suffixes
from streakline.llm.windows import anchor_runs, leftmost_least, window_names
from tests.llm.conftest import odd_rows


def words_expected(rows, length=35):
    texts = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    seen = Counter(tuple(w[p : p + length]) for _, w in texts for p in range(len(w) - length + 1))
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if seen[tuple(w[p : p + length])] > 1:
                gone[p : p + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def bytes_expected(rows, length=100):
    least = {}
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    # Rows of one id are documents in the order of a hash of their texts, copies one after the other.
    texts = [(i, (-1 if i is None else i, xxhash.xxh64_intdigest(b, 42) ^ 2**63, n), b) for n, (i, b) in enumerate(texts)]
    for _, at, b in texts:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            least[s] = min(least.get(s, (at, p)), (at, p))
    out = []
    for i, at, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < (at, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_names_tell_windows_apart():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2, 400).astype(np.uint64)
    for n, names in zip([1, 7, 35], window_names(codes, [1, 7, 35]), strict=True):
        windows = [tuple(codes[p : p + n].tolist()) for p in range(len(codes) - n + 1)]
        assert len(names) == len(windows)
        assert len(set(zip(windows, names.tolist(), strict=True))) == len(set(windows)) == len(set(names.tolist()))


def test_leftmost_least():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 9, 300)
    for width in (1, 2, 5, 77):
        want = [p + int(np.argmin(values[p : p + width])) for p in range(len(values) - width + 1)]
        assert leftmost_least(values, width).tolist() == want


def test_runs_cover_all_windows():
    codes = np.random.default_rng(5).integers(0, 3, 500).astype(np.uint64)
    r = anchor_runs(codes, 35, 18)
    assert [x for a, b in zip(r.first, r.last, strict=True) for x in range(a, b + 1)] == list(range(500 - 34))
    assert anchor_runs(codes[:34], 35, 18) is None


@pytest.mark.parametrize("hot", [2_000, 1])
def test_words_odd(odd, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_ROWS", hot)
    assert sorted(map(tuple, substrings.measure_repeats(odd).collect()), key=str) == words_expected(odd_rows())


@pytest.mark.parametrize("hot", [2_000, 1])
def test_bytes_odd(odd, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_ROWS", hot)
    assert sorted(map(tuple, suffixes.measure_repeats(odd).collect()), key=str) == bytes_expected(odd_rows())


def test_frequent_grams_are_dealt_over_parts(odd):
    # A text of one letter has one gram at nearly 3,000 places; nothing else is that frequent.
    found = repeats._frequent(repeats.keyed(odd), suffixes.byte_codes, 100, 24)
    assert len(found) == 1 and min(found.values()) > 1


def test_documents_by_brute_force(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, substrings.measure_repeats(documents).collect()), key=str) == words_expected(rows)
    assert sorted(map(tuple, suffixes.measure_repeats(documents).collect()), key=str) == bytes_expected(rows)


def test_texts_that_remain(spark):
    shared = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"one {shared} two"), (2, f"three {shared}"), (3, "four")], "doc_id long, text string")
    assert {tuple(r) for r in substrings.remove_repeats(docs).collect()} == {(1, "one two"), (2, "three"), (3, "four")}
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffixes.remove_repeats(docs).collect()}
    # Bytes match further than words: "e" stands before the shared words in both.
    assert kept == {1: f"one {shared} two".encode(), 2: b"thre", 3: b"four"}


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    passage = " ".join(word() for _ in range(40))
    rows = [(None, f"{word()} {passage} {word()}") for _ in range(3)] + [(None, " ".join(word() for _ in range(46))) for _ in range(5)]
    rows += [(None, rows[0][1])] * 2 + [(7, rows[1][1]), (7, rows[1][1]), (7, "short"), (7, "short")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(map(tuple, substrings.measure_repeats(docs).collect()), key=str) == words_expected(rows)
    assert sorted(map(tuple, suffixes.measure_repeats(docs).collect()), key=str) == bytes_expected(rows)


def test_long_texts(spark):
    rng = np.random.default_rng(9)
    words = ["".join(x) for x in rng.choice(list("abcd"), (20_000, 5))]
    rows = [(1, " ".join(words)), (2, "x" * 1_000_000), (3, " ".join(words[5_000:5_100])), (4, "x" * 150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substrings.measure_repeats(docs).collect()} == {1: 100, 2: 0, 3: 100, 4: 0}
    assert {r["doc_id"]: r["n_removed"] for r in suffixes.measure_repeats(docs).collect()} == {1: 0, 2: 999_999, 3: 599, 4: 150}


def test_empty(none):
    assert substrings.measure_repeats(none).collect() == []
    assert suffixes.measure_repeats(none).collect() == []
