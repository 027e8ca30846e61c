from __future__ import annotations

import re
from collections import Counter, defaultdict

from streakline.llm import mixing
from tests.llm.conftest import odd_rows


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in held]
        if not free:
            break
        level = (total - sum(cap * sizes[s] for s in held)) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not above:
            break
        held |= above
    return {s: float(cap * sizes[s]) if s in held else level * weight[s] for s in names}


def check(rows, sources):
    sizes = defaultdict(int)
    for _, t, _, s, *_ in sources:
        sizes[s] += size(t)
    targets = expected_targets(sizes)
    assert len(rows) == len(sources)
    assert sorted(r["size"] for r in rows) == sorted(size(x[1]) for x in sources)
    taken = defaultdict(int)
    of = defaultdict(list)
    for x in sources:
        of[x[0], size(x[1])].append(x[3])
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = of[r["doc_id"], r["size"]].pop()
        assert r["source_size"] == sizes[s]
        assert abs(r["target"] - targets[s]) < 1e-6
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 5


def test_sizes_odd(odd):
    # Rows of one id and size must have one source, so that the test can tell them apart.
    sources = odd_rows()
    rows = mixing.mix_sizes(odd).collect()
    check(rows, sources)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix_sizes(odd.repartition(5)).collect()), key=str)


def test_one_source_of_three_is_held_at_three_times_its_size(spark):
    rows = [(i, "w " * 10, None, "a", 0) for i in range(2)] + [(9 + i, "w " * 10, None, "b", 0) for i in range(50)]
    rows += [(100, "v " * 3, None, "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check(mixing.mix_sizes(docs).collect(), rows)


def test_ties_share_the_words_at_the_threshold(spark):
    rows = [(1, "a b c d e f", None, "s", 0)] * 9 + [(2, "q " * 200, None, "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mix_sizes(docs).where("doc_id = 1").collect()
    assert len({r["taken"] for r in found}) == 1 and len(found) == 9


def test_mixed_table_has_the_words_that_sizes_tell(odd):
    taken = sum(r["taken"] for r in mixing.mix_sizes(odd).collect())
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns and mixed.dtypes == odd.dtypes
    # Documents come whole: each source is within its largest document of what the mix takes.
    largest = Counter()
    for r in odd.collect():
        largest[r["source"]] = max(largest[r["source"]], size(r["text"]))
    slack = sum(largest.values())
    assert abs(sum(size(r["text"]) for r in mixed.collect()) - taken) <= slack
    texts = {r["text"] for r in odd.collect()}
    assert all(r["text"] in texts for r in mixed.collect())


def test_empty(none):
    assert mixing.mix_sizes(none).collect() == []
    assert mixing.mix_documents(none).collect() == []
