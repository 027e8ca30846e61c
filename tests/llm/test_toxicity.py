from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest

from streakline.llm import toxicity


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = toxicity.score_documents(docs, model).join(labels, "doc_id").where(toxicity.held_out(labels["doc_id"])).collect()
    return docs, model, rows


def test_held_out_accuracy(judged):
    _, _, rows = judged
    hits = sum(r["score"] >= 0.5 and r["toxic"] == 1 for r in rows)
    assert hits / sum(r["toxic"] for r in rows) > 0.75
    assert hits / sum(r["score"] >= 0.5 for r in rows) > 0.95


def test_sentences_at_fault(judged):
    docs, model, _ = judged
    found = toxicity.toxic_sentences(docs, model)
    texts = {r["doc_id"]: r["text"] for r in docs.join(found.select("doc_id").distinct(), "doc_id").collect()}
    for r in found.limit(200).collect():
        sentence = texts[r["doc_id"]][r["start"] : r["end"]]
        assert 0.5 <= r["score"] <= 1 and sentence.strip()
        # A sentence's own text scores as toxic too.
        assert model.scorer()(sentence)[0] >= 0.5


def test_held_out_rows(spark):
    rows = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    for r in rows.withColumn("out", toxicity.held_out(rows["doc_id"])).collect():
        assert r["out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


LABELS = "doc_id long, quality int, toxic int, text string"


def test_odd(odd, spark):
    labels = spark.createDataFrame(
        [(i, 1, i % 2, None) for i in range(40)] + [(None, 1, 1, None), (3, None, None, None), (999, 1, 1, "x"), (4, 1, 7, "x")], LABELS
    )
    rows = toxicity.judge_documents(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    empty = {r["doc_id"] for r in odd.collect() if not (r["text"] or "").strip()} - {None}
    assert all(r["score"] == 0 for r in rows if r["doc_id"] in empty)
    kept = toxicity.drop_toxic(odd, toxicity.train(odd, labels))
    assert kept.dtypes == odd.dtypes and kept.count() == sum(r["predicted"] == 0 for r in rows)


def test_nothing_to_learn_from(odd, none, spark):
    for labels in (spark.createDataFrame([], LABELS), spark.createDataFrame([(i, 1, 1, None) for i in range(30)], LABELS)):
        rows = toxicity.judge_documents(odd, labels).collect()
        assert len(rows) == odd.count() and {r["score"] for r in rows} == {0.0}
        assert toxicity.judge_documents(none, labels).collect() == []


# --- Brute force: nothing below calls the library but for the functions under test ---


def plain_words(sentence):
    return {w for w in re.split(r"[\W\d_]+", sentence.lower()) if w}


def plain_score(text, bias, weights):
    """One minus the product over sentences of the chance that each is clean."""
    clean = 1.0
    for sentence in re.split(r"(?<=[.!?])(?![.!?])|\n", text or ""):
        words = plain_words(sentence)
        if words:
            names = [n for w in words for n in ["=" + w, *["^" + w[:k] for k in (3, 4, 5, 6) if k <= len(w)]]]
            z = bias + sum(weights.get(zlib.crc32(n.encode()) % 2**18, 0.0) for n in names)
            clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


def test_query_against_plain_scores(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = toxicity.judge_documents(docs, labels).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts) and any(r["predicted"] for r in rows)
    for r in rows:
        want = plain_score(texts[r["doc_id"]], model.bias, model.weights)
        assert r["score"] == pytest.approx(want, abs=1e-9)
        assert r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_fit_climbs_the_likelihood_as_defined():
    """Every weight against the slope of the plain log-likelihood, by differences, step by step."""
    # Documents as lists of sentences, sentences as lists of features.
    docs = [[[0, 1], [2]], [[1]], [[3, 0], [], [2, 2]], [[4]], [[2, 4], [1, 3]], [[0]]]
    y, weight, width = np.array([1.0, 0, 1, 0, 1, 0]), np.array([1.0, 2, 1, 1, 0.5, 3]), 5

    def likelihood(theta):
        total = 0.0
        for doc, label, w in zip(docs, y, weight, strict=True):
            clean = math.prod(1 - 1 / (1 + math.exp(-(theta[width] + sum(theta[f] for f in s)))) for s in doc)
            total += w * (label * math.log(1 - clean) + (1 - label) * math.log(clean))
        return total / weight.sum() - toxicity.DECAY / 2 * sum(t * t for t in theta[:width])

    theta, m, v, eps = np.array([0.0] * width + [toxicity.START]), np.zeros(width + 1), np.zeros(width + 1), 1e-5
    for step in range(1, toxicity.STEPS + 1):
        slope = np.array([(likelihood(theta + eps * e) - likelihood(theta - eps * e)) / (2 * eps) for e in np.eye(width + 1)])
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta + toxicity.RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    sizes = [np.array([len(s) for s in d], "<i4") for d in docs]
    hits = [np.array([f for s in d for f in s], "<i4") for d in docs]
    bias, weights = toxicity._fit(y, weight, sizes, hits, width)
    assert likelihood(np.append(weights, bias)) > likelihood(np.array([0.0] * width + [toxicity.START]))
    assert np.append(weights, bias) == pytest.approx(theta, abs=2e-3)


def test_sample_is_bounded_by_bytes(spark):
    docs = spark.createDataFrame([(i, f"{i:03d} " + "w" * 96) for i in range(60)] + [(100, "x" * 5000), (7, "y" * 100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(60)] + [(100, 0)], "doc_id long, toxic int")
    whole = toxicity.training_sample(docs, labels)
    assert {r["stands"] for r in whole.collect()} == {1.0}
    learned = toxicity.training_rows(labels).count()
    assert whole.count() == learned + (not zlib.crc32(b"7") % 5 == 0)
    cut = toxicity.training_sample(docs, labels, most_bytes=1000).collect()
    by_class = {t: [r for r in cut if r["toxic"] == t] for t in (0, 1)}
    for t, rows in by_class.items():
        assert 8 <= len(rows) <= 10 and sum(len(r["text"]) for r in rows) <= 1000
        assert all(len(r["text"]) < 5000 for r in rows)
        in_class = toxicity.training_rows(labels).where(f"toxic = {t}").count()
        ids = len({r["text"][:3] for r in rows if r["text"][0] != "y"} | {"007" for r in rows if r["text"][0] == "y"})
        assert {r["stands"] for r in rows} == {in_class / ids}


def test_long_texts(spark):
    docs = spark.createDataFrame([(1, "Fine words here. " * 20_000), (2, "a" * 1_000_000), (3, None)], "doc_id long, text string")
    model = toxicity.Model(-5.0, {zlib.crc32(b"=fine") % 2**18: 9.0})
    rows = {r["doc_id"]: r for r in toxicity.score_documents(docs, model).collect()}
    assert rows[1]["score"] > 0.99 and rows[1]["n_toxic_sentences"] == 20_000
    assert rows[2]["score"] == pytest.approx(1 / (1 + math.exp(5))) and rows[3]["score"] == 0
