"""Toxicity by multiple-instance learning: sentence scores, document labels.

A sentence is toxic with probability sigmoid(bias + the weights of its distinct words); a
word's weight is the sum of its features' weights: the word and its first three to six
letters. A document is toxic if any sentence is: ``1 - prod(1 - p)``, a noisy-or. Only
documents have labels; the weights are those under which the documents' labels are likeliest,
so the sentences at fault are found without being labelled.

Fitting uses a bounded sample: at most ``SAMPLE`` labelled training rows per class, those
with the least hash of their id, and of these the first ones that come to ``SAMPLE_BYTES`` of text. Features are hashed to ``BUCKETS`` numbers; the ``FEATURES``
whose presence says most about the label are counted in Spark, and only their occurrences
come to the driver. Scoring covers every text whole, in one pass without a shuffle.

Defined cases: null and empty texts have no sentence and score 0; labels that are null or
that belong to no document are not used; where one class is missing from the training rows
every score is 0; repeated rows score alike; an empty table gives no rows; texts of any length
are scored whole, and one longer than ``SAMPLE_BYTES`` is not learned from; only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.llm.common import add_columns
from streakline.session import stage

SAMPLE, BUCKETS, FEATURES, FOLDS = 6_000, 2**18, 4_096, 5
#: Text of a class that is learned from; the driver gets at most about three times as much in numbers.
SAMPLE_BYTES = 32_000_000
STEPS, RATE, DECAY, START, FIT_BLOCK = 300, 0.1, 1e-4, -5.0, 500
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"[^\W\d_]+")
CACHE = 400_000


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself and its beginnings."""
    names = ["=" + word] + ["^" + word[:n] for n in range(3, 7) if len(word) >= n]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names]


def sentences(text: str | None) -> Iterator[tuple[int, int, set[str]]]:
    """Start, end and distinct lower-case words of each sentence that has a word."""
    for m in SENTENCE.finditer(text or ""):
        words = set(WORD.findall(m[0].lower()))
        if words:
            yield m.start(), m.end(), words


@dataclass
class Model:
    """Weights by hashed feature. ``bias`` None: nothing could be learned."""

    bias: float | None = None
    weights: dict[int, float] = field(default_factory=dict)

    def scorer(self):
        """A function from a text to (score, number of toxic sentences, start and end of the worst)."""
        known: dict[str, float] = {}
        base = float("-inf") if self.bias is None else self.bias

        def weight(word: str) -> float:
            w = known.get(word)
            if w is None:
                if len(known) >= CACHE:
                    known.clear()
                w = known[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
            return w

        def score(text: str | None):
            clean, count, worst, place = 0.0, 0, -1.0, (None, None)
            for start, end, words in sentences(text):
                z = base + sum(map(weight, sorted(words)))
                p = 0.0 if z < -700 else 1 / (1 + np.exp(-z))
                clean += np.log1p(-min(p, 1 - 1e-12))
                count += p >= 0.5
                if p > worst:
                    worst, place = p, (start, end)
            return float(-np.expm1(clean)), int(count), *place

        return score

    def located(self, text: str | None) -> list[tuple[int, int, float]]:
        """Start, end and probability of each sentence that is toxic rather than not."""
        out = []
        for start, end, words in sentences(text):
            z = sum(self.weights.get(f, 0.0) for w in sorted(words) for f in word_features(w))
            p = 0.0 if self.bias is None else float(1 / (1 + np.exp(-(self.bias + z))))
            if p >= 0.5:
                out.append((start, end, p))
        return out


def training_rows(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from."""
    return labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())


def training_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``text, toxic, stands`` of at most ``size`` labelled training rows of each class; stored.

    Where their texts come to more than ``most_bytes`` the first by hash are kept, and each stands for ``stands`` of them.
    """
    keyed = training_rows(labels).select(F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("toxic"))
    picks = [keyed.where(F.col("toxic") == t).orderBy(F.xxhash64("of"), "of").limit(size) for t in (0, 1)]
    picked = stage(picks[0].unionByName(picks[1]))
    texts = docs.select("doc_id", "text").where("text is not null")
    # At most 2 * size narrow rows are broadcast, whatever the tables' sizes.
    met = stage(texts.join(F.broadcast(picked), F.col("doc_id") == F.col("of")).select("of", "text", "toxic"))
    # One row per sampled id, so the windows hold at most ``size`` rows.
    sizes = met.groupBy("toxic", "of").agg(F.sum(F.octet_length("text")).alias("bytes"))
    fits = F.col("bytes") <= most_bytes
    in_order = Window.partitionBy("toxic").orderBy(F.xxhash64("of"), "of").rowsBetween(Window.unboundedPreceding, 0)
    summed = sizes.withColumn("taken", fits & (F.sum(F.when(fits, F.col("bytes"))).over(in_order) <= most_bytes))
    of_class = Window.partitionBy("toxic")
    counted = summed.withColumn("stands", F.count(F.lit(1)).over(of_class) / F.count_if("taken").over(of_class))
    kept = counted.where("taken").select("toxic", "of", "stands")
    return stage(met.join(F.broadcast(kept), ["toxic", "of"]).select("text", "toxic", "stands"))


def _informative(sample: DataFrame, n_pos: int, n_neg: int, count: int) -> list[int]:
    """The hashed features whose presence tells most about the label."""

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                words = set().union(*(w for _, _, w in sentences(text)))
                features = {f for w in words for f in word_features(w)}
                found[toxic, list(features)] += 1
        at = np.flatnonzero(found.sum(axis=0))
        yield pd.DataFrame({"feature": at, "neg": found[0, at], "pos": found[1, at]})

    counts = sample.mapInPandas(present, "feature int, neg bigint, pos bigint")
    sums = counts.groupBy("feature").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    # Chi-square of presence against label, as far as it ranks.
    rate = (F.col("pos") + F.col("neg")) / F.lit(n_pos + n_neg)
    tells = F.pow(F.col("pos") - rate * n_pos, 2) / (rate * n_pos) + F.pow(F.col("neg") - rate * n_neg, 2) / (rate * n_neg)
    best = sums.where("pos + neg >= 3").orderBy(tells.desc(), "feature").limit(count)
    return [r[0] for r in best.select("feature").collect()]


def _fit(y: np.ndarray, weight: np.ndarray, sizes: list[np.ndarray], hits: list[np.ndarray], width: int) -> tuple[float, np.ndarray]:
    """Noisy-or weights by Adam. Per document: its label and weight, the number of features of each
    of its sentences, and their positions, sentence after sentence.

    Gradients are summed over blocks of documents, so that the work space is a block's.
    """
    theta = np.zeros(width + 1)
    theta[-1] = START
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        grad = np.zeros_like(theta)
        for at in range(0, len(y), FIT_BLOCK):
            part = slice(at, at + FIT_BLOCK)
            per_sentence, col = np.concatenate(sizes[part]), np.concatenate(hits[part])
            owner = np.repeat(np.arange(len(y[part])), [len(s) for s in sizes[part]])
            sent = np.repeat(np.arange(len(per_sentence)), per_sentence)
            z = theta[-1] + np.bincount(sent, theta[col], len(per_sentence))
            p = np.clip(1 / (1 + np.exp(-np.clip(z, -500, 500))), 1e-12, 1 - 1e-9)
            log_clean = np.bincount(owner, np.log1p(-p), len(y[part]))
            toxic = np.maximum(-np.expm1(log_clean), 1e-12)
            pull = weight[part] * (y[part] * np.exp(log_clean) / toxic - (1 - y[part]))
            dz = pull[owner] * p
            grad += np.append(np.bincount(col, dz[sent], width), dz.sum())
        grad /= weight.sum()
        grad[:-1] -= DECAY * theta[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return float(theta[-1]), theta[:-1]


def train(
    docs: DataFrame, labels: DataFrame, size: int = SAMPLE, features: int = FEATURES, most_bytes: int = SAMPLE_BYTES
) -> Model:
    """A model from the training rows of ``labels``."""
    sample = training_sample(docs, labels, size, most_bytes)
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return Model()
    chosen = _informative(sample, counts[1], counts[0], features)
    place = {f: i for i, f in enumerate(chosen)}

    def compact(text):
        found = [
            [place[f] for w in sorted(words) for f in word_features(w) if f in place] for _, _, words in sentences(text)
        ]
        return np.array([len(x) for x in found], "<i4").tobytes(), np.array([p for x in found for p in x], "<i4").tobytes()

    # Numbers come packed: the driver never holds the sample as lists.
    rows = add_columns(sample, lambda: compact, "sizes binary, hits binary", keep=("toxic", "stands")).where("length(sizes) > 0").collect()
    rows.sort(key=lambda r: (r["toxic"], bytes(r["sizes"]), bytes(r["hits"])))
    if len({r["toxic"] for r in rows}) < 2:
        return Model()
    sizes, hits = ([np.frombuffer(r[c], "<i4") for r in rows] for c in ("sizes", "hits"))
    y = np.array([r["toxic"] for r in rows])
    # Where a class was sampled its rows stand for all of it, so scores keep the labels' odds.
    totals = {r["toxic"]: r["count"] for r in training_rows(labels).groupBy("toxic").count().collect()}
    weight = np.array([max(1.0, totals[t] / size) for t in (0, 1)])[y] * np.array([r["stands"] for r in rows])
    bias, weights = _fit(y.astype(float), weight, sizes, hits, len(chosen))
    return Model(bias, {f: float(weights[i]) for f, i in place.items()})


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, n_toxic_sentences, worst_start, worst_end`` of every row."""
    ddl = "score double, n_toxic_sentences bigint, worst_start bigint, worst_end bigint"
    return add_columns(docs, model.scorer, ddl)


def toxic_sentences(docs: DataFrame, model: Model) -> DataFrame:
    """One row per toxic sentence: ``doc_id, start, end, score`` (code points, end exclusive)."""
    found = add_columns(docs, lambda: lambda t: (model.located(t),), "s array<struct<start:bigint,end:bigint,score:double>>")
    return found.select("doc_id", F.explode("s").alias("s")).select("doc_id", "s.*")


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted`` and the place of the worst sentence."""
    scored = score_documents(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_toxic_sentences",
        "worst_start",
        "worst_end",
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all their columns."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for t in texts:
            yield pd.Series([scorer(x)[0] for x in t], dtype="float64")

    return docs.where(score(F.col("text")) < 0.5)
