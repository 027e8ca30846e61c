"""Personal data: patterns, and a skip-chain conditional random field that adds to them.

The patterns find e-mail addresses, IP addresses, card and phone numbers. Further mentions
are left to the field: a document's candidates are the pattern matches, other numbers of
seven or more digits, and words that equal the name of a matched e-mail address. Each has a
label, one of the four kinds or none. Neighbouring candidates share a chain potential;
distant ones that are equal, or one of which ends the other, share a skip potential that
favours one label for both. Matches of a pattern are observed; the labels of the others
follow from loopy belief propagation over the whole document, and those that are rather a
kind than none are added. Equal candidates are linked one to the next, and each that is not
matched to the first match of its key or of a similar one, so that a match reaches all its
repeats; the links stay linear in the candidates. Messages run until they settle, at most as
many rounds as there are candidates (``ROUNDS`` at least).

Weights are trained by pseudo-likelihood on the candidates of at most ``SAMPLE`` documents,
those with the least hash of their text that come to at most ``SAMPLE_BYTES``: matches have
their kind, numbers that resemble no match have none, and the others teach nothing.

Defined cases: null and empty texts have no spans; without candidates to learn from
nothing is added; repeated rows are judged alike; an empty table gives no rows; texts of any
length are judged whole, and one longer than ``SAMPLE_BYTES`` is not learned from; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streakline.llm.common import add_columns
from streakline.session import stage

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE, NONE = range(5)
SAMPLE, STEPS, RATE, DECAY, ROUNDS, DAMPING = 4_000, 300, 0.1, 1e-3, 50, 0.3
#: Text that is learned from; a candidate of ten bytes comes to the driver as some 250.
SAMPLE_BYTES = 24_000_000

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARDS = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONES = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9])*")
NAME = re.compile(r"[A-Za-z0-9._%+-]{3,}")
NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    back = [int(c) for c in reversed(digits)]
    return (sum(back[::2]) + sum(sum(divmod(2 * d, 10)) for d in back[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each ``@`` so that long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield EMAIL, start, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[Span]:
    """Of a row of dotted numbers each four in turn, as the pattern meets them."""
    for m in DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            # Long rows of digits are not turned into numbers.
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield IP, at, end
            at = end + 1


def base_spans(text: str | None) -> list[Span]:
    """Pattern matches (kind, start, end) by start, then kind."""
    if not text:
        return []
    found = list(_emails(text)) if "@" in text else []
    if re.search("[0-9]", text):
        found += _addresses(text)
        for m in CARDS.finditer(text):
            digits = NOT_DIGIT.sub("", m[0]) if m.end() - m.start() <= 40 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((CARD, m.start(), m.end()))
        for m in PHONES.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((PHONE, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def candidates(text: str | None) -> list[tuple[int, int, int, str]]:
    """``start, end, label, key`` of a text's candidates; label -1: not matched by a pattern."""
    base = base_spans(text)
    found = [(a, b, kind, text[a:b].lower() if kind == EMAIL else NOT_DIGIT.sub("", text[a:b])) for kind, a, b in base]
    if not text or not re.search("[0-9@]", text):
        return found
    starts = np.array([a for _, a, _ in base], np.int64)
    # The furthest end so far tells whether a stretch meets any span that starts before its end.
    ends = np.maximum.accumulate([b for *_, b in base]) if base else np.array([], np.int64)

    def free(a: int, b: int) -> bool:
        before = int(np.searchsorted(starts, b)) - 1
        return before < 0 or ends[before] <= a

    for m in NUMBER.finditer(text):
        key = NOT_DIGIT.sub("", m[0])
        if len(key) >= 7 and free(*m.span()):
            found.append((*m.span(), -1, key))
    names = {k.partition("@")[0] for _, _, label, k in found if label == EMAIL}
    names = {n for n in names if len(n) >= 3}
    if names:
        for m in NAME.finditer(text):
            key = m[0].rstrip(".").lower()
            end = m.start() + len(key)
            if key in names and free(m.start(), end):
                found.append((m.start(), end, -1, key))
    return sorted(found)


def features(text: str, start: int, end: int, key: str) -> list[float]:
    shown, digits = text[start:end], len(NOT_DIGIT.sub("", key))
    numeric = digits == len(key)
    parts = shown.split(".")
    return [
        1.0,
        *[float(numeric and low <= digits <= high) for low, high in ((7, 8), (9, 11), (12, 15), (16, 16), (17, 19), (20, 10**9))],
        *[float(c in shown) for c in "+(@.- "],
        float(numeric and 12 <= digits <= 19 and luhn(key)),
        float(numeric and len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts)),
        float(not numeric),
    ]


WIDTH = 16


def links(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int]]:
    """Edges (kind, i, j): 0 between neighbours, 1 to an equal, 2 to one that ends the other.

    Edges go to the next such mention, and from each unmatched mention to the first match.
    """
    edges = [(0, i, i + 1) for i in range(len(found) - 1)]
    last: dict[str, int] = {}
    match: dict[str, int] = {}
    unmatched: dict[str, list[int]] = {}
    for i, (_, _, label, key) in enumerate(found):
        if key in last:
            edges.append((1, last[key], i))
        last[key] = i
        if label >= 0:
            match.setdefault(key, i)
        else:
            unmatched.setdefault(key, []).append(i)
    joined = set(edges)

    def star(kind: int, key: str, hub: int) -> None:
        rays = [(kind, min(hub, i), max(hub, i)) for i in unmatched.get(key, ())]
        # What the rows link already is not linked twice.
        edges.extend(e for e in rays if e not in joined)
        joined.update(rays)

    for key, hub in match.items():
        star(1, key, hub)
    # Similar: an e-mail's name, or a number's last digits, seven at least.
    by_end: dict[str, dict[int, None]] = {}
    for key, i in last.items():
        end = key.partition("@")[0] if "@" in key else key[-7:] if key.isdigit() else key
        alike = by_end.setdefault(end, {})
        for j in reversed(alike):
            other = found[j][3]
            if "@" in key or "@" in other or key.endswith(other) or other.endswith(key):
                edges.append((2, min(i, j), max(i, j)))
                joined.add(edges[-1])
                for a, b in ((key, other), (other, key)):
                    if a in match and b not in match:
                        star(2, b, match[a])
                break
        alike[i] = None
    return edges


@dataclass
class Field:
    """Weights: features by label, neighbour labels, and agreement over each kind of skip edge."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def empty(cls) -> Field:
        """Knows of no kind, so it adds nothing."""
        unary = np.zeros((WIDTH, 5))
        unary[0, NONE] = 1.0
        return cls(unary, np.zeros((5, 5)), np.zeros(2))

    def potentials(self, edges: list[tuple[int, int, int]]) -> np.ndarray:
        same = np.eye(5)
        return np.array([self.chain if kind == 0 else self.skip[kind - 1] * same for kind, _, _ in edges]).reshape(-1, 5, 5)

    def marginals(self, text: str, found: list[tuple[int, int, int, str]]) -> np.ndarray:
        """Label probabilities of each candidate, by damped sum-product."""
        own = np.array([features(text, a, b, k) for a, b, _, k in found]) @ self.unary
        for i, (_, _, label, _) in enumerate(found):
            if label >= 0:
                own[i] = np.where(np.arange(5) == label, 0.0, -1e9)
        edges = links(found)
        if edges:
            # Each edge in both directions; messages are in logarithms.
            pair = self.potentials(edges)
            pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
            a, b = (np.array([e[x] for e in edges] + [e[y] for e in edges]) for x, y in ((1, 2), (2, 1)))
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            message = np.zeros((len(a), 5))
            for _ in range(max(ROUNDS, len(found))):
                total = own.copy()
                np.add.at(total, b, message)
                new = np.logaddexp.reduce((total[a] - message[back])[:, :, None] + pair, axis=1)
                new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
                moved = np.abs(new - message).max()
                message = DAMPING * message + (1 - DAMPING) * new
                if moved < 1e-6:
                    break
            own = own.copy()
            np.add.at(own, b, message)
        return np.exp(own - np.logaddexp.reduce(own, axis=1, keepdims=True))

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """Pattern matches, and all spans: those and the added ones."""
        found = candidates(text)
        base = [(label, a, b) for a, b, label, _ in found if label >= 0]
        added = []
        if any(label < 0 for *_, label, _ in found):
            chances = self.marginals(text, found)
            for (a, b, label, _), p in zip(found, chances, strict=True):
                if label < 0 and p.argmax() != NONE:
                    added.append((int(p.argmax()), a, b))
        order = lambda s: (s[1], s[0], s[2])
        return sorted(base, key=order), sorted(base + added, key=order)


def _examples(text: str) -> list[tuple[list[float], int, list[float], list[float]]]:
    """Features, label, labels of neighbours and agreeing labels over skip edges, per labelled candidate."""
    found = candidates(text)
    edges = links(found)
    alike = {i for kind, *ends in edges if kind for i in ends}
    label = [x if x >= 0 else (-1 if i in alike else NONE) for i, (_, _, x, _) in enumerate(found)]
    near, agree = np.zeros((len(found), 5)), np.zeros((len(found), 10))
    for kind, i, j in edges:
        for x, y in ((i, j), (j, i)):
            if label[y] >= 0:
                if kind == 0:
                    near[x, label[y]] += 1
                else:
                    agree[x, 5 * (kind - 1) + label[y]] += 1
    return [
        (features(text, a, b, k), label[i], near[i].tolist(), agree[i].tolist())
        for i, (a, b, _, k) in enumerate(found)
        if label[i] >= 0
    ]


def sampled_texts(docs: DataFrame, size: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> DataFrame | None:
    """``text``: at most ``size`` different texts that may have candidates, the first by hash that come to ``most_bytes``."""
    texts = docs.select("text").where(F.col("text").rlike("[0-9@]") & (F.octet_length("text") <= most_bytes))
    # Hashes are ordered, not texts: few rows and no text pass through the ordering task.
    marks = texts.groupBy(F.xxhash64("text").alias("mark")).agg(F.max(F.octet_length("text")).cast("bigint").alias("bytes"))
    first = stage(marks.orderBy("mark").limit(size))
    so_far = F.sum("bytes").over(Window.orderBy("mark").rowsBetween(Window.unboundedPreceding, 0))
    bound = first.withColumn("so_far", so_far).where(F.col("so_far") <= most_bytes).agg(F.max("mark")).first()[0]
    return None if bound is None else texts.where(F.xxhash64("text") <= bound).dropDuplicates(["text"])


def train(docs: DataFrame, size: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Field:
    """Fit the field on the candidates of ``sampled_texts``."""
    sample = sampled_texts(docs, size, most_bytes)
    if sample is None:
        return Field.empty()

    def packed(text):
        return (np.array([[*f, y, *near, *agree] for f, y, near, agree in _examples(text)], "<f8").tobytes(),)

    # Numbers come packed: the driver never holds the examples as lists.
    rows = add_columns(sample, lambda: packed, "e binary", keep=()).where("length(e) > 0").collect()
    examples = np.frombuffer(b"".join(bytes(r["e"]) for r in rows), "<f8").reshape(-1, WIDTH + 16)
    if not len(examples):
        return Field.empty()
    # One order, whatever the order of the rows.
    examples = examples[np.lexsort(examples.T[::-1])]
    f, labels, near, agree = np.split(examples, [WIDTH, WIDTH + 1, WIDTH + 6], axis=1)
    y = np.eye(5)[labels[:, 0].astype(int)]
    agree = agree.reshape(-1, 2, 5)
    theta = np.zeros(WIDTH * 5 + 25 + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        field = _split(theta)
        z = f @ field.unary + near @ field.chain + np.einsum("k,nkl->nl", field.skip, agree)
        p = np.exp(z - np.logaddexp.reduce(z, axis=1, keepdims=True))
        d = (y - p) / len(y)
        chain = near.T @ d
        grad = np.concatenate([(f.T @ d).ravel(), ((chain + chain.T) / 2).ravel(), np.einsum("nkl,nl->k", agree, d)]) - DECAY * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return _split(theta)


def _split(theta: np.ndarray) -> Field:
    cut = WIDTH * 5
    return Field(theta[:cut].reshape(WIDTH, 5), theta[cut : cut + 25].reshape(5, 5), theta[cut + 25 :])


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (pattern matches), ``base_sha256, spans, n_added``."""
    field = field or train(docs)

    def one(text):
        base, every = field.spans(text)
        counts = [sum(k == kind for k, _, _ in base) for kind in range(4)]
        return *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every), len(every) - len(base)

    ddl = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return add_columns(docs, lambda: one, ddl)


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, or stretch of overlapping spans, replaced by its kind."""
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return text if not spans else "".join(out) + text[done:]


def mask_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with personal data masked in ``text``; ``n_chars``, if there, follows it."""
    field = field or train(docs)
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), "text")
    clean = add_columns(rows, lambda: lambda t: (masked(t, field.spans(t)[1]),), "clean string", keep=("rest",))
    columns = [F.col("rest")[c].alias(c) if c in rest else F.col("clean").alias(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        at = docs.columns.index("n_chars")
        columns[at] = F.length("clean").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return clean.select(*columns)
