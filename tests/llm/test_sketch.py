from __future__ import annotations

import hashlib

import numpy as np
import pytest

from streakline.llm import sketch
from tests.llm.conftest import odd_rows


MASK = 2**64 - 1


def plain_sketch(text: str) -> list[int]:
    """The kept hashes by definition, in plain whole numbers."""
    data = text.encode()
    grams = {data[i : i + 8] for i in range(max(1, len(data) - 7))} if data else set()
    hashes = set()
    for g in grams:
        x = int.from_bytes(g, "little") | (len(data) << 56 if len(data) < 8 else 0)
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
        x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
        hashes.add((x ^ x >> 31) >> 32)
    kept = sorted(h for h in hashes if h < 2**32 // 16)
    return kept or sorted(hashes)[:1]


def plain_like(a: list[int], b: list[int]) -> float:
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def plain_contained(a: list[int], b: list[int]) -> float:
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def expected(rows):
    ordered = sorted(((-(2**63) if i is None else i, t or "") for i, t, *_ in rows))
    out = []
    for (i, t), (_, n) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        edited = t[: len(t) - len(t) // 4] + n[: len(t) // 4]
        own, changed, after = (plain_sketch(x) for x in (t, edited, n))
        text = lambda kept: "".join(f"{h:08x}" for h in kept)
        out.append(
            (None if i == -(2**63) else i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(own), text(changed))
            + (plain_like(own, changed), plain_like(own, after), plain_contained(own, after))
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [24_000_000, 2_000])
def test_odd(odd, monkeypatch, size):
    monkeypatch.setattr(sketch, "RANGE_BYTES", size)
    assert sorted(map(tuple, sketch.compare_edits(odd).collect()), key=str) == expected(odd_rows())


def test_documents(documents, monkeypatch):
    monkeypatch.setattr(sketch, "RANGE_BYTES", 20_000)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, sketch.compare_edits(documents).collect()), key=str) == expected(rows)


def test_one_document_is_its_own_next(spark):
    docs = spark.createDataFrame([(1, "one text only, long enough")], "doc_id long, text string")
    r = sketch.compare_edits(docs).first()
    assert r["near_next"] == 1.0 and r["n_chars"] == 26


def test_sketches_merge_and_estimate_containment():
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in rng.integers(0, 10**6, 20_000)]
    part, rest = " ".join(words[:4_000]), " ".join(words[4_000:])
    whole = sketch.sketch(f"{part} {rest}")
    a, b = sketch.sketch(part), sketch.sketch(rest)
    merged = sketch.merge(a, b)
    # Only the shingles across the seam are missing.
    assert len(np.setdiff1d(whole, merged)) <= sketch.GRAM and not len(np.setdiff1d(merged, whole))
    assert sketch.containment(a, whole) == 1.0 and abs(sketch.containment(whole, a) - 0.2) < 0.03
    assert (sketch.from_text(sketch.to_text(a)) == a).all()


def test_edited_texts_are_nearer_than_the_next(documents):
    rows = sketch.compare_edits(documents).where("n_chars > 400").collect()
    assert all(r["near_edited"] > r["near_next"] for r in rows if r["near_next"] < 0.3)


def test_fingerprints(odd):
    rows = sketch.fingerprints(odd).collect()
    assert sorted(r["fingerprint"] for r in rows) == sorted(sketch.to_text(sketch.sketch(t)) for _, t, *_ in odd_rows())


def test_empty(none):
    assert sketch.compare_edits(none).collect() == []
