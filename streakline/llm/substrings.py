"""Substring dedup: remove word sequences that also stand elsewhere.

Two levels run: windows of ``length // 2 + 1`` words, by their anchors alone, and of those that
repeat the ``length``-word windows around them, which decide. The names of both are made at once,
by doubling within a task; candidates are not carried through further levels. See ``repeats.py``
for how, and the README for why.

Defined cases: null and empty texts have no words; texts of fewer words than a window lose
nothing; a row that is repeated is repeated text, so every window of it is removed from each
of its copies; documents of one id are documents of their own; an empty table gives no rows;
only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import add_columns
from streakline.llm.repeats import covered, repeated_stretches, with_id

LENGTH = 35


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def word_codes(text: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words_of(text)], np.uint64)


def kept_words(text: str, spans: list[dict] | None, length: int = LENGTH) -> list[bytes]:
    words = words_of(text)
    gone = covered(len(words), spans, length)
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text``: each text's words that no repeated window covers, joined by one space."""
    marked = repeated_stretches(docs, word_codes, length, length // 2 + 1, keep_first=False)
    kept = lambda: lambda text, spans: (b" ".join(kept_words(text, spans, length)).decode("utf-8", "replace"),)
    return with_id(docs, add_columns(marked, kept, "kept string", ["text", "spans"], ["id"]), [F.col("kept").alias("text")])


def measure_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""

    def one(text, spans):
        n, kept = len(words_of(text)), kept_words(text, spans, length)
        return n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    marked = repeated_stretches(docs, word_codes, length, length // 2 + 1, keep_first=False)
    ddl = "n_words bigint, n_removed bigint, kept_sha256 string"
    out = add_columns(marked, lambda: one, ddl, ["text", "spans"], ["id"])
    return with_id(docs, out, ["n_words", "n_removed", "kept_sha256"])
