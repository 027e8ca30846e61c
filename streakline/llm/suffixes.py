"""Suffix-array dedup: remove bytes of strings that also start earlier.

What runs is anchored window names, not a suffix array: a 64-bit name of each position's string is
made by doubling within a task (the name at 2k from those at p and p + k), and Spark groups and
counts the names of anchors, of the blocks around them and, where blocks differ, of windows; see
``repeats.py``. The README says why the rounds of sorted rank pairs over all positions are not run.

Defined cases: a null text is empty; texts shorter than the threshold lose nothing; a null id
comes before all others. Rows of one id are documents of their own, in the order of a hash of
their texts, so of rows equal in both each but one is wholly earlier text. Texts of any length are
read whole. An empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from streakline.llm.common import add_columns
from streakline.llm.repeats import covered, repeated_stretches, with_id

LENGTH, GRAM = 100, 24


def byte_codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)


def kept_bytes(text: str, spans: list[dict] | None, length: int = LENGTH) -> tuple[bytes, int, int]:
    """The remaining bytes, how many went, and in how many runs."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    gone = covered(len(data), spans, length)
    starts = gone & ~np.append(False, gone[:-1]) if len(gone) else gone
    return data[~gone].tobytes(), int(gone.sum()), int(starts.sum())


def _marked(docs: DataFrame, length: int) -> DataFrame:
    return repeated_stretches(docs, byte_codes, length, min(GRAM, length), keep_first=True)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, kept``: the remaining bytes of each text (binary: a cut may split a character)."""
    out = add_columns(_marked(docs, length), lambda: lambda t, s: kept_bytes(t, s, length)[:1], "kept binary", ["text", "spans"], ["id"])
    return with_id(docs, out, ["kept"])


def measure_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""

    def one(text, spans):
        kept, removed, runs = kept_bytes(text, spans, length)
        return len(kept) + removed, removed, runs, hashlib.sha256(kept).hexdigest()

    ddl = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    out = add_columns(_marked(docs, length), lambda: one, ddl, ["text", "spans"], ["id"])
    return with_id(docs, out, ["n_bytes", "n_removed", "n_spans", "kept_sha256"])
