"""Document fingerprints: threshold-scaled sketches of shingle hashes.

A text's shingles are its runs of eight UTF-8 bytes (a shorter text is one shingle).
The sketch keeps every shingle hash below a fixed fraction of the hash range, so its
size follows the text's length, the union of two sketches is the sketch of both texts,
and shared over own hashes estimate containment however unequal the lengths are. A text
with no hash below the threshold keeps its smallest one instead; ``merge`` drops such a
stand-in beside hashes below the threshold. Texts of any length are read whole.

A fingerprint is the kept hashes, ascending, as eight hex digits each. Likeness is the
share of common hashes among all of two fingerprints.

Defined cases: a null text counts as empty; the empty text has the empty fingerprint,
which is like itself (1.0) and unlike any other (0.0). Documents are ordered by id, null
first, those of one id by their texts; a single document is its own next one. Repeated
rows are documents of their own. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from streakline.llm.common import SLICE_ROWS, add_columns

GRAM, SCALE = 8, 16
LIMIT = np.uint32(2**32 // SCALE)
RANGE_BYTES, MAX_RANGES = 24_000_000, 65_536
LEAST = -(2**63)
COMPARED = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_next double"
)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(text: str | None) -> np.ndarray:
    """The kept hashes of a text, ascending and distinct."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return np.empty(0, np.uint32)
    if len(data) < GRAM:
        grams = np.array([int.from_bytes(data, "little") | len(data) << 56], np.uint64)
    else:
        grams = np.ndarray((len(data) - GRAM + 1,), np.dtype("<u8"), data, strides=(1,))
    hashes = (mixed(grams) >> np.uint64(32)).astype(np.uint32)
    kept = hashes[hashes < LIMIT]
    return np.unique(kept) if len(kept) else hashes.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both texts."""
    both = np.union1d(a, b)
    below = both[both < LIMIT]
    return below if len(below) else both[:1]


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first text's shingles that the second has."""
    return shared(a, b) / len(a) if len(a) else float(not len(b))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    common = shared(a, b)
    return common / (len(a) + len(b) - common)


def to_text(kept: np.ndarray) -> str:
    return kept.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    return add_columns(docs, lambda: lambda t: (to_text(sketch(t)),), "fingerprint string")


def _range_starts(keys: DataFrame, ranges: int) -> np.ndarray:
    """The least key of each of about ``ranges`` ranges of equal size; at most ``MAX_RANGES`` numbers."""
    dealt = keys.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("range"))
    return np.unique([r[0] for r in dealt.agg(F.min("key")).select("min(key)").collect()])


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``range, late, key, doc_id, text`` in ranges of ascending id.

    The first document of a range comes once more, with ``late`` = 1, at the end of the range
    before, the very first one at the end of the last; so each document's next one stands in
    its own range. Texts are shuffled once.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("key"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = int(min(MAX_RANGES, max(1, size // RANGE_BYTES)))
    starts = _range_starts(rows.select("key"), ranges)
    if not len(starts):
        starts = np.array([LEAST])

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, key.to_numpy(), side="right") - 1)

    @F.pandas_udf("boolean")
    def is_first(key: pd.Series) -> pd.Series:
        return pd.Series(starts[np.searchsorted(starts, key.to_numpy(), side="right") - 1] == key.to_numpy())

    own = F.struct(F.col("range"), F.lit(0).alias("late"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"), F.lit(1).alias("late"))
    places = F.when(F.col("first"), F.array(own, before)).otherwise(F.array(own))
    placed = rows.withColumns({"range": range_of("key"), "first": is_first("key")})
    spread = placed.select(F.explode(places).alias("at"), "key", "doc_id", "text").select("at.*", "key", "doc_id", "text")
    # Each range is a task of its own; hashed, several would meet in one.
    return spread.repartitionById(len(starts), "range").sortWithinPartitions("range", "late", "key", "text")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    The edited text has the last quarter of the code points replaced by the first as many of
    the next document. ``contained_next`` is the containment of the document in the next one.
    """
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(COMPARED).fields])
    target = to_arrow_schema(schema)

    def compared(doc_id, text, own, next_text, next_own):
        n = len(text)
        edited = text[: n - n // 4] + next_text[: n // 4]
        changed = sketch(edited)
        return (
            doc_id,
            n,
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            to_text(own),
            to_text(changed),
            likeness(own, changed),
            likeness(own, next_own),
            containment(own, next_own),
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                out = []
                for row in whole.slice(at, SLICE_ROWS).to_pylist():
                    text, own = row["text"], sketch(row["text"])
                    if waiting is not None and waiting[0] == row["range"]:
                        out.append(compared(*waiting[1:], text, own))
                    waiting = None if row["late"] else (row["range"], row["doc_id"], text, own)
                columns = [[r[i] for r in out] for i in range(len(target))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target
                )

    return with_next(docs).select("range", "late", "doc_id", "text").mapInArrow(each, schema)
