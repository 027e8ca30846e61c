"""Exact dedup through an extendible-hash index on shared files.

1. *Entries.* Each task folds equal texts of a buffer into one entry: key (64-bit hash), text and
   the ids of its rows. A first pass counts entries and their bytes per key, without texts.
2. *Directory.* It maps the leading bits of a key to a bucket, so a bucket is a range of keys. It
   starts at the depth that the total calls for and doubles while a bucket holds more than
   ``BUCKET_BYTES`` and more than one key: only such buckets split.
3. *Owners.* A second pass sends each entry to the task that owns its bucket. That task reads
   its range in key order. Entries of one key form a chain of different texts; each entry's
   bytes are compared with the chain's, so a collision never joins two texts. Owners write
   their part of the index to the shared folder: key, place in the chain, ids. Groups are
   aggregated from there. Texts are shuffled once and not stored.

A text that is copied in very many tasks has as many entries of one key, which no split parts.
Such a key is dealt over parts of at most ``FAN`` entries each, which go to different owners, and
the heads of their chains, stored with their texts, meet in further rounds. So a task holds a
buffer, or the different texts of one key, and never the rows of a group.

Defined cases: null and empty texts are equal; only A-Z lose their case; of rows equal in text and
id one stays; a null id stays only where all ids of a group are null; an empty table gives no
rows; texts of any length are compared whole; only ``doc_id`` and ``text`` are read, and in
``drop_duplicates`` all columns pass through.
"""

from __future__ import annotations

import hashlib
import math
import string
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from streakline.functions.ordered import number_all
from streakline.functions.sizing import broadcast_if_small
from streakline.llm.common import SLICE_ROWS
from streakline.session import stage

BUCKET_BYTES = 64_000_000
BUFFER_BYTES, BUFFER_ROWS = 32_000_000, 50_000
FAN = 4_000
KEY_BITS = 64
#: The directory has about 100 bytes for every ``BUCKET_BYTES / 2`` of text; past this it is not broadcast.
DIRECTORY_BYTES = 64_000_000

Hash = Callable[[bytes], int]

ENTRY = "h bigint, bytes bigint, text binary, sha256 string, ids array<bigint>, at int"
SIZE = "h bigint, bytes bigint"


def key_of(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# --- Entries -----------------------------------------------------------------------------


class _Buffer:
    """Rows of a task with equal texts folded; keys lead to chains of texts compared by their bytes."""

    def __init__(self, key: Hash):
        self.key, self.chains, self.size, self.rows = key, {}, 0, 0

    def add(self, text: bytes, id_: int | None) -> None:
        chain = self.chains.setdefault(self.key(text), [])
        ids = next((i for t, i in chain if t == text), None)
        if ids is None:
            chain.append((text, [id_]))
            self.size += len(text)
        else:
            ids.append(id_)
        self.rows += 1

    def full(self) -> bool:
        return self.size >= BUFFER_BYTES or self.rows >= BUFFER_ROWS

    def entries(self) -> Iterator[tuple[int, bytes, list[int | None]]]:
        """Key, text and ids of each entry; the buffer is empty afterwards."""
        for h, chain in self.chains.items():
            for text, ids in chain:
                yield h - 2**64 if h >= 2**63 else h, text, ids
        self.__init__(self.key)


def _folded(docs: DataFrame, key: Hash, row: Callable[[int, bytes, list], tuple], ddl: str) -> DataFrame:
    """``row`` of every entry of every buffer."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def packed(held: _Buffer) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for entry in held.entries():
            rows.append(row(*entry))
            size += len(entry[1])
            if size > BUFFER_BYTES // 8:
                yield _batch(rows, schema)
                rows, size = [], 0
        if rows:
            yield _batch(rows, schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Buffer(key)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                texts = pc.ascii_lower(b.column("text")).cast(pa.large_binary()).to_pylist()
                for text, id_ in zip(texts, b.column("doc_id").to_pylist(), strict=True):
                    held.add(text, id_)
                    if held.full():
                        yield from packed(held)
        yield from packed(held)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(fold, ddl)


def entry_sizes(docs: DataFrame, key: Hash = key_of) -> DataFrame:
    """``h, n, bytes``: how many entries a key has, and their bytes; stored."""
    sizes = _folded(docs, key, lambda h, text, ids: (h, len(text)), SIZE)
    return stage(sizes.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")))


def entries(docs: DataFrame, key: Hash = key_of) -> DataFrame:
    """``h, bytes, text, sha256, ids, at`` (where the largest id stands in ``ids``)."""

    def row(h, text, ids):
        at = max(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, -i))
        return h, len(text), text, hashlib.sha256(text).hexdigest(), ids, at

    return _folded(docs, key, row, ENTRY)


# --- Directory -----------------------------------------------------------------------------


def _prefix(depth: int) -> Column:
    """The leading ``depth`` bits of a key; a shift by all 64 bits would do nothing."""
    return F.shiftrightunsigned("h", KEY_BITS - depth) if depth else F.lit(0).cast("bigint")


def directory(sizes: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``depth, prefix, bucket`` (numbered from 0 in key order) for the keys of ``sizes`` (``h, bytes``); stored.

    Every doubling reads only what the one before left overfull.
    """
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(total, 1) / bucket_bytes)))
    cells, settled = sizes.select("h", "bytes"), []
    while True:
        counted = stage(
            cells.groupBy(_prefix(depth).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("keys"))
        )
        over = (F.col("bytes") > bucket_bytes) & (F.col("keys") > 1) & F.lit(depth < KEY_BITS)
        low = F.shiftleft("prefix", KEY_BITS - depth) if depth else F.lit(0).cast("bigint")
        settled.append(counted.where(~over).select(F.lit(depth).alias("depth"), "prefix", low.alias("low")))
        overfull = counted.where(over).select("prefix")
        if overfull.isEmpty():
            return stage(number_all(stage(reduce(DataFrame.unionByName, settled)), ["low"], "bucket", start=0).drop("low"))
        cells = stage(cells.withColumn("prefix", _prefix(depth)).join(overfull, "prefix", "left_semi").drop("prefix"))
        depth += 1


def in_buckets(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``: an equi-join per depth that occurs."""
    # A bucket's depth is one of at most 65 numbers.
    depths = [r["depth"] for r in buckets.select("depth").distinct().collect()] or [0]
    places = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths])
    tried = rows.withColumn("place", F.explode(places)) if len(depths) > 1 else rows.withColumn("place", places[0])
    # The text stays out of the join's keys; a directory within its bound goes to the rows.
    return tried.select("*", "place.*").join(broadcast_if_small(buckets, DIRECTORY_BYTES), ["depth", "prefix"]).drop("place", "depth", "prefix")


# --- Owners ----------------------------------------------------------------------------------

PLACE = ["h", "part", "nth"]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each entry with ``nth``, the place of its text in the chain of its key and part, and is it the first there?"""
    at, chain = None, []
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(start, SLICE_ROWS)
            nth, first = [], []
            texts = b.column("text")
            for i, place in enumerate(zip(b.column("h").to_pylist(), b.column("part").to_pylist(), strict=True)):
                if place != at:
                    at, chain = place, []
                text = texts[i].as_buffer()
                found = next((n for n, t in enumerate(chain) if t.equals(text)), None)
                first.append(found is None)
                if found is None:
                    found = len(chain)
                    chain.append(pa.py_buffer(text.to_pybytes()))
                nth.append(found)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nth, pa.int64()), pa.array(first)], names=[*b.schema.names, "nth", "first"])


def _owned(rows: DataFrame, owners: int) -> DataFrame:
    """``rows`` (with ``h, part, bucket, text``) in the task of their bucket, chained."""
    # Parts of one key go to owners next to each other.
    owner = F.pmod(F.col("bucket") + F.col("part"), F.lit(owners)).cast("int")
    dealt = rows.repartitionById(owners, owner).drop("bucket").sortWithinPartitions("h", "part")
    ddl = StructType([*dealt.schema.fields, *StructType.fromDDL("nth bigint, first boolean").fields])
    return dealt.mapInArrow(_chained, ddl)


def _parts(fan: int) -> Column:
    """Which part of its key, of ``n`` entries, a row goes to."""
    parts = F.ceil(F.col("n") / fan)
    return F.coalesce(F.when(F.col("n") > fan, F.pmod(F.xxhash64("spread", F.lit(fan)), parts)), F.lit(0)).cast("bigint")


def index(docs: DataFrame, key: Hash = key_of, fan: int = FAN, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``entry, h, root_part, root_nth, sha256, ids, at``: entries of one text have one key and root; stored."""
    sizes = entry_sizes(docs, key)
    buckets = directory(sizes, bucket_bytes)
    owners = max(1, buckets.count())
    # At most all entries over ``fan`` keys are crowded.
    crowded = stage(sizes.where(F.col("n") > fan).select("h", "n"))
    hot = crowded.count() > 0
    rows = entries(docs, key)
    if hot:
        # What an entry's place depends on is its own content, so a repeated task deals alike.
        rows = rows.join(broadcast_if_small(crowded), "h", "left").withColumn("spread", F.xxhash64("ids"))
        rows = rows.withColumn("part", _parts(fan)).drop("spread", "n")
    else:
        rows = rows.withColumn("part", F.lit(0).cast("bigint"))
    placed = in_buckets(rows, buckets).select("h", "part", "bucket", "text", "sha256", "ids", "at")
    chained = _owned(placed, owners)
    # Only heads of the chains of crowded keys are needed again.
    if hot:
        crowd = crowded.select("h", F.lit(True).alias("dealt"))
        chained = chained.join(broadcast_if_small(crowd), "h", "left")
    else:
        chained = chained.withColumn("dealt", F.lit(None).cast("boolean"))
    text = F.when(F.col("dealt") & F.col("first"), F.col("text")).alias("text")
    found = stage(chained.select(F.monotonically_increasing_id().alias("entry"), *PLACE, text, "sha256", "ids", "at"))
    known = found.drop("text").withColumns({"root_part": F.col("part"), "root_nth": F.col("nth")})
    if hot:
        roots = _met(found.where("text is not null").select(*PLACE, "text"), fan, owners)
        renamed = roots.withColumnsRenamed({"root_part": "to_part", "root_nth": "to_nth"})
        known = known.join(renamed, PLACE, "left").withColumns(
            {"root_part": F.coalesce("to_part", "root_part"), "root_nth": F.coalesce("to_nth", "root_nth")}
        )
    return known.select("entry", "h", "root_part", "root_nth", "sha256", "ids", "at")


def _met(heads: DataFrame, fan: int, owners: int) -> DataFrame:
    """``h, part, nth, root_part, root_nth``: the heads of dealt keys, round by round, until each key meets whole."""
    roots = None
    live = heads
    while True:
        counts = live.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        asked = stage(live.join(counts, "h").withColumn("spread", F.xxhash64("part", "nth")).withColumn("next", _parts(fan)))
        again = not asked.where(F.col("n") > fan).isEmpty()
        dealt = asked.select("h", F.col("next").alias("part"), F.lit(0).alias("bucket"), "text", F.col("part").alias("old_part"), F.col("nth").alias("old_nth"))
        met = stage(_owned(dealt.withColumn("bucket", F.pmod("h", F.lit(owners))), owners).drop("first"))
        # The least head of a text stands for it.
        alike = met.groupBy("h", "part", "nth").agg(F.min(F.struct("old_part", "old_nth")).alias("root"), F.first("text").alias("text"))
        named = met.drop("text").join(alike.drop("text"), ["h", "part", "nth"]).select(
            "h", F.col("old_part").alias("part"), F.col("old_nth").alias("nth"), F.col("root.old_part").alias("root_part"), F.col("root.old_nth").alias("root_nth")
        )
        if roots is None:
            roots = stage(named)
        else:
            names = ["h", "root_part", "root_nth", "to_part", "to_nth"]
            further = named.select("h", "part", "nth", "root_part", "root_nth").toDF(*names)
            roots = stage(
                roots.join(further, ["h", "root_part", "root_nth"], "left").select(
                    "h", "part", "nth", F.coalesce("to_part", "root_part").alias("root_part"), F.coalesce("to_nth", "root_nth").alias("root_nth")
                )
            )
        if not again:
            return roots
        survivors = stage(alike.select("h", F.col("root.old_part").alias("part"), F.col("root.old_nth").alias("nth"), "text"))
        if survivors.count() == live.count():
            # Different texts of one key fill the parts; fewer parts let the last equal ones meet.
            fan *= 2
        live = survivors


def grouped(docs: DataFrame, key: Hash = key_of, fan: int = FAN, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    root = ["h", "root_part", "root_nth"]
    known = index(docs, key, fan, bucket_bytes).withColumn("top", F.expr("ids[at]"))
    # Structs compare field by field with NULL lowest, so a null id wins only among null ids.
    best = F.max(F.struct("top", (-F.col("entry")).alias("back")))
    groups = known.groupBy(*root).agg(best.alias("best"), F.sum(F.size("ids")).alias("group_size"))
    rows = known.join(groups, root).select("*", F.posexplode("ids").alias("place", "doc_id"))
    return rows.select(
        "doc_id",
        F.col("best.top").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"),
        ((F.col("best.back") == -F.col("entry")) & (F.col("place") == F.col("at"))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of equal texts, that of the largest id, with all its columns."""
    # Null ids get a stand-in beside a flag, so that the join has plain keys.
    id_ = F.col("doc_id").cast("bigint")
    place = [F.coalesce(id_, F.lit(0)).alias("_id"), id_.isNull().alias("_none")]
    kept = grouped(docs, **options).where("kept").select(*place, F.col("text_sha256").alias("_sha"))
    lowered = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    met = docs.select(row, *place, F.sha2(lowered.cast("binary"), 256).alias("_sha")).join(kept, ["_id", "_none", "_sha"], "left_semi")
    # Rows equal in id and text are one document repeated.
    return met.groupBy("_id", "_none", "_sha").agg(F.min_by("row", F.xxhash64("row.text")).alias("row")).select("row.*")


#: The same rows for DuckDB.
SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""
