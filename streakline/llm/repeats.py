"""Windows of a fixed length that repeat anywhere in a table of texts; exact, and at scale.

Counting every window of every text would shuffle each position. Instead:

1. one row per run of windows with a common anchor (``windows.py``) goes to the task of its
   anchor's gram, with the name of the run's whole block. Grams and blocks are counted there.
   A gram that stands alone rules out all windows of its runs; a block that repeats settles
   all of them at once;
2. only where a gram has several different blocks are windows compared one by one: one
   run of each block sends the names of its windows, packed, to the gram's task.

A gram that a bounded sample shows to be frequent is dealt over several tasks: its runs by
document in step 1, where each part then sends its own runs on, and its windows by name in
step 2. This changes where rows go, never what is found. Texts are shuffled once, by
document, and read twice from that shuffle: for the names of step 2 and for the result.

Window and block names have 64 bits and are compared within a gram of 32 bits more.
Rows are known by id and a 64-bit hash of the text. Rows of one id with other texts are documents
of their own, in the order of these hashes. So are rows equal in both, which share what was found:
of these each but the first consists of nothing else than earlier text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from streakline.llm.common import SLICE_ROWS
from streakline.llm.windows import anchor_runs, window_names
from streakline.session import stage

LEAST, MOST = -(2**63), 2**63 - 1
HOT_ROWS, SAMPLE_DOCS, MAX_PARTS = 2_000, 4_000, 4_096
CHUNK_WINDOWS = 2_000_000
#: Elements that are named in one call: enough to make up for the call, few enough for the cache.
CALL_ELEMENTS = 40_000
ROW = ["id", "h"]

Codes = Callable[[str], np.ndarray]


def keyed(docs: DataFrame) -> DataFrame:
    """``id`` (null first), ``h`` and ``text`` (null as empty)."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")
    )


def _batches(rows: DataFrame, ddl: str, slices: Callable[[Iterator[pa.RecordBatch]], Iterator[list]]) -> DataFrame:
    """``mapInArrow`` for functions that yield lists of columns."""
    target = to_arrow_schema(StructType.fromDDL(ddl))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches):
            arrays = [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return rows.mapInArrow(each, ddl)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _place(first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return anchor << 24 | (anchor - first) << 12 | (last - first)


def _spots(place: int) -> tuple[int, int, int]:
    """First window, last window and anchor of a run."""
    anchor = place >> 24
    first = anchor - (place >> 12 & 4095)
    return first, first + (place & 4095), anchor


def _calls(values: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Neighbours joined up to about ``CALL_ELEMENTS``: the first one's number, the joined array, the sizes."""
    held, count, at = [], 0, 0
    for i, v in enumerate(values):
        if held and count + len(v) > CALL_ELEMENTS:
            yield at, np.concatenate(held), np.array([len(x) for x in held])
            held, count, at = [], 0, i
        held.append(v)
        count += len(v)
    if held:
        yield at, np.concatenate(held), np.array([len(x) for x in held])


def _runs(rows: DataFrame, codes: Codes, length: int, gram: int, parts: dict[int, int]) -> DataFrame:
    def found(batches):
        for b in _sliced(batches):
            made = []
            ids, hashes = (b.column(c).to_numpy(zero_copy_only=False) for c in ROW)
            for at, joined, sizes in _calls([codes(t) for t in b.column("text").to_pylist()]):
                r = anchor_runs(joined, length, gram, sizes)
                if r is None:
                    continue
                g = (r.gram & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                ends = np.cumsum(sizes)
                nth = np.searchsorted(ends, r.first, side="right")
                start = (ends - sizes)[nth]
                id_, h = ids[at + nth], hashes[at + nth]
                n = np.array([parts.get(x, 0) for x in g.tolist()], np.int32) if parts else np.zeros(len(g), np.int32)
                salt = np.where(n > 0, (h & 0x7FFFFFFF) % np.maximum(n, 1), 0).astype(np.int32)
                place = _place(r.first - start, r.last - start, r.anchor - start)
                made.append([g, n, salt, r.block.view(np.int64), id_, h, place])
            if made:
                yield _joined(made)

    return _batches(rows, "gram int, parts int, salt int, block bigint, id bigint, h bigint, place bigint", found)


def _frequent(rows: DataFrame, codes: Codes, length: int, gram: int) -> dict[int, int]:
    """Grams with many runs, as far as a sample of documents tells, and how many parts each gets."""
    total = rows.count()
    step = max(1, total // SAMPLE_DOCS)
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0)
    counts = _runs(sample, codes, length, gram, {}).groupBy("gram").agg((F.count(F.lit(1)) * step).alias("n"))
    many = counts.where((F.col("n") > HOT_ROWS) & (F.col("n") >= 8 * step))
    listed = many.orderBy(F.desc("n"), "gram").limit(SAMPLE_DOCS).collect()
    return {r["gram"]: int(min(MAX_PARTS, -(-r["n"] // HOT_ROWS) + 1)) for r in listed}


def _packed(reps: DataFrame, codes: Codes, length: int) -> DataFrame:
    """Window names of the chosen runs, by gram and part; ``reps`` has ``runs`` per text."""

    def found(batches):
        for b in _sliced(batches):
            out = [[] for _ in range(8)]
            # Only the blocks of the chosen runs are named, many in a call.
            chosen, blocks = [], []
            for id_, h, text, runs in zip(*[b.column(c).to_pylist() for c in (*ROW, "text", "runs")], strict=True):
                whole = codes(text)
                for run in runs:
                    first, last, anchor = _spots(run["place"])
                    chosen.append((id_, h, run, first, last, anchor))
                    blocks.append(whole[first : last + length])
            for nth, joined, sizes in _calls(blocks):
                names = window_names(joined, [length])[0]
                starts = np.cumsum(sizes) - sizes
                for start, (id_, h, run, first, last, anchor) in zip(starts.tolist(), chosen[nth : nth + len(sizes)], strict=True):
                    own = names[start : start + last - first + 1]
                    offsets = (anchor - np.arange(first, last + 1)).astype(np.int16)
                    part = own % np.uint64(run["parts"]) if run["parts"] > 1 else None
                    for p in (0,) if part is None else np.unique(part):
                        mine = slice(None) if part is None else part == p
                        row = (run["gram"], int(p), id_, h, anchor, run["weight"], offsets[mine].tobytes(), own[mine].tobytes())
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
            yield out

    ddl = "gram int, part int, id bigint, h bigint, anchor bigint, weight int, offsets binary, names binary"
    return _batches(reps, ddl, found)


def _compared(packed: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """Stretches ``start, stop`` of texts covered by windows that also start elsewhere (earlier)."""

    def settle(rows: list[dict]) -> list[list]:
        names = np.concatenate([np.frombuffer(r["names"], np.uint64) for r in rows])
        offsets = np.concatenate([np.frombuffer(r["offsets"], np.int16) for r in rows]).astype(np.int64)
        size = [len(r["names"]) // 8 for r in rows]
        owner = np.repeat(np.arange(len(rows)), size)
        column = lambda c: np.array([r[c] for r in rows], np.int64)[owner]
        gram, id_, h, anchor = (column("gram") << 16) + offsets, column("id"), column("h"), column("anchor")
        order = np.lexsort((anchor, h, id_, names, gram))
        g, n, i, k, a = gram[order], names[order], id_[order], h[order], anchor[order]
        new = np.append(True, (g[1:] != g[:-1]) | (n[1:] != n[:-1]))
        group = np.cumsum(new) - 1
        if keep_first:
            start = np.flatnonzero(new)[group]
            drop = (i != i[start]) | (k != k[start]) | (a != a[start])
        else:
            drop = (np.bincount(group, column("weight")[order]) >= 2)[group]
        picked = order[drop]
        at = anchor[picked] - offsets[picked]
        back = np.lexsort((at, owner[picked]))
        o, at = owner[picked][back], at[back]
        if not len(o):
            return [[], [], [], []]
        cut = np.append(True, (o[1:] != o[:-1]) | (at[1:] != at[:-1] + 1))
        ends = np.append(np.flatnonzero(cut)[1:], len(o)) - 1
        o = o[cut].tolist()
        return [[rows[x]["id"] for x in o], [rows[x]["h"] for x in o], at[cut], at[ends] + length]

    def found(batches):
        held: list[dict] = []
        count = 0
        for b in batches:
            for row in b.to_pylist():
                # Chunks are cut between groups only.
                if count >= CHUNK_WINDOWS and (row["gram"], row["part"]) != (held[-1]["gram"], held[-1]["part"]):
                    yield settle(held)
                    held, count = [], 0
                held.append(row)
                count += len(row["names"]) // 8
        if held:
            yield settle(held)

    dealt = packed.repartition("gram", "part").sortWithinPartitions("gram", "part")
    return _batches(dealt, "id bigint, h bigint, start bigint, stop bigint", found)


def repeated_stretches(docs: DataFrame, codes: Codes, length: int, gram: int, keep_first: bool) -> DataFrame:
    """``id, h, text, spans``: every text with the stretches that repeated windows cover.

    ``spans`` (null: none) is a list of ``start, stop``, unordered and overlapping. With
    ``keep_first`` a window counts if it also starts earlier: at a smaller id, or in the same
    document before; without, if it starts anywhere else.
    """
    rows = keyed(docs)
    parts = _frequent(rows, codes, length, gram)
    runs = _runs(rows, codes, length, gram, parts)
    same_block = Window.partitionBy("gram", "salt", "block")
    same_gram = Window.partitionBy("gram", "salt")
    counted = (
        runs.withColumn("nth", F.rank().over(same_block.orderBy("id", "h", "place")))
        .withColumn("copies", F.count(F.lit(1)).over(same_block))
        .withColumn("several", F.min("block").over(same_gram) != F.max("block").over(same_gram))
        .withColumn("times", F.count(F.lit(1)).over(same_gram))
    )
    compare = (F.col("nth") == 1) & (F.col("several") | (F.col("parts") > 0))
    settled = F.col("nth") > 1 if keep_first else F.col("copies") > 1
    found = stage(
        counted.where((F.col("times") > 1) | (F.col("parts") > 0))
        .select(*ROW, "place", "gram", "parts", settled.alias("settled"), compare.alias("compare"), F.least("copies", F.lit(2)).cast("int").alias("weight"))
        .where("settled or compare")
    )
    chosen = found.where("compare").groupBy(*ROW).agg(F.collect_list(F.struct("gram", "parts", "place", "weight")).alias("runs"))
    packed = _packed(rows.join(chosen, ROW), codes, length)
    first = F.shiftright("place", 24) - F.shiftright("place", 12).bitwiseAND(4095)
    blocks = found.where("settled").select(
        *ROW, first.alias("start"), (first + F.col("place").bitwiseAND(4095) + length).alias("stop")
    )
    spans = blocks.unionByName(_compared(packed, length, keep_first)).groupBy(*ROW)
    marked = rows.join(spans.agg(F.collect_set(F.struct("start", "stop")).alias("spans")), ROW, "left")
    if not keep_first:
        return marked
    # The join left rows equal in id and text side by side.
    copy = F.row_number().over(Window.partitionBy(*ROW).orderBy(F.lit(0))) > 1
    all_of_it = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(MOST).alias("stop")))
    return marked.withColumn("spans", F.when(copy, all_of_it).otherwise(F.col("spans")))


def covered(n: int, spans: list[dict] | None, length: int) -> np.ndarray:
    """Which of ``n`` elements the spans cover; fewer than a window lose nothing."""
    edges = np.zeros(n + 1, np.int64)
    if spans and n >= length:
        np.add.at(edges, [s["start"] for s in spans], 1)
        np.add.at(edges, [min(s["stop"], n) for s in spans], -1)
    return np.cumsum(edges[:-1]) > 0


def with_id(docs: DataFrame, out: DataFrame, columns: list) -> DataFrame:
    """``columns`` of ``out`` beside the id as ``docs`` has it."""
    id_ = F.when(F.col("id") != LEAST, F.col("id")).cast(docs.schema["doc_id"].dataType)
    return out.select(id_.alias("doc_id"), *columns)
