"""Near-duplicates by SimHash, linked through vantage-point trees.

A fingerprint has a bit set if it is set in more than half of the 64-bit hashes of the
text's three-word shingles. Two fingerprints link if at most ``REACH`` bits differ.

Distinct fingerprints are searched in a vantage-point tree. Its upper levels, built from a
bounded sample, cut them into shards: each node splits by the distance to a vantage point at
a radius. By the triangle inequality a fingerprint at distance d has links on the near side
only if d - reach <= radius and on the far side only if d + reach > radius; it visits every
shard that its ball overlaps, and belongs to one. In a shard the tree goes on in memory down
to small exact comparisons.

Balls of near-random fingerprints overlap more shards with every level, so past ``WHOLE_DEPTH``
levels there is one tree for each quarter of the bits instead. Of two fingerprints that differ in
``REACH`` bits one quarter is the same, at distance zero: with that reach each fingerprint
visits one shard per tree, however deep, and meets there those of its own quarter. A shard gives each linked fingerprint with the root of its local
component, so a group of copies of any size gives as many rows as it has fingerprints.
Components over all shards are then found with joins.

Defined cases: null and empty texts and texts without words have fingerprint zero, linked
like any other; texts of one or two words are one shingle; a null id never becomes a
component's id unless all its ids are null; repeated rows are all returned; an empty table
gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import add_columns
from streakline.llm.components import components
from streakline.session import stage

REACH, SHINGLE, SEED = 3, 3, 42
SAMPLE, SHARD_FINGERPRINTS, WHOLE_DEPTH, MAX_DEPTH = 32_768, 60_000, 3, 14
QUARTERS = [np.uint64(0xFFFF << at) for at in (0, 16, 32, 48)]
QUARTER_SHARDS = 1 << 20
BLOCK = 2**21
MOST = 2**63 - 1


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` words in a row; of all words where there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, as the words are
    if not words:
        return np.array([], np.uint64)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(width, len(words))
    lasts = ends[width - 1 :].tolist()
    firsts = [0, *(ends[: len(words) - width] + 1).tolist()]
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], SEED) for a, b in zip(firsts, lasts, strict=True)], np.uint64)


def fingerprint(text: str | None) -> int:
    """The text's fingerprint as a signed 64-bit number."""
    values = shingle_hashes(text, SHINGLE)
    if not len(values):
        return 0
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_ = bits.sum(axis=0, dtype=np.int64) * 2 > len(values)
    return int(np.packbits(set_, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    return add_columns(docs, lambda: lambda t: (fingerprint(t),), "fp bigint")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def build_tree(sample: np.ndarray, depth: int):
    """Nested (vantage point, radius, near, far); a leaf is None.

    Of a few candidates the vantage point whose distances spread most is taken: fewer balls
    then overlap the radius.
    """
    if depth == 0 or len(sample) < 8:
        return None
    tries = sample[:: max(1, len(sample) // 16)][:16]
    spread = [distance(v, sample).astype(float).std() for v in tries]
    vantage = tries[int(np.argmax(spread))]
    d = distance(vantage, sample)
    radius = int(np.median(d))
    near = d <= radius
    if near.all():
        radius -= 1
        near = d <= radius
    if not near.any():
        return None
    return vantage, radius, build_tree(sample[near], depth - 1), build_tree(sample[~near], depth - 1)


def route(tree, fps: np.ndarray, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row positions, the shards they visit, and whether the shard is the row's own."""
    rows, shards, own, count = [], [], [], 0

    def go(node, at: np.ndarray, home: np.ndarray) -> None:
        nonlocal count
        if node is None:
            rows.append(at), shards.append(np.full(len(at), count)), own.append(home)
            count += 1
            return
        vantage, radius, near, far = node
        d = distance(vantage, fps[at]).astype(np.int16)
        left, right = d - reach <= radius, d + reach > radius
        go(near, at[left], home[left] & (d[left] <= radius))
        go(far, at[right], home[right] & (d[right] > radius))

    go(tree, np.arange(len(fps)), np.ones(len(fps), bool))
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(own)


class _Sets:
    """Union-find over positions; the root is the least position."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while not np.array_equal(r, n := self.up[r]):
            r = n
        self.up[at] = r
        return r

    def join(self, a: int, b: int) -> None:
        while self.up[a] != a:
            a = self.up[a]
        while self.up[b] != b:
            b = self.up[b]
        self.up[max(a, b)] = min(a, b)


def link_shard(fps: np.ndarray, own: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Roots after linking each own fingerprint with all within ``reach``; exact."""
    sets = _Sets(len(fps))

    def compare(home: np.ndarray, near: np.ndarray) -> None:
        step = max(1, BLOCK // max(1, len(near)))
        for at in range(0, len(home), step):
            h = home[at : at + step]
            linked = distance(fps[h][:, None], fps[near][None, :]) <= reach
            # Each own one meets itself; further work only where a block has real links.
            some = linked.sum(axis=1) > 1
            if not some.any():
                continue
            h, linked = h[some], linked[some]
            used = linked.any(axis=0)
            c, linked = near[used], linked[:, used]
            while True:
                rh, rc = sets.roots(h), sets.roots(c)
                row = np.minimum(rh, np.where(linked, rc[None, :], len(fps)).min(axis=1))
                col = np.minimum(rc, np.where(linked, row[:, None], len(fps)).min(axis=0))
                moved = {*zip(rh[rh != row].tolist(), row[rh != row].tolist()), *zip(rc[rc != col].tolist(), col[rc != col].tolist())}
                if not moved:
                    break
                for a, b in moved:
                    sets.join(a, b)

    def go(home: np.ndarray, near: np.ndarray, depth: int) -> None:
        if not len(home):
            return
        if len(home) < 48 or depth == 40:
            return compare(home, near)
        vantage = fps[home[len(home) // 2]]
        dh, dn = distance(vantage, fps[home]).astype(np.int16), distance(vantage, fps[near]).astype(np.int16)
        radius = int(np.median(dh))
        if (dh <= radius).all():
            radius -= 1
        left = dh <= radius
        if not left.any() or radius < 2 * reach:
            return compare(home, near)
        go(home[left], near[dn - reach <= radius], depth + 1)
        go(home[~left], near[dn + reach > radius], depth + 1)

    everything = np.arange(len(fps))
    go(np.flatnonzero(own), everything, 0)
    return sets.roots(everything)


def link_quarter(fps: np.ndarray, quarter: np.uint64) -> np.ndarray:
    """Roots after linking all within ``REACH`` that have the same bits in ``quarter``."""
    roots = np.arange(len(fps))
    order = np.argsort(fps & quarter, kind="stable")
    values = (fps & quarter)[order]
    cuts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
        if b - a > 1:
            same = order[a:b]
            roots[same] = same[link_shard(fps[same], np.ones(len(same), bool))]
    return roots


def visits(fps: np.ndarray, trees: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``route``, through one tree of whole fingerprints or one of each quarter."""
    if len(trees) == 1:
        return route(trees[0], fps)
    found = [route(tree, fps & quarter, 0) for tree, quarter in zip(trees, QUARTERS, strict=True)]
    shards = [shard + nth * QUARTER_SHARDS for nth, (_, shard, _) in enumerate(found)]
    return np.concatenate([f[0] for f in found]), np.concatenate(shards), np.concatenate([f[2] for f in found])


def shard_trees(sample: np.ndarray, depth: int) -> list:
    if depth <= WHOLE_DEPTH:
        return [build_tree(sample, depth)]
    return [build_tree(sample & quarter, depth) for quarter in QUARTERS]


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints (column ``fp``, distinct) within reach."""
    count = distinct.count()
    depth = min(MAX_DEPTH, max(0, -(-count // SHARD_FINGERPRINTS) - 1).bit_length())
    picked = distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect() if depth else []
    trees = shard_trees(np.array([r["fp"] for r in picked], np.int64).view(np.uint64), depth)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("fp").to_numpy()
            rows, shards, own = visits(fps.view(np.uint64), trees)
            for at in range(0, len(rows), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards[part].astype(np.int32)), pa.array(own[part]), pa.array(fps[rows[part]])],
                    names=["shard", "own", "fp"],
                )

    def within(shard: pa.Table) -> pa.Table:
        fps, own = shard.column("fp").to_numpy(), shard.column("own").to_numpy()
        if len(trees) > 1:
            nth = shard.column("shard")[0].as_py() // QUARTER_SHARDS
            roots = link_quarter(fps.view(np.uint64), QUARTERS[nth])
        else:
            roots = link_shard(fps.view(np.uint64), own)
        linked = roots != np.arange(len(fps))
        return pa.table({"a": fps[linked], "b": fps[roots[linked]]})

    dealt = distinct.select("fp").mapInArrow(spread, "shard int, own boolean, fp bigint")
    return dealt.groupBy("shard").applyInArrow(within, "a bigint, b bigint")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def grouped(fps: DataFrame) -> DataFrame:
    """``fp, component_id`` for each distinct fingerprint of ``fps`` (stored: ``doc_id, fp``)."""
    firsts = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(firsts.select("fp"))).withColumnRenamed("node", "fp")
    rooted = stage(firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    fps = stage(fingerprints(docs))
    joined = fps.join(grouped(fps).select("fp", "component_id"), "fp")
    return joined.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, that of the least id (and fingerprint), all its columns."""
    fps = stage(fingerprints(docs))
    return least_of_each(docs, fps.join(grouped(fps).select("fp", "root"), "fp"), fingerprint)


def least_of_each(docs: DataFrame, named: DataFrame, mark: Callable[[str | None], int]) -> DataFrame:
    """One row of ``docs`` per ``root`` of ``named`` (``doc_id, fp, root``); ``mark`` gives a text's ``fp``."""
    # Null ids come last; the stand-in keeps the join and the grouping on plain keys, with one shuffle.
    known = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(MOST))
    kept = named.groupBy("root").agg(F.min(F.struct(known.alias("kept_id"), "fp")).alias("k"))
    kept = stage(kept.select(F.col("k.kept_id").alias("kept_id"), F.col("k.fp").alias("fp")))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), known.alias("kept_id"), "text")
    with_fp = add_columns(inner, lambda: lambda t: (mark(t),), "fp bigint", keep=("row", "kept_id"))
    # Rows equal in id and fingerprint are one document repeated; one of them stays.
    rows = with_fp.join(kept, ["kept_id", "fp"], "left_semi").groupBy("kept_id", "fp")
    return rows.agg(F.min_by("row", F.xxhash64("row.text")).alias("row")).select("row.*")
