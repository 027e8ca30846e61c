"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Vectors are scaled to length one. Each of ``TABLES`` tables hashes one to ``WIDTH`` cells,
``floor((a . x + b) / cell)``; neighbours mostly fall into the same bucket or one that differs
by one in a few cells. A query visits its bucket and perturbed ones, in the estimated
order of success: sets of steps over the nearest cell borders, ordered by the
expected sum of squared distances to them. What the tables find is merged and ranked by
the exact distance.

How many buckets to visit is measured: for a bounded sample of queries the nearest of all
vectors are found by brute force, and as many probes are made as would have met ``RECALL``
of them. Queries for which the probes find fewer than asked for, and all queries where even
``MOST_PROBES`` miss that share in the sample, meet every vector of their length instead, in
blocks, so they are exact.

Equal vectors are indexed once with their smallest ids, so copies never crowd a bucket; a
bucket with more than ``PART_ROWS`` vectors is cut into parts and its queries visit each. A
visit gives its nearest few only.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take
no part, neither as queries nor as candidates; vectors of different lengths are never
compared; a null id takes no part; rows repeated in id and vector count once; ties go to
the smaller id; an empty table gives no rows; only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.functions.sizing import broadcast_if_small
from streakline.llm.windows import mix
from streakline.session import stage

NEAREST, EVERY = 5, 50
TABLES, WIDTH, CELL = 6, 10, 0.35
SAMPLE, RECALL, LEAST_PROBES, MOST_PROBES = 100, 0.96, 20, 8_192
PART_ROWS, BLOCK = 4_096, 2_000_000
#: Scores this close are told apart by the exact arithmetic only; pairs that it takes at a time.
ROUNDING, PAIRS = 1e-9, 50_000
SEED = 20_240


def probe_sets(width: int, count: int) -> list[list[int]]:
    """The likeliest sets of border steps, as ranks among the 2 * width borders by distance.

    Ranks j and 2 * width - 1 - j are the two borders of one cell; no set has both.
    """
    n = width
    near = [j * (j + 1) / (4 * (n + 1) * (n + 2)) for j in range(1, n + 1)]
    rest = range(n, 0, -1)
    far = [1 - j / (n + 1) + j * (j + 1) / (4 * (n + 1) * (n + 2)) for j in rest]
    cost = near + far
    sets, heap = [[]], [(cost[0], [0])]
    while heap and len(sets) < count:
        total, ranks = heapq.heappop(heap)
        if all(2 * n - 1 - r not in ranks for r in ranks):
            sets.append(ranks)
        last = ranks[-1] + 1
        if last < 2 * n:
            heapq.heappush(heap, (total - cost[last - 1] + cost[last], [*ranks[:-1], last]))
            heapq.heappush(heap, (total + cost[last], [*ranks, last]))
    return sets


class Hashing:
    """The tables for vectors of one length."""

    def __init__(self, size: int, tables: int = TABLES, width: int = WIDTH, cell: float = CELL):
        rng = np.random.default_rng([SEED, size])
        self.cell, self.size = cell, size
        lines = [rng.standard_normal((size, width)) for _ in range(tables)]
        # Orthogonal directions, as many as there can be, tell more than independent ones.
        self.lines = [np.linalg.qr(a)[0] if width <= size else a / np.linalg.norm(a, axis=0) for a in lines]
        self.shifts = [rng.uniform(0, cell, width) for _ in range(tables)]

    def _name(self, table: int, cells: np.ndarray) -> np.ndarray:
        name = np.full(len(cells), self.size * 1_000 + table, np.uint64)
        for c in cells.T:
            name = mix(name, c.astype(np.int64).view(np.uint64))
        return name.view(np.int64)

    def buckets(self, unit: np.ndarray) -> list[np.ndarray]:
        """Per table, the bucket of each vector."""
        return [
            self._name(t, np.floor((unit @ a + b) / self.cell))
            for t, (a, b) in enumerate(zip(self.lines, self.shifts, strict=True))
        ]

    def probes(self, unit: np.ndarray, sets: list[list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and buckets to visit, per table and probe."""
        rows = np.arange(len(unit))
        for t, (a, b) in enumerate(zip(self.lines, self.shifts, strict=True)):
            at = (unit @ a + b) / self.cell
            cells = np.floor(at)
            inside = at - cells
            width = cells.shape[1]
            order = np.argsort(np.concatenate([inside, 1 - inside], axis=1), axis=1, kind="stable")
            column, step = order % width, np.where(order < width, -1, 1)
            for ranks in sets:
                moved = cells.copy()
                for r in ranks:
                    moved[rows, column[:, r]] += step[:, r]
                yield rows, self._name(t, moved)


    def meets(self, unit: np.ndarray, other: np.ndarray, place: dict[frozenset, int]) -> int:
        """The number of the first probe of ``unit`` that finds ``other`` in any table."""
        first = len(place)
        for a, b in zip(self.lines, self.shifts, strict=True):
            at, there = (unit @ a + b) / self.cell, np.floor((other @ a + b) / self.cell)
            cells = np.floor(at)
            steps = (there - cells).astype(int)
            if np.abs(steps).max() > 1:
                continue
            inside = at - cells
            rank = np.argsort(np.argsort(np.concatenate([inside, 1 - inside]), kind="stable"))
            borders = [rank[i] if d < 0 else rank[i + len(steps)] for i, d in enumerate(steps) if d]
            first = min(first, place.get(frozenset(int(r) for r in borders), first))
        return first


def measured_probes(classes: DataFrame, points: DataFrame, nearest: int, recall: float = RECALL) -> int | None:
    """How many probes meet ``recall`` of the nearest that brute force finds for a sample of queries.

    None: more than ``MOST_PROBES``.

    At most ``SAMPLE`` queries, the least by hash, meet every indexed vector, in blocks; only
    their few nearest come back.
    """
    sample = points.orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).select("class_id", "embedding").collect()
    asks = {}
    for r in sample:
        asks.setdefault(len(r["embedding"]), []).append((r["class_id"], r["embedding"]))
    asks = {n: (np.array([i for i, _ in rows]), _unit(np.array([v for _, v in rows]))) for n, rows in asks.items()}
    keep = nearest + 1

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _by_size(whole):
                ids, ask = asks.get(b.column("size")[0].as_py(), (None, None))
                if ids is None:
                    continue
                scores = ask @ _unit(_vectors(b.column("embedding"))).T
                k = min(keep, b.num_rows)
                best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                q, c = np.repeat(np.arange(len(ids)), k), best.ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[q]), b.column("class_id").take(pa.array(c)), pa.array(scores[q, c]), b.column("embedding").take(pa.array(c))],
                    names=["query_class", "class_id", "score", "embedding"],
                )

    ddl = "query_class bigint, class_id bigint, score double, embedding array<double>"
    found = classes.select("class_id", "size", "embedding").mapInArrow(near, ddl)
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    pairs = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= keep).collect()
    places = {frozenset(s): i for i, s in enumerate(probe_sets(WIDTH, MOST_PROBES))}
    units = {int(i): v for ids, vs in asks.values() for i, v in zip(ids, vs, strict=True)}
    first = sorted(
        Hashing(len(r["embedding"])).meets(units[r["query_class"]], _unit(np.array([r["embedding"]]))[0], places)
        for r in pairs
        if r["query_class"] != r["class_id"]
    )
    if not first:
        return LEAST_PROBES
    needed = first[max(0, math.ceil(recall * len(first)) - 1)] + 1
    return max(LEAST_PROBES, needed) if needed <= len(places) else None


def usable(embedding: Column) -> Column:
    """Is this a vector that has a direction?"""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling first keeps squares of very large or small components finite.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _by_size(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.asarray(b.column("size"))
    for n in np.unique(sizes):
        yield b.filter(pa.array(sizes == n))


def _index(classes: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _by_size(whole):
                hashing = Hashing(b.column("size")[0].as_py())
                for bucket in hashing.buckets(_unit(_vectors(b.column("embedding")))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket), b.column("class_id"), b.column("embedding")], names=["bucket", "class_id", "embedding"]
                    )

    return classes.select("class_id", "size", "embedding").mapInArrow(rows, "bucket bigint, class_id bigint, embedding array<double>")


def _visits(queries: DataFrame, probes: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = probe_sets(WIDTH, probes)
        for whole in batches:
            for b in _by_size(whole):
                for at in range(0, b.num_rows, 1_000):
                    part = b.slice(at, 1_000)
                    hashing = Hashing(part.column("size")[0].as_py())
                    for _, bucket in hashing.probes(_unit(_vectors(part.column("embedding"))), sets):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(bucket), part.column("class_id"), part.column("embedding")],
                            names=["bucket", "class_id", "embedding"],
                        )

    return queries.select("class_id", "size", "embedding").mapInArrow(
        rows, "bucket bigint, class_id bigint, embedding array<double>"
    )


def _search(dealt: DataFrame, nearest: int) -> DataFrame:
    """Per visit the ``nearest`` classes of its bucket part, with their exact cosine."""

    def score(a, v, unit_a, unit_v) -> np.ndarray:
        # The same arithmetic for a pair wherever it is met.
        exact = (a * v).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))
        # Squares that overflow or vanish: the same from the scaled vectors.
        return np.where(np.isfinite(exact), exact, (unit_a * unit_v).sum(axis=1))

    def settle(ids, vectors, asks, points) -> tuple | None:
        if not len(ids) or not len(asks):
            return None
        unit, ask = _unit(vectors), _unit(points)
        out = []
        step = max(1, BLOCK // len(ids))
        for at in range(0, len(asks), step):
            scores = ask[at : at + step] @ unit.T
            k = min(nearest, len(ids))
            # All within rounding of the last score kept are scored exactly, then cut by score and id.
            least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
            q, c = np.nonzero(scores >= least[:, None] - ROUNDING)
            q = q + at
            pairs = [slice(x, x + PAIRS) for x in range(0, len(q), PAIRS)]
            exact = np.concatenate([score(points[q[p]], vectors[c[p]], ask[q[p]], unit[c[p]]) for p in pairs])
            order = np.lexsort((ids[c], -exact, q))
            q, c, exact = q[order], c[order], exact[order]
            first = np.append(0, np.flatnonzero(np.diff(q)) + 1)
            nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
            out.append((asks[q[nth < k]], ids[c[nth < k]], exact[nth < k]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_class", "class_id", "score"]
        key, ids, vectors = None, [], []
        for whole in batches:
            keys = np.stack([np.asarray(whole.column(c)) for c in ("bucket", "part")], axis=1)
            kinds, own = np.asarray(whole.column("visit")), np.asarray(whole.column("class_id"))
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), whole.num_rows], strict=True):
                if a == b:
                    continue
                part = whole.slice(a, b - a)
                if key != tuple(keys[a]):
                    key, ids, vectors = tuple(keys[a]), [], []
                if kinds[a] == 0:  # indexed vectors come before the visits to their bucket
                    ids.append(own[a:b]), vectors.append(_vectors(part.column("embedding")))
                elif ids:
                    found = settle(np.concatenate(ids), np.concatenate(vectors), own[a:b], _vectors(part.column("embedding")))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=names)

    return dealt.mapInArrow(rows, "query_class bigint, class_id bigint, score double")


def _met(index: DataFrame, visits: DataFrame, keep: int) -> DataFrame:
    """``query_class, class_id, score``: the ``keep`` nearest that each visit meets in each part of its bucket."""
    sizes = stage(index.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    large = broadcast_if_small(sizes.where(F.col("n") > PART_ROWS).select("bucket", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    dealt_index = index.join(large, "bucket", "left").select(
        "bucket", F.pmod(F.xxhash64("class_id"), parts).cast("int").alias("part"), F.lit(0).alias("visit"), "class_id", "embedding"
    )
    # Buckets that hold nothing are not visited.
    open_visits = visits.join(sizes.select("bucket"), "bucket", "left_semi").join(large, "bucket", "left")
    dealt_visits = open_visits.select(
        "bucket", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(1).alias("visit"), "class_id", "embedding"
    )
    dealt = dealt_index.unionByName(dealt_visits).repartition("bucket", "part").sortWithinPartitions("bucket", "part", "visit")
    return _search(dealt, keep)


def nearest_neighbours(vectors: DataFrame, queries: Column | None = None, nearest: int = NEAREST, probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found for every row that ``queries`` picks.

    ``queries`` is a condition on ``vec_id``; without it, every ``EVERY``-th id. Without
    ``probes``, their number is measured.
    """
    picked = F.col("vec_id") % EVERY == 0 if queries is None else queries
    usable_rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    )
    rows = stage(usable_rows.withColumn("vec_id", F.col("vec_id").cast("bigint")))
    # One query more than asked for, as a query is left out of its own neighbours. The limit per
    # vector is applied before the shuffle too, so a vector with very many copies stays small.
    keep = nearest + 1
    distinct = rows.groupBy("embedding", "vec_id").agg(F.lit(1).alias("one"))
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    firsts = distinct.select("embedding", "vec_id", place.alias("place")).where(F.col("place") <= keep)
    classes = stage(
        firsts.groupBy("embedding")
        .agg(F.min("vec_id").alias("class_id"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("size", F.size("embedding"))
    )
    asked = rows.where(picked).select("vec_id", "embedding").distinct()
    asked = stage(asked.join(classes.select("embedding", "class_id"), "embedding").select("vec_id", "class_id"))
    points = asked.select("class_id").distinct().join(classes, "class_id")

    if probes is None:
        probes = measured_probes(classes, points, nearest)
    # Rows per vector length serve as one bucket, which meets all queries of that length.
    every = F.col("size").cast("bigint").alias("bucket"), "class_id", "embedding"
    if probes is None:
        found = _met(classes.select(*every), points.select(*every), keep)
    else:
        found = stage(_met(_index(classes), _visits(points, probes), keep))
        # A class met in several tables counts once.
        near = found.select("query_class", "class_id").distinct().join(classes.select("class_id", F.size("ids").alias("n")), "class_id")
        served = near.groupBy("query_class").agg(F.sum("n").alias("n")).where(F.col("n") >= keep)
        short = stage(points.join(served, F.col("class_id") == F.col("query_class"), "left_anti"))
        if not short.isEmpty():
            found = found.unionByName(_met(classes.select(*every), short.select(*every), keep))
    found = found.groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
    # At most keep rows per visit and visits per table: a bounded number of rows per query.
    spread = found.join(classes.select("class_id", "ids"), "class_id").select(
        "query_class", "score", F.explode("ids").alias("vec_id")
    )
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")
    lists = spread.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= keep)
    joined = asked.join(lists, F.col("class_id") == F.col("query_class")).select(
        asked["vec_id"].alias("query_id"), lists["vec_id"].alias("vec_id"), "score", "nth"
    ).where("query_id <> vec_id")
    own = Window.partitionBy("query_id").orderBy("nth")
    ranked = joined.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
