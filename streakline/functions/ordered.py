"""Ordered work per key that holds up when one key owns most of the rows.

A window puts all rows of its key into one task. That is the best plan as long
as no key is huge, and the wrong one otherwise. So every function here

1. counts rows per key once (pre-aggregated before the shuffle) and keeps the
   keys with more than ``chunk_rows`` rows, of which there are at most
   ``rows / chunk_rows``;
2. uses plain windows for the rows of all other keys; and
3. range-partitions the rows of the hot keys by key and order into chunks of
   about ``chunk_rows`` rows (many small ones share a partition), works per (key, chunk), and carries a few values
   per chunk from one chunk to the next.

Range partitioning samples the full sort key, so neither a hot key nor a crowd
of equal times makes a chunk too big; the order columns must identify a row
within its key. The cut rows are stored with their chunk numbers, so every
reader and every retried task sees the same cuts. The hot-key list and the
carries have at most about ``rows / chunk_rows`` rows.

``hot`` saves the count where the answer is known: ``False`` for no hot key,
``True`` to cut all keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.functions.sizing import broadcast_if_small
from streakline.session import stage, stored

CHUNK_ROWS = 4_000_000
CHUNK = "_chunk"

Step = Callable[[DataFrame], DataFrame]


def hot_keys(df: DataFrame, keys: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Keys with more than ``chunk_rows`` rows, and how many each has; stored."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return stage(counts.where(F.col("rows") > chunk_rows))


def _same(keys: Sequence[str]) -> Column:
    """Equality with a renamed bounded side; NULL keys match too."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    return same


def bounded_join(df: DataFrame, bounded: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join with a side of at most about one row per chunk.

    That side comes from stored rows, so the planner knows its size: it is broadcast while
    that is small, and no hint forces it beyond.
    """
    renamed = bounded.withColumnsRenamed({k: f"_at_{k}" for k in keys})
    joined = df.join(renamed, _same(keys), how)
    return joined.drop(*[f"_at_{k}" for k in keys])


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with ``_chunk``, ascending in key and order; stored.

    A chunk is a range partition, as long as these are no more than tasks of a shuffle. Small chunks
    in greater number are cut out of sorted partitions, ``chunk_rows`` each, for an exchange costs
    its tasks on one side times those on the other.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(chunks * chunk_rows / CHUNK_ROWS))
    if chunks <= tasks:
        ranged = df.repartitionByRange(max(chunks, 1), *keys, *order)
        return stage(ranged.withColumn(CHUNK, F.spark_partition_id().cast("bigint")))
    ranged = df.repartitionByRange(tasks, *keys, *order).sortWithinPartitions(*keys, *order)
    # The lower bits of this id count the rows of a partition, the upper ones are its number.
    placed = ranged.withColumn(CHUNK, F.monotonically_increasing_id())
    local = F.col(CHUNK).bitwiseAND((1 << 33) - 1)
    return stage(placed.withColumn(CHUNK, F.col(CHUNK) - local + F.floor(local / chunk_rows)))


def per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    whole: Step,
    in_chunks: Step,
    chunk_rows: int = CHUNK_ROWS,
    hot: bool | None = None,
) -> DataFrame:
    """``whole`` on the rows of ordinary keys, ``in_chunks`` on the cut rows of hot ones."""
    if hot is False:
        return whole(df)
    if hot is True:
        return in_chunks(cut(df, keys, order, math.ceil(df.count() / chunk_rows), chunk_rows))
    # The input is worked out once; counting, splitting and cutting read the stored rows.
    df = stored(df)
    found = hot_keys(df, keys, chunk_rows)
    rows = found.agg(F.sum("rows")).first()[0]
    if not rows:
        return whole(df)
    listed = found.select(*keys)
    ordinary = bounded_join(df, listed, keys, "left_anti")
    crowded = cut(bounded_join(df, listed, keys, "left_semi"), keys, order, math.ceil(rows / chunk_rows), chunk_rows)
    return whole(ordinary).unionByName(in_chunks(crowded))


def attach_carry(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the per-chunk values of ``carry`` to the rows.

    ``carry`` has rows only for chunks that continue a key, so at most one per chunk.
    """
    return bounded_join(df, carry, [*keys, CHUNK], "left")


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    chunk_rows: int = CHUNK_ROWS,
    hot: bool | None = None,
) -> DataFrame:
    """``row_number()`` per key; ``order`` must identify a row within its key."""

    def whole(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(window).cast("bigint"))

    def in_chunks(pieces: DataFrame) -> DataFrame:
        sizes = pieces.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_rows"))
        earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            sizes.withColumn("_before", F.sum("_rows").over(earlier))
            .where(F.col("_before").isNotNull())
            .select(*keys, CHUNK, "_before")
        )
        local = F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*order))
        return (
            attach_carry(pieces.withColumn("_local", local), carry, keys)
            .withColumn(name, F.col("_local") + F.coalesce("_before", F.lit(0).cast("bigint")))
            .drop(CHUNK, "_local", "_before")
        )

    return per_key(df, keys, order, whole, in_chunks, chunk_rows, hot)


def next_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], **options) -> DataFrame:
    """``lead()`` per key: ``values`` maps each new column to the column it looks ahead at."""
    return _neighbour_values(df, keys, order, values, ahead=True, **options)


def previous_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], **options
) -> DataFrame:
    """``lag()`` per key. With ``default``, that value stands where no row precedes;
    a NULL in the row before stays NULL."""
    return _neighbour_values(df, keys, order, values, ahead=False, **options)


def _neighbour_values(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    ahead: bool,
    default=None,
    chunk_rows: int = CHUNK_ROWS,
    hot: bool | None = None,
) -> DataFrame:
    shift = F.lead if ahead else F.lag

    def whole(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumns({new: shift(old, 1, default).over(window) for new, old in values.items()})

    def in_chunks(pieces: DataFrame) -> DataFrame:
        # Fields go by position: a column may be looked at under several names.
        wanted = F.struct(*[F.col(old).alias(f"v{i}") for i, old in enumerate(values.values())])
        place = F.struct(*order)
        edge = (F.min_by if ahead else F.max_by)(wanted, place)
        edges = pieces.groupBy(*keys, CHUNK).agg(edge.alias("_edge"))
        carry = (
            edges.withColumn("_beyond", shift("_edge").over(Window.partitionBy(*keys).orderBy(CHUNK)))
            .where(F.col("_beyond").isNotNull())
            .select(*keys, CHUNK, "_beyond")
        )
        local = shift(wanted).over(Window.partitionBy(*keys, CHUNK).orderBy(*order))
        out = attach_carry(pieces.withColumn("_local", local), carry, keys)
        found = F.coalesce("_local", "_beyond")
        return out.withColumns(
            {new: F.when(found.isNotNull(), found[f"v{i}"]).otherwise(F.lit(default)) for i, new in enumerate(values)}
        ).drop(CHUNK, "_local", "_beyond")

    return per_key(df, keys, order, whole, in_chunks, chunk_rows, hot)


def number_all(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int = 1,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Number a whole table from ``start`` in the stated order.

    ``df`` is counted first and then cut: pass a stored or staged table. Tables of any size
    are cut by range into chunks of about ``chunk_rows`` rows; none goes through one window. One
    range exchange and one sort serve: a row's place in its chunk is counted while the chunk is
    stored, and what comes before a chunk is added from one row per chunk.
    """
    chunks = max(1, math.ceil(df.count() / chunk_rows))
    ranged = df.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    # The lower bits of this id count the rows of a partition.
    local = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = stage(ranged.select("*", F.spark_partition_id().alias(CHUNK), local.alias("_local")))
    if chunks == 1:
        return placed.withColumn(name, F.col("_local") + start).drop(CHUNK, "_local")
    sizes = placed.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_all", F.lit(0))
    earlier = Window.partitionBy("_all").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    before = stage(sizes.select(CHUNK, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")))
    numbered = placed.join(broadcast_if_small(before), CHUNK)
    return numbered.withColumn(name, F.col("_local") + F.col("_before") + start).drop(CHUNK, "_local", "_before")
