"""Incremental intake by a mark that loses nothing.

A strict high-water mark misses rows that arrive later with the mark's own stamp, or a little
before it. Here the mark looks back over a stretch of time, and a ledger of what was taken in that
stretch keeps rows from coming twice. The ledger has one narrow row per row of the stretch, so it does
not grow with the table. Runs may be repeated and may see any part of the source, in any
order, as long as a row is not later than the look-back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.operators.merge import replace_by_key

LOOK_BACK = "INTERVAL 2 DAYS"


def _edge(ledger: DataFrame, column: str, look_back: str) -> Column:
    """Where the look-back starts; NULL before anything was taken."""
    return ledger.agg((F.max(column) - F.expr(look_back)).alias("edge")).scalar()


def _plain(keys: Sequence[str], column: str) -> list[Column]:
    """Keys and stamp for an equi-join: a missing stamp becomes a flag and a stand-in."""
    stamp = F.coalesce(F.col(column), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return [*[F.col(k) for k in keys], stamp.alias("_stamp"), F.col(column).isNull().alias("_unstamped")]


def not_taken(source: DataFrame, ledger: DataFrame, keys: Sequence[str], column: str = "updated_at", look_back: str = LOOK_BACK) -> DataFrame:
    """Rows of ``source`` at or after the look-back's edge that ``ledger`` does not list.

    A row is known by its keys and its stamp, so an updated row comes again. Rows without a stamp
    are taken once.
    """
    edge = _edge(ledger, column, look_back)
    near = source.where(edge.isNull() | F.col(column).isNull() | (F.col(column) >= edge))
    listed = ledger.select(*_plain(keys, column))
    marked = near.select("*", *_plain(keys, column)[len(keys) :])
    return marked.join(listed, [*keys, "_stamp", "_unstamped"], "left_anti").select(*source.columns)


def grown_ledger(ledger: DataFrame, taken: DataFrame, keys: Sequence[str], column: str = "updated_at", look_back: str = LOOK_BACK) -> DataFrame:
    """``ledger`` with ``taken``, less what has fallen behind the look-back."""
    both = ledger.select(*keys, column).unionByName(taken.select(*keys, column)).distinct()
    return both.where(F.col(column).isNull() | (F.col(column) >= _edge(both, column, look_back)))


def empty_ledger(source: DataFrame, keys: Sequence[str], column: str = "updated_at") -> DataFrame:
    return source.select(*keys, column).limit(0)


def append_marked(
    target: DataFrame, source: DataFrame, ledger: DataFrame, keys: Sequence[str], column: str = "updated_at", look_back: str = LOOK_BACK
) -> tuple[DataFrame, DataFrame]:
    """The target with the rows not taken yet, and the ledger to store along with it."""
    taken = not_taken(source, ledger, keys, column, look_back)
    return replace_by_key(target, taken, keys), grown_ledger(ledger, taken, keys, column, look_back)
