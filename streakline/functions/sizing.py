"""Broadcast only what was measured and found small."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16_000_000
#: What a value of fixed width, or the frame of a longer one, takes in memory.
VALUE_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """About what the rows take in memory; a distributed sum over their texts and their number."""
    texts = [F.octet_length(F.col(f"`{n}`")) for n, kind in df.dtypes if kind in ("string", "binary")]
    lists = [F.size(F.col(f"`{n}`")) * VALUE_BYTES for n, kind in df.dtypes if kind.startswith(("array", "map"))]
    longer = [F.coalesce(x, F.lit(0)).cast("bigint") for x in texts + lists]
    sums = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(reduce(add, longer, F.lit(0).cast("bigint"))).alias("longer")).first()
    return sums["rows"] * VALUE_BYTES * max(1, len(df.columns)) + (sums["longer"] or 0)


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Does ``df`` take at most about ``max_bytes`` in memory?"""
    return measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it takes at most ``max_bytes``, else as it is.

    Size estimates of joined or exploded dimensions are often far too high, and
    a dimension wrongly thought large makes the planner shuffle the facts. Past
    the limit the planner is left to a sort-merge join with skew splitting.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df
