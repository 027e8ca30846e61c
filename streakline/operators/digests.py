"""Snapshots compared by digests: only groups of rows that differ are joined.

A digest is the number of rows of a group and the sum of their hashes: free of order, mergeable before
the shuffle, one row per group whatever the rows. Groups are rows with common values, such as league
and season; changes mostly sit in few of them. Hashes take in which values are NULL, so a value
that becomes NULL shows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.sizing import broadcast_if_small
from streakline.operators.merge import changed_ids
from streakline.session import stage

GROUPS = ["api_league_id", "season"]
STATUS = ["api_fixture_id", "fixture_status", "kickoff_utc"]


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of the values and of which of them are NULL."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def _plain(groups: Sequence[str]) -> list[Column]:
    """Group values as text beside NULL flags, so that joins on them have plain keys."""
    return [
        x
        for i, g in enumerate(groups)
        for x in (F.coalesce(F.col(g).cast("string"), F.lit("")).alias(f"_g{i}"), F.col(g).isNull().alias(f"_n{i}"))
    ]


def _names(groups: Sequence[str]) -> list[str]:
    return [n for i in range(len(groups)) for n in (f"_g{i}", f"_n{i}")]


def digests(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``rows, digest`` per group, beside the group's plain keys."""
    hashed = df.select(*_plain(groups), row_hash(columns).cast("decimal(38,0)").alias("_hash"))
    return hashed.groupBy(*_names(groups)).agg(F.count(F.lit(1)).alias("rows"), F.sum("_hash").alias("digest"))


def differing_groups(base: DataFrame, other: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Plain keys of the groups that the two do not have alike; stored."""
    theirs = digests(other, groups, columns).withColumnsRenamed({"rows": "_rows", "digest": "_digest"})
    both = digests(base, groups, columns).join(theirs, _names(groups), "full")
    unlike = ~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest")))
    return stage(both.where(unlike).select(*_names(groups)))


def in_groups(df: DataFrame, groups: Sequence[str], listed: DataFrame) -> DataFrame:
    """Rows of ``df`` that lie in the listed groups."""
    keyed = df.select("*", *_plain(groups))
    return keyed.join(broadcast_if_small(listed), _names(groups), "left_semi").select(*df.columns)


def changed_ids_by_digest(base: DataFrame, other: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    """``changed_ids`` of two whole snapshots; rows of groups that are alike are not joined.

    ``groups`` must not change for an id from one snapshot to the other.
    """
    listed = differing_groups(base, other, groups, STATUS)
    return changed_ids(in_groups(base, groups, listed), in_groups(other, groups, listed))
