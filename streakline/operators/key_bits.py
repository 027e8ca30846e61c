"""Repeats and orphans among whole-number keys, with bitmaps in place of the keys.

A key belongs to a bucket of 32,768 neighbours and to one bit of it. Each task makes one bitmap
per bucket that it meets, and these are merged; a bucket with as many bits as rows holds no repeat,
and one whose bits the parent all has holds no orphan. Only the keys of other buckets are
grouped one by one, so the answer is exact and what is shuffled follows the buckets and the
suspects. Keys that lie near each other in the files, as ids given in order do, take down to a bit
each; scattered ones up to about what the keys themselves would.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.sizing import broadcast_if_small, is_small
from streakline.session import is_unshuffled, stage

#: Types whose values are whole numbers that fit a bigint.
WHOLE = ("tinyint", "smallint", "int", "bigint")


def is_whole(df: DataFrame, *columns: str) -> bool:
    kinds = dict(df.dtypes)
    return all(kinds[c] in WHOLE for c in columns)


def _key(column: str) -> Column:
    return F.col(f"`{column}`").cast("bigint")


def key_bitmaps(df: DataFrame, column: str) -> DataFrame:
    """``bucket, bits, n``: a bitmap of the keys of each bucket, and how many rows they stand in; NULLs left out."""
    keys = df.select(_key(column).alias("key")).where("key is not null")
    return keys.groupBy(F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"), F.count(F.lit(1)).alias("n")
    )


def _in_buckets(df: DataFrame, column: str, buckets: DataFrame) -> DataFrame:
    """``key`` of the rows of ``df`` that fall into ``buckets``."""
    keys = df.select(_key(column).alias("key")).where("key is not null").withColumn("bucket", F.bitmap_bucket_number("key"))
    return keys.join(broadcast_if_small(buckets), "bucket", "left_semi").select("key")


def repeat_suspects(df: DataFrame, column: str) -> DataFrame:
    """``bucket`` of the buckets that hold a repeated key; stored."""
    return stage(key_bitmaps(df, column).where(F.bitmap_count("bits") < F.col("n")).select("bucket"))


def orphan_suspects(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """``bucket`` of the buckets in which the child has a key that the parent lacks; stored."""
    of_child = key_bitmaps(child, column).select("bucket", "bits", F.lit(False).alias("known"))
    of_parent = key_bitmaps(parent, parent_column).select("bucket", "bits", F.lit(True).alias("known"))
    merged = of_child.unionByName(of_parent).groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"),
        F.max(F.when(F.col("known"), F.bitmap_count("bits"))).alias("parents"),
    )
    return stage(merged.where(F.col("either") > F.coalesce("parents", F.lit(0))).select("bucket"))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """``column, occurrences`` of the keys that stand in more than one row; NULLs do not count."""
    found = _in_buckets(df, column, repeat_suspects(df, column)).groupBy("key").agg(F.count(F.lit(1)).alias("occurrences"))
    return found.where("occurrences > 1").select(_typed(df, column), "occurrences")


def orphaned_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """``column, failing``: the child's keys that the parent lacks, and their rows; NULLs do not count."""
    suspects = orphan_suspects(child, column, parent, parent_column)
    values = _in_buckets(child, column, suspects).groupBy("key").agg(F.count(F.lit(1)).alias("failing"))
    known = _in_buckets(parent, parent_column, suspects)
    return values.join(known, "key", "left_anti").select(_typed(child, column), "failing")


class Parts(NamedTuple):
    """``inside`` holds all rows whose key is listed, and if ``exact`` no others; ``outside`` holds the rest."""

    inside: DataFrame
    outside: DataFrame
    exact: bool


def parted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> Parts | None:
    """``target`` parted by whether ``source`` has a row's key, without a shuffle of either; NULL keys are outside.

    Keys that are few are broadcast as they are, whole numbers else as bitmaps; with several keys the
    first whole number among them decides, and ``inside`` is not exact. None where neither is
    small, or where the two are not stored rows, so that reading them again would be work.
    """
    if not (is_unshuffled(target) and is_unshuffled(source)):
        return None
    listed = source.select(*keys)
    if is_small(listed):
        few = F.broadcast(listed)
        halves = [target.join(few, list(keys), how).select(*target.columns) for how in ("left_semi", "left_anti")]
        return Parts(*halves, True)
    column = next((k for k in keys if is_whole(target, k) and is_whole(source, k)), None)
    if column is None:
        return None
    bits = stage(key_bitmaps(source, column).select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")))
    if not is_small(bits):
        return None
    bit = F.bitmap_bit_position(_key(column))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_listed = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    marked = target.join(F.broadcast(bits), F.bitmap_bucket_number(_key(column)) == F.col("_bucket"), "left")
    return Parts(
        marked.where(is_listed).select(*target.columns), marked.where(~is_listed).select(*target.columns), len(keys) == 1
    )


def _typed(df: DataFrame, column: str) -> Column:
    return F.col("key").cast(dict(df.dtypes)[column]).alias(column)
