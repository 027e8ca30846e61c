"""Tables cut by a hash of their key into buckets, so that an update rewrites only what it touches.

Rows lie in ``data/attempt=<stamp>_<id>/bucket=<n>/`` and never change once written. A version of
the table is a small map from bucket to folders, stored as any other versioned table (see
``snapshots``) after its data: readers see the last whole map while the next one is made.

An update reads the buckets its feed falls into, writes these anew, and keeps the folders of all
others in its map. Rows may also be appended: their folders stand beside those the bucket has.
The map has at most as many rows as there are buckets and folders in use; the number of buckets
is fixed when the table is made and should give buckets of some 100 MB.

A key that owns many rows makes its bucket large but not its tasks: buckets are written through
``REBALANCE``, which splits them by size. Rows that already lie bucket by bucket are written as they come, without
that shuffle; buckets that have gathered many files by it go through it again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from streakline.session import is_unshuffled, write_packed
from streakline.sources.paths import delete, glob
from streakline.sources.snapshots import read_version, remove_old_versions, versions, write_version

BUCKETS = 256
BUCKET = "bucket"
#: Buckets whose files are more than this on average are gathered anew by the next update.
FILES_PER_BUCKET = 16
MAP_DDL = "bucket int, folder string, buckets int, keys array<string>, schema string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class BucketMap:
    """One version of a table: which folders each bucket consists of."""

    root: str
    folders: dict[int, list[str]]
    buckets: int
    keys: tuple[str, ...]
    schema: StructType

    def read(self, spark: SparkSession, only: Collection[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; other buckets are not even listed."""
        wanted = sorted(self.folders) if only is None else sorted(set(only) & set(self.folders))
        paths = [p for b in wanted for p in self.folders[b]]
        if not paths:
            return spark.createDataFrame([], self.schema)
        whole = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        rows = spark.read.schema(whole).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*[F.col(f"`{c}`") for c in self.schema.names])

    def touched(self, feed: DataFrame) -> list[int]:
        """The buckets that ``feed``, which has the key columns, falls into: at most ``buckets`` numbers."""
        return [r[0] for r in feed.select(bucket_of(self.keys, self.buckets)).distinct().collect()]


def read_map(spark: SparkSession, root: str, before: str | None = None) -> BucketMap:
    """The last map, or with ``before`` the last that is not of that stamp."""
    rows = read_version(spark, f"{root}/map", before=before).collect()
    folders: dict[int, list[str]] = {}
    for r in rows:
        if r["folder"]:
            folders.setdefault(r["bucket"], []).append(f"{root}/data/{r['folder']}")
    return BucketMap(root, folders, rows[0]["buckets"], tuple(rows[0]["keys"]), StructType.fromJson(json.loads(rows[0]["schema"])))


def has_map(spark: SparkSession, root: str, before: str | None = None) -> bool:
    return bool(versions(spark, f"{root}/map", before))


def read_buckets(spark: SparkSession, root: str, only: Collection[int] | None = None, before: str | None = None) -> DataFrame:
    return read_map(spark, root, before).read(spark, only)


def _store(
    rows: DataFrame | None, root: str, stamp: str, keys: Sequence[str], buckets: int, lying: DataFrame | None = None
) -> dict[int, list[str]]:
    """Write ``rows`` into new folders, by bucket, and with them ``lying`` ones, which tasks have bucket by bucket."""
    attempt = f"{root}/data/attempt={stamp}_{uuid.uuid4().hex[:8]}"
    parts = [df.withColumn(BUCKET, bucket_of(keys, buckets)) for df in (lying, rows) if df is not None]
    if rows is not None:
        parts[-1] = parts[-1].hint("rebalance", BUCKET)
    cut = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    write_packed(cut, attempt, [BUCKET])
    found = sorted(int(p.rsplit("=", 1)[1]) for p in glob(cut.sparkSession, f"{attempt}/{BUCKET}=*"))
    return {b: [f"{attempt}/{BUCKET}={b}"] for b in found}


def _write_map(spark: SparkSession, made: BucketMap, stamp: str) -> BucketMap:
    named = [(b, p.removeprefix(f"{made.root}/data/")) for b, paths in sorted(made.folders.items()) for p in paths]
    fixed = (made.buckets, list(made.keys), made.schema.json())
    # A table without rows has one row that names no folder.
    rows = [(b, p, *fixed) for b, p in named] or [(0, None, *fixed)]
    write_version(spark.createDataFrame(rows, MAP_DDL).coalesce(1), f"{made.root}/map", stamp)
    return made


def write_buckets(
    df: DataFrame, root: str, keys: Sequence[str], stamp: str, buckets: int = BUCKETS, lying: bool = False
) -> BucketMap:
    """A new table, or a new version that keeps nothing of the one before. With ``lying`` a task of ``df``
    has the rows of few buckets and they are written without a shuffle."""
    folders = _store(None, root, stamp, keys, buckets, df) if lying else _store(df, root, stamp, keys, buckets)
    return _write_map(df.sparkSession, BucketMap(root, folders, buckets, tuple(keys), df.schema), stamp)


Change = Callable[[DataFrame, DataFrame], DataFrame | tuple[DataFrame | None, DataFrame | None]]


def update_buckets(feed: DataFrame, root: str, stamp: str, change: Change, known: Collection[int] | None = None) -> BucketMap:
    """Replace the rows of the buckets that ``feed`` touches by ``change(their rows, feed)``.

    ``feed`` has the key columns and is read twice: pass stored rows. ``change`` must leave
    keys as they are. It may give two parts: rows that stay as they lie, which are then written without
    a shuffle, and the others. ``known`` saves looking up the buckets. Without rows in the feed the
    version before is the result and nothing is written.
    """
    spark = feed.sparkSession
    old = read_map(spark, root, before=stamp)
    touched = old.touched(feed) if known is None else list(known)
    if not touched:
        return old
    rows = old.read(spark, touched)
    changed = change(rows, feed)
    columns = [F.col(f"`{c}`") for c in old.schema.names]
    same, new = [p and p.select(*columns) for p in (changed if isinstance(changed, tuple) else (None, changed))]
    if same and not (is_unshuffled(same) and len(same.inputFiles()) <= FILES_PER_BUCKET * len(touched)):
        same, new = None, same.unionByName(new) if new else same
    folders = _store(new, root, stamp, old.keys, old.buckets, same)
    kept = {b: p for b, p in old.folders.items() if b not in set(touched)}
    return _write_map(spark, BucketMap(root, {**kept, **folders}, old.buckets, old.keys, old.schema), stamp)


def append_to(made: BucketMap, rows: DataFrame, stamp: str) -> BucketMap:
    """``made`` with further rows in folders of their own; what a bucket has is not read. Store it with ``publish``."""
    folders = _store(rows.select(*[F.col(f"`{c}`") for c in made.schema.names]), made.root, stamp, made.keys, made.buckets)
    joined = {b: [*made.folders.get(b, []), *folders.get(b, [])] for b in {*made.folders, *folders}}
    return BucketMap(made.root, joined, made.buckets, made.keys, made.schema)


def publish(spark: SparkSession, made: BucketMap, stamp: str) -> BucketMap:
    """Make ``made`` the last version."""
    return _write_map(spark, made, stamp)


def remove_unused(spark: SparkSession, root: str, keep: int = 30) -> int:
    """Forget all but the last ``keep`` maps and delete the folders that only these named; returns how many went.

    As with ``remove_old_versions``, keep as many as are written while the longest reader runs.
    """

    def named(paths: Sequence[str]) -> set[str]:
        return {r["folder"] for p in paths for r in spark.read.parquet(p).select("folder").collect() if r["folder"]}

    found = versions(spark, f"{root}/map")
    if len(found) <= keep:
        return 0
    gone = named(found[:-keep]) - named(found[-keep:])
    remove_old_versions(spark, f"{root}/map", keep)
    for folder in gone:
        delete(spark, f"{root}/data/{folder}")
    return len(gone)
