"""Upserts, change detection and incremental maintenance.

Plain Parquet tables have no MERGE, so each operator takes the old table and
the new rows and returns the whole new table, to be written as a new version.
Joins are on unique keys, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.ordered import bounded_join, number_all
from streakline.functions.scalars import as_time, differs
from streakline.operators.key_bits import parted
from streakline.schemas import PLAYED_STATUS
from streakline.session import is_unshuffled, stage

FIXTURE_KEY = ["api_fixture_id"]


# --- Union and keep-last -------------------------------------------------------------


def concat_frames(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; absent columns are NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def union_ids(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.union(second).distinct()


def keep_last_per_key(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: from the last frame that has it, there the last by ``order``.

    An aggregate, so repeats of one key are merged before the shuffle. Without
    ``order`` the frames must not repeat a key within themselves.
    """
    ranked = [f.withColumn("_rank", F.lit(i)) for i, f in enumerate(frames)]
    rows = concat_frames(*ranked)
    values = [c for c in rows.columns if c not in keys and c != "_rank"]
    best = F.max_by(F.struct(*values), F.struct("_rank", *order))
    return rows.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")


# --- Inserts with surrogate keys ------------------------------------------------------


def _with_new_ids(fresh: DataFrame, target: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """Number new rows above the highest id in use, in natural-key order."""
    highest = target.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("highest")).scalar()
    numbered = number_all(stage(fresh), order, "_nr")
    return numbered.withColumn(id_column, (F.col("_nr") + highest).cast("bigint")).drop("_nr")


def insert_or_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], id_column: str, now=None
) -> DataFrame:
    """Add the keys of ``source`` that are new, with the next free ids."""
    fresh = source.select(*keys).distinct().join(target, list(keys), "left_anti")
    added = _with_new_ids(fresh, target, id_column, keys)
    if "created_at" in target.columns:
        added = added.withColumn("created_at", as_time(now))
    return target.unionByName(added, allowMissingColumns=True)


def conditional_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    id_column: str,
    tracked: Sequence[str],
    *,
    touch: bool = True,
    now=None,
    order: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """Insert new keys; rewrite the tracked columns of known keys where any of them differs.

    A comparison with NULL counts as no difference unless ``null_safe``.
    ``touch`` sets ``updated_at`` on changed rows. If ``source`` can repeat a
    key, ``order`` says which of its rows comes last.
    """
    rows = keep_last_per_key([source], keys, order) if order else source
    feed = rows.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in tracked], F.lit(True).alias("_found"))
    changed = F.lit(False)
    for c in tracked:
        old, new = F.col(c), F.col(f"_new_{c}")
        changed = changed | (~old.eqNullSafe(new) if null_safe else differs(old, new))
    changed = F.col("_found").isNotNull() & changed
    values = {c: F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in tracked}
    if touch:
        values["updated_at"] = F.when(changed, as_time(now)).otherwise(F.col("updated_at"))
    kept = target.join(feed, list(keys), "left").select(
        *[values[c].alias(c) if c in values else F.col(c) for c in target.columns]
    )
    fresh = rows.select(*keys, *tracked).join(target, list(keys), "left_anti")
    added = _with_new_ids(fresh, target, id_column, keys)
    stamps = {c: as_time(now) for c in ("created_at", "updated_at") if c in target.columns}
    return kept.unionByName(added.withColumns(stamps), allowMissingColumns=True)


# --- Keyed updates ------------------------------------------------------------------------


def updatable_columns(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns both frames have, key aside; an error if ``source`` lacks the key."""
    absent = [k for k in keys if k not in source.columns]
    if absent:
        raise ValueError(f"key columns missing from updates: {', '.join(absent)}")
    return [c for c in source.columns if c in target.columns and c not in keys]


def coalesce_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = FIXTURE_KEY,
    now=None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Take non-NULL values of ``source`` for matching keys and set ``updated_at``.

    Never inserts, never overwrites a value with NULL. Each key may occur once
    in ``source``, unless ``order`` says which row comes last. Rows that ``source`` does not
    name are not moved where ``coalesce_parts`` can tell them.
    """
    same, updated = coalesce_parts(target, source, keys, now, order)
    return updated if same is None else same.unionByName(updated)


def coalesce_parts(
    target: DataFrame, source: DataFrame, keys: Sequence[str] = FIXTURE_KEY, now=None, order: Sequence[str] = ()
) -> tuple[DataFrame | None, DataFrame]:
    """What ``coalesce_update`` gives in two parts: rows that stay as they lie (None if they cannot be told), and the others."""
    columns = updatable_columns(target, source, keys)
    if not columns:
        return None, target
    rows = keep_last_per_key([source], keys, order) if order else source
    feed = rows.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_found"))
    values = {c: F.coalesce(f"_new_{c}", c) for c in columns}
    if "updated_at" in target.columns:
        values["updated_at"] = F.when(F.col("_found"), as_time(now)).otherwise(F.col("updated_at"))
    parts = parted(target, rows, keys)
    updated = (parts.inside if parts else target).join(feed, list(keys), "left").select(
        *[values[c].alias(c) if c in values else F.col(c) for c in target.columns]
    )
    return (parts.outside if parts else None), updated


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source``, and the rows of ``target`` whose key it does not have.

    Rows whose key ``source`` does not name are not moved where ``replace_parts`` can tell them.
    """
    same, others = replace_parts(target, source, keys)
    return others if same is None else same.unionByName(others, allowMissingColumns=True)


def replace_parts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
    """What ``replace_by_key`` gives in two parts: rows that stay as they lie (None if they cannot be told), and the others."""
    same, rest = _unnamed(target, source, keys)
    return same, source if rest is None else rest.unionByName(source, allowMissingColumns=True)


def without(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``target`` whose key ``source`` does not have."""
    found = [part for part in _unnamed(target, source, keys) if part is not None]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _unnamed(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """``without`` in rows that are not moved and rows that are."""
    parts = parted(target, source, keys)
    rest = target if parts is None else None if parts.exact else parts.inside
    same = parts and parts.outside.select(*keys, *[c for c in target.columns if c not in keys])
    return same, None if rest is None else rest.join(source, list(keys), "left_anti")


def replace_model(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``replace_by_key`` where ``source`` has most keys of ``target``, as a model built anew has.

    Keys alone are compared first; of ``target`` only the rows whose keys are gone from ``source``, in
    general few, are moved. ``source`` is read twice.
    """
    gone = stage(target.select(*keys).join(source.select(*keys), list(keys), "left_anti").distinct())
    return bounded_join(target, gone, keys, "left_semi").unionByName(source, allowMissingColumns=True)


def high_water_mark(target: DataFrame, column: str = "updated_at") -> Column:
    """The target's largest ``column`` as a scalar subquery; NULL if it is empty."""
    return target.agg(F.max(column).alias("mark")).scalar()


def rows_after(source: DataFrame, target: DataFrame, column: str = "updated_at") -> DataFrame:
    """Source rows above the target's high-water mark; all of them if the target is empty."""
    mark = high_water_mark(target, column)
    return source.where(mark.isNull() | (F.col(column) > mark))


def incremental_append(
    target: DataFrame, source: DataFrame, keys: Sequence[str], column: str = "updated_at"
) -> DataFrame:
    """Replace by key with only the source rows above the high-water mark.

    These are stored first where both sides are stored rows, so that the rest of ``target`` need not be moved.
    """
    fresh = rows_after(source, target, column)
    return replace_by_key(target, stage(fresh) if is_unshuffled(target) and is_unshuffled(source) else fresh, keys)


def mark_bootstrap_done(league_seasons: DataFrame, done: DataFrame, now=None) -> DataFrame:
    """Flag and time-stamp the league-seasons listed in ``done``."""
    flags = done.select("league_season_id").distinct().withColumn("_done", F.lit(True))
    values = {
        "fixtures_bootstrap_done": F.coalesce("_done", "fixtures_bootstrap_done"),
        "fixtures_bootstrap_at": F.when(F.col("_done"), as_time(now)).otherwise(
            F.col("fixtures_bootstrap_at")
            if "fixtures_bootstrap_at" in league_seasons.columns
            else F.lit(None)
        ),
    }
    return league_seasons.join(flags, "league_season_id", "left").withColumns(values).drop("_done")


# --- Change detection -----------------------------------------------------------------------


def status_columns(df: DataFrame) -> DataFrame:
    return df.select("api_fixture_id", "fixture_status", "kickoff_utc")


def diff_join(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Both snapshots' status and kickoff side by side; ids in only one are left out."""

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            "api_fixture_id",
            F.col("fixture_status").alias(f"fixture_status_{suffix}"),
            F.col("kickoff_utc").alias(f"kickoff_utc_{suffix}"),
        )

    return side(base, "base").join(side(updates, "upd"), "api_fixture_id")


def flag_changes(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Per shared id: has it now been played, was it moved? A NULL kickoff on either side counts as moved."""
    played = (F.col("fixture_status_upd") == PLAYED_STATUS) & F.coalesce(
        F.col("fixture_status_base") != PLAYED_STATUS, F.lit(True)
    )
    moved = F.coalesce(F.col("kickoff_utc_upd") != F.col("kickoff_utc_base"), F.lit(True))
    return diff_join(base, updates).select(
        "api_fixture_id",
        F.coalesce(played, F.lit(False)).alias("now_played"),
        moved.alias("rescheduled"),
    )


def changed_ids(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Ids that have now been played or were moved."""
    return flag_changes(base, updates).where("now_played or rescheduled").select("api_fixture_id").distinct()


def change_counts(base: DataFrame, updates: DataFrame) -> DataFrame:
    return flag_changes(base, updates).agg(
        F.count_if("now_played").alias("now_played"), F.count_if("rescheduled").alias("rescheduled")
    )


def only_known_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is listed; the list stays distributed, or becomes bitmaps if it is stored."""
    parts = parted(df, ids, FIXTURE_KEY)
    listed = parts.inside if parts else df.join(ids, "api_fixture_id", "left_semi")
    return listed.select(*FIXTURE_KEY, *[c for c in df.columns if c not in FIXTURE_KEY])
