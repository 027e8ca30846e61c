"""The next fixture repaired in place: only rows whose neighbours changed are rewritten.

A changed match touches itself, the row before its old place and the row before its new one, per
team. Keys, places and old neighbours of the teams concerned are put in order, as narrow rows; whole rows
are joined only for what came out different.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.functions.ordered import hot_keys
from streakline.operators.facts import TEAM_KEY, next_fixture
from streakline.operators.key_bits import parted
from streakline.operators.merge import without
from streakline.session import stage

TEAM_ROW = ["fixture_id", "team_id"]
NEXT = ["next_opponent_id", "next_kickoff_utc"]


def next_repairs(stored: DataFrame, changed: DataFrame, hot: bool | None = None) -> DataFrame:
    """The rows of ``stored`` to be replaced, and new ones, once ``changed`` has come in.

    ``stored`` holds team rows with their next fixture, ``changed`` whole team rows without it, each
    once. All rows of the teams in ``changed`` must be in ``stored``; other teams are not looked at.
    """
    narrow = [*TEAM_ROW, "kickoff_utc", "opponent_id"]
    own = stored.select(*narrow, *[F.col(c).alias(f"_{c}") for c in NEXT])
    teams = parted(own, changed, TEAM_KEY)
    own = teams.inside if teams else own.join(changed.select(*TEAM_KEY).distinct(), TEAM_KEY, "left_semi")
    kept = without(own, changed.select(*TEAM_ROW), TEAM_ROW).withColumn("_new", F.lit(False))
    came = changed.select(*narrow).withColumn("_new", F.lit(True))
    if hot is None and hot_keys(own.select(*TEAM_KEY).unionByName(came.select(*TEAM_KEY)), TEAM_KEY).isEmpty():
        # Nor is any team crowded in the rows below, which need not be stored to be counted.
        hot = False
    placed = next_fixture(kept.unionByName(came, allowMissingColumns=True), hot=hot)
    # Rows that share a key are compared below, each with each.
    shared = F.count(F.lit(1)).over(Window.partitionBy(*TEAM_KEY, "fixture_id")) > 1
    found = stage(
        placed.withColumn("_shared", shared)
        .where(F.col("_new") | F.col("_shared") | ~_same())
        .select(*TEAM_ROW, "_new", *[F.col(c).alias(f"_{c}") for c in NEXT])
    )
    old = found.where("not _new")
    shared_keys = parted(stored, old, TEAM_ROW)
    moved = (shared_keys.inside if shared_keys else stored).join(old, TEAM_ROW).where(~_same())
    new = changed.join(found.where("_new"), TEAM_ROW)
    return moved.select(*_as(stored)).unionByName(new.select(*_as(stored)))


def _same() -> Column:
    """Is the next fixture what it was?"""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in NEXT])


def _as(stored: DataFrame) -> list[Column]:
    return [F.col(f"_{c}" if c in NEXT else c).alias(c) for c in stored.columns]
