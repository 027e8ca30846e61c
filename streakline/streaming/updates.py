"""Update files as a stream.

``stream_updates`` merges each micro-batch into one table, whole. ``stream_increments`` keeps each
fixture's telling records so far in a table in buckets and brings what changed into the raw table and
the facts, at the cost of the buckets touched; the order in which files arrive does not matter. On request
records that came too late to tell anything new are kept in a table of their own.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from streakline.operators import key_bits
from streakline.operators.merge import FIXTURE_KEY, coalesce_update
from streakline.plans import increments
from streakline.plans.jobs import transform_fixtures
from streakline.schemas import FLAT_FIXTURE_TEXT, PLAYED_STATUS
from streakline.session import stage, write_packed
from streakline.sources import buckets
from streakline.sources.paths import exists
from streakline.sources.snapshots import read_version, remove_old_versions, write_version

LATE = "inc/late_records"
HELD = "inc/stream_records"
#: Every digit of a kickoff goes through the state and back.
EXACT_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _stamp(checkpoint: str, batch_id: int) -> str:
    """The same for a batch that is run again, another for a batch of another checkpoint."""
    return f"stream{zlib.crc32(checkpoint.encode()):08x}-{batch_id:012d}"


def stream_updates(
    spark: SparkSession,
    incoming: str,
    folder: str,
    checkpoint: str,
    now=None,
    files_per_batch: int = 1000,
    keep: int = 30,
) -> StreamingQuery:
    """Merge record-line files that arrive in ``incoming`` into the versioned table ``folder``.

    A batch becomes a version of its own, made from the last version that is not its own,
    whoever wrote it, so a batch that is run again after a failure gives the same
    table. If a batch holds a fixture more than once, the record of the file that arrived last
    wins. All but the last ``keep`` versions are deleted.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        stamp = _stamp(checkpoint, batch_id)
        table = read_version(spark, folder, before=stamp)
        updates = transform_fixtures(batch)
        order = ["_arrived", "_file", "kickoff_utc", "fixture_status"]
        write_version(coalesce_update(table, updates, FIXTURE_KEY, now, order), folder, stamp)
        remove_old_versions(spark, folder, keep)

    return (
        spark.readStream.schema(FLAT_FIXTURE_TEXT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(incoming)
        .selectExpr("*", "_metadata.file_modification_time as _arrived", "_metadata.file_path as _file")
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def best_records(records: DataFrame) -> DataFrame:
    """One record per fixture, each value from the best record that has it.

    Best is the finished record, then the later kickoff; further columns only break ties. Taking
    the best is order-free and mergeable, so as a streaming aggregate the state of a fixture is
    what a batch over all its records would give, whatever came first.
    """
    values = [c for c in records.columns if c not in FIXTURE_KEY]
    finished = F.coalesce(F.col("fixture_status") == PLAYED_STATUS, F.lit(False))
    place = F.struct(finished, "kickoff_utc", *[c for c in values if c != "kickoff_utc"])
    rows = records.where(F.col(FIXTURE_KEY[0]).isNotNull()).groupBy(*FIXTURE_KEY)
    return rows.agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in values]).select(*records.columns)


def _telling(records: Iterable[dict], values: list[str]) -> tuple[list[dict], dict]:
    """The records that ``best_records`` takes a value from, and what it makes of them."""

    def place(record: dict) -> list:
        cells = [record.get("fixture_status") == PLAYED_STATUS, record.get("kickoff_utc")]
        cells += [record.get(c) for c in values if c != "kickoff_utc"]
        # NULL stands first, as in Spark's order of structs.
        return [(cell is not None, 0 if cell is None else cell) for cell in cells]

    kept, best = [], {}
    for record in sorted(records, key=place, reverse=True):
        new = [c for c in values if record.get(c) is not None and c not in best]
        if new or not kept:
            best.update({c: record[c] for c in new})
            kept.append(record)
    return kept, best


def judged_records(records: DataFrame) -> DataFrame:
    """The stream ``records`` with ``late``: what changes the best of a fixture, and what came too late for that.

    False: the fixture's best record as ``best_records`` has it, given out whenever it changes. True: a
    record as it came, of which no value counts by the end of its micro-batch; it is superseded.
    A repeat of what counts is neither. The state of a fixture is the records that its best is made of,
    in most cases one, so it grows with the raw table and not with the number of records.
    """
    values = [c for c in records.columns if c not in FIXTURE_KEY]
    key, ddl = FIXTURE_KEY[0], records.select(*values).schema

    def judge(key_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else []
        came = [json.loads(r) for batch in batches for r in batch["record"]]
        before = _telling(held, values)[1]
        kept, best = _telling(held + came, values)
        out = [(json.dumps(r), True) for r in came if r not in kept and r != best]
        if not state.exists or best != before:
            out.append((json.dumps(best), False))
        if kept != held:
            state.update((json.dumps(kept),))
        yield pd.DataFrame([(key_[0], *row) for row in out], columns=[key, "record", "late"])

    packed = records.where(F.col(key).isNotNull()).select(key, F.to_json(F.struct(*values), EXACT_TIME).alias("record"))
    judged = packed.groupBy(key).applyInPandasWithState(
        judge, f"{key} bigint, record string, late boolean", "records string", "update", "NoTimeout"
    )
    unpacked = judged.select(key, F.from_json("record", ddl, EXACT_TIME).alias("record"), "late")
    return unpacked.select(*[key if c == key else f"record.{c}" for c in records.columns], "late")


def judged_batch(held: DataFrame, came: DataFrame, n_buckets: int) -> DataFrame:
    """The rows of both with what they are worth, in one shuffle and one sort; the rules are those of ``judged_records``.

    Rows are shuffled by their ``bucket``, so what is stored of them lies as a table in buckets does.

    ``tells``: a record that the fixture's best takes a value from, the first of equal ones; these are
    what to hold for the next batch. ``late``: a record of ``came`` of which no value counts. ``best``: the best
    record, on one row of each fixture in ``came``, and ``changed`` whether ``held`` alone gave another.
    """
    key, values = FIXTURE_KEY[0], [c for c in came.columns if c not in FIXTURE_KEY]
    rows = held.withColumn("_came", F.lit(False)).unionByName(came.withColumn("_came", F.lit(True)))
    rows = rows.withColumn(buckets.BUCKET, buckets.bucket_of(FIXTURE_KEY, n_buckets)).repartition(buckets.BUCKET)
    finished = F.coalesce(F.col("fixture_status") == PLAYED_STATUS, F.lit(False))
    place = [finished, F.col("kickoff_utc"), *[F.col(c) for c in values if c != "kickoff_utc"]]
    ranked = Window.partitionBy(buckets.BUCKET, key).orderBy(*[c.desc_nulls_last() for c in place])
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    equals = ranked.rangeBetween(Window.currentRow, Window.currentRow)

    # One bit for each value that a record has.
    known = F.lit(0).cast("bigint")
    for nth, c in enumerate(values):
        known = known.bitwiseOR(F.when(F.col(c).isNotNull(), F.lit(1 << nth).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    told = F.coalesce(F.bit_or("_known").over(before), F.lit(0).cast("bigint"))
    best = F.struct(*[F.first(c, True).over(whole).alias(c) for c in values])
    own = F.struct(*[F.first(F.when(~F.col("_came"), F.col(c)), True).over(whole).alias(c) for c in values])
    marked = rows.where(F.col(key).isNotNull()).withColumn("_known", known).withColumns(
        {
            "_nr": F.row_number().over(ranked),
            "_told": told,
            "_best": best,
            "_own": own,
            "_any_came": F.max("_came").over(whole),
            "_any_held": F.max(~F.col("_came")).over(whole),
        }
    )
    tells = (F.col("_nr") == 1) | (F.col("_known").bitwiseAND(F.bitwise_not("_told")) != 0)
    same = F.struct(*values).eqNullSafe(F.col("_best"))
    return (
        marked.withColumn("tells", tells)
        .withColumn("_counts", F.max("tells").over(equals))
        .select(
            *came.columns,
            "tells",
            (F.col("_came") & ~F.col("_counts") & ~same).alias("late"),
            F.when((F.col("_nr") == 1) & F.col("_any_came"), F.col("_best")).alias("best"),
            (~F.col("_any_held") | ~F.col("_best").eqNullSafe(F.col("_own"))).alias("changed"),
            buckets.BUCKET,
        )
    )


def judge_batch(batch: DataFrame, folder: str, stamp: str, n_buckets: int = buckets.BUCKETS) -> DataFrame:
    """``judged_batch`` of a micro-batch against the records held in ``folder``, which is brought up to date; stored."""
    spark = batch.sparkSession
    came = batch.where(F.col(FIXTURE_KEY[0]).isNotNull())
    if not buckets.has_map(spark, folder, before=stamp):
        judged = stage(judged_batch(came.limit(0), came, n_buckets), [buckets.BUCKET])
        telling = judged.where("tells").select(*came.columns)
        buckets.write_buckets(telling, folder, FIXTURE_KEY, stamp, n_buckets, lying=True)
        return judged
    came, known = stage(came), buckets.read_map(spark, folder, before=stamp)
    touched = known.touched(came)
    held = known.read(spark, touched)
    # Records of fixtures that did not come stay as they lie.
    parts = key_bits.parted(held, came, FIXTURE_KEY)
    concerned, kept = (parts.inside, parts.outside) if parts else (held, None)
    judged = stage(judged_batch(concerned, came, known.buckets), [buckets.BUCKET])
    telling = judged.where("tells").select(*came.columns)
    same = kept.select(*came.columns).unionByName(telling) if kept else telling
    buckets.update_buckets(came, folder, stamp, lambda _, __: (same, None), touched)
    return judged


def late_records(spark: SparkSession, root: str) -> DataFrame | None:
    """The late records of all micro-batches, with ``batch``; None before the first."""
    return spark.read.parquet(f"{root}/{LATE}") if exists(spark, f"{root}/{LATE}") else None


def stream_increments(
    spark: SparkSession,
    incoming: str,
    root: str,
    checkpoint: str,
    as_of=None,
    now=None,
    files_per_batch: int = 1000,
    keep: int = 30,
    keep_late: bool = False,
) -> StreamingQuery:
    """Bring record-line files that arrive in ``incoming`` into the tables of ``plans.increments``.

    The records that a fixture's best is made of, in most cases one, are held in a table in buckets, one per
    checkpoint (``inc/stream_records``): it lies on disk, is versioned as the other tables, and grows with the raw table. A
    micro-batch hands on the fixtures whose best record it may have changed, and of these only what differs
    from the raw table is applied: to the raw buckets, the team rows, the streaks and the states of the teams
    concerned. A record that is late or superseded changes nothing; with ``keep_late`` it is written
    to ``inc/late_records``, in a folder per micro-batch. A batch that is run again starts from the versions before
    its own and writes its folder anew. All but the last ``keep`` versions are deleted, but no late records.
    Checkpoints of the time when Spark's state store held the records cannot be gone on with.
    """
    held = f"{root}/{HELD}/{zlib.crc32(checkpoint.encode()):08x}"

    def bring(batch: DataFrame, batch_id: int) -> None:
        stamp = _stamp(checkpoint, batch_id)
        n_buckets = buckets.read_map(spark, f"{root}/{increments.RAW_ROWS}").buckets
        judged = judge_batch(batch, held, stamp, n_buckets)
        best = judged.where("best is not null")
        if keep_late:
            late = judged.where("late").select(*batch.columns)
            if not late.isEmpty():
                write_packed(late, f"{root}/{LATE}/batch={stamp}", mode="overwrite")
            best = best.where("changed")
        increments.bring_in(best.select(*[c if c in FIXTURE_KEY else f"best.{c}" for c in batch.columns]), root, stamp, as_of, now)
        increments.tidy(spark, root, keep)
        buckets.remove_unused(spark, held, keep)

    records = spark.readStream.schema(FLAT_FIXTURE_TEXT).option("maxFilesPerTrigger", files_per_batch).json(incoming)
    return (
        transform_fixtures(records)
        .writeStream.foreachBatch(bring)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
