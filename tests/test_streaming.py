import random
from datetime import datetime

import pytest

from streakline.operators.merge import coalesce_update
from streakline.plans.jobs import transform_fixtures
from streakline.schemas import FLAT_FIXTURE_TEXT
from streakline.sources import fixture_files, snapshots
from streakline.streaming.updates import best_records, judged_records, stream_updates
from tests.test_sources import put, record

NOW = datetime(2024, 3, 1)


def lines(*records):
    import json

    return "\n".join(json.dumps(r) for r in records)


def test_stream_equals_batch(spark, tmp_path):
    base = fixture_files.scan_update_file(spark, _file(tmp_path, "base.json", [record(i, "NS", None, None) for i in range(6)]))
    folder, incoming = str(tmp_path / "table"), tmp_path / "incoming"
    stamped = transform_fixtures(base).selectExpr("*", "timestamp_ntz '2024-01-01 00:00:00' as updated_at")
    snapshots.write_version(stamped, folder, "20240101_000000")
    run = lambda: stream_updates(spark, str(incoming), folder, str(tmp_path / "progress"), NOW).awaitTermination()

    first = [record(1, "FT", 2, 1), record(2, "FT", 0, 0), record(99)]
    put(incoming, lines(*first), "a.json")
    run()
    second = [record(2, "FT", 3, 0), record(3, "NS", None, None, kickoff="2024-09-01T12:00:00Z")]
    put(incoming, lines(*second), "b.json")
    run()
    run()

    batch = stamped
    for name, records in (("one.json", first), ("two.json", second)):
        updates = transform_fixtures(fixture_files.scan_update_file(spark, _file(tmp_path, name, records)))
        batch = coalesce_update(batch, updates, now=NOW)
    rows = lambda df: sorted(map(tuple, df.select(*stamped.columns).collect()))
    assert rows(snapshots.read_version(spark, folder)) == rows(batch)
    assert len(snapshots.versions(spark, folder)) == 3


def test_other_writers_and_new_checkpoints(spark, tmp_path):
    base = fixture_files.scan_update_file(spark, _file(tmp_path, "base.json", [record(i, "NS", None, None) for i in range(6)]))
    folder, incoming = str(tmp_path / "table"), tmp_path / "incoming"
    stamped = transform_fixtures(base).selectExpr("*", "timestamp_ntz '2024-01-01 00:00:00' as updated_at")
    snapshots.write_version(stamped, folder, "20240101_000000")
    run = lambda where: stream_updates(spark, str(incoming), folder, str(tmp_path / where), NOW).awaitTermination()
    finished = lambda: {r.api_fixture_id for r in snapshots.read_version(spark, folder).where("fixture_status = 'FT'").collect()}
    put(incoming, lines(record(1, "FT", 2, 1)), "a.json")
    run("one")
    assert finished() == {1}
    # A daily run after the batch is seen, and a new checkpoint goes on from it.
    daily = transform_fixtures(fixture_files.scan_update_file(spark, _file(tmp_path, "d.json", [record(4, "FT", 1, 1)])))
    snapshots.write_version(coalesce_update(snapshots.read_version(spark, folder), daily, now=NOW), folder, "20240102_000000")
    assert finished() == {1, 4}
    put(incoming, lines(record(5, "FT", 0, 1)), "b.json")
    run("two")
    assert finished() == {1, 4, 5}


def test_best_record_does_not_depend_on_the_order(spark, tmp_path):
    early = [record(1, "NS", None, None), record(2, "NS", None, None, kickoff="2024-09-01T12:00:00Z"), record(3, "FT", 1, 0)]
    late = [record(1, "FT", 2, 1), record(2, "NS", None, None, kickoff="2024-08-01T12:00:00Z"), record(3, "NS", None, None, kickoff="2025-01-01T12:00:00Z")]
    found = []
    for nth, lists in enumerate(((early, late), (late, early), (late, early, late))):
        rows = transform_fixtures(fixture_files.scan_update_file(spark, _file(tmp_path, f"{nth}.json", [r for x in lists for r in x])))
        found.append({r["api_fixture_id"]: tuple(r) for r in best_records(rows.repartition(4)).collect()})
    assert found[0] == found[1] == found[2]
    best = best_records(rows).orderBy("api_fixture_id").collect()
    assert [r["fixture_status"] for r in best] == ["FT", "NS", "FT"] and best[1]["kickoff_utc"].month == 9


@pytest.mark.parametrize("seed", [1, 2])
def test_late_records_are_told_from_those_that_count(spark, tmp_path, seed):
    """Random records in three files: the last best of each fixture is that of a batch over all; the rest is late or a repeat."""
    rng = random.Random(seed)
    some = [
        record(rng.randrange(4), *rng.choice([("FT", 1, 0), ("FT", 2, None), ("NS", None, None), ("PST", None, None)]),
               kickoff=f"2024-0{rng.randint(1, 4)}-01T12:00:00Z")
        for _ in range(24)
    ]
    seen = []

    def collect(batch, _):
        seen.append([r.asDict() for r in batch.collect()])

    for nth in range(3):
        put(tmp_path / "incoming", lines(*some[nth * 8 : nth * 8 + 8]), f"{nth}.json")
        records = transform_fixtures(spark.readStream.schema(FLAT_FIXTURE_TEXT).json(str(tmp_path / "incoming")))
        judged_records(records).writeStream.outputMode("update").foreachBatch(collect).option(
            "checkpointLocation", str(tmp_path / "progress")
        ).trigger(availableNow=True).start().awaitTermination()

    ordered = lambda rows: sorted(rows, key=str)
    split = lambda flag: [
        [{k: v for k, v in r.items() if k != "late"} for r in batch if r["late"] is flag] for batch in seen
    ]
    last = {r["api_fixture_id"]: r for batch in split(False) for r in batch}
    files = [
        [r.asDict() for r in transform_fixtures(fixture_files.scan_update_file(spark, str(tmp_path / "incoming" / f"{n}.json"), False)).collect()]
        for n in range(3)
    ]

    def place(r):
        cells = [r["fixture_status"] == "FT", r["kickoff_utc"], *[v for c, v in r.items() if c not in ("api_fixture_id", "kickoff_utc")]]
        return [(c is not None, c or 0 if not isinstance(c, str) else c) for c in cells]

    def judged(rows):
        """The best of a fixture's records, and the records that it takes a value from."""
        top = {c: max((r for r in rows if r[c] is not None), key=place, default=None) for c in rows[0]}
        return {c: r and r[c] for c, r in top.items()}, [r for r in top.values() if r]

    typed = [r for rows in files for r in rows]
    of = lambda r, rows: [x for x in rows if x["api_fixture_id"] == r["api_fixture_id"]]
    assert ordered(last.values()) == ordered(judged(of({"api_fixture_id": i}, typed))[0] for i in {r["api_fixture_id"] for r in typed})
    want = []
    for nth, rows in enumerate(files):
        so_far = [r for x in files[: nth + 1] for r in x]
        for r in rows:
            best, telling = judged([{k: v for k, v in x.items() if k != "api_fixture_id"} for x in of(r, so_far)])
            own = {k: v for k, v in r.items() if k != "api_fixture_id"}
            want += [r] if own not in telling and own != best else []
    late = [r for batch in split(True) for r in batch]
    assert ordered(late) == ordered(want) and late


def _file(tmp_path, name, records):
    put(tmp_path, records, name)
    return str(tmp_path / name)
