import re
import json
from datetime import datetime

import pytest

from streakline.operators.clean import MissingColumns
from streakline.plans import jobs
from streakline.schemas import REQUIRED_COLUMNS
from streakline.functions.scalars import slugify
from streakline.sources import fixture_files, jdbc, snapshots, tables


def record(i, status="FT", home=1, away=0, kickoff="2024-08-16T19:00:00+00:00", **other):
    base = {
        "api_fixture_id": i,
        "api_league_id": 39,
        "season": 2024,
        "kickoff_utc": kickoff,
        "fixture_status": status,
        "home_team_id": 10,
        "home_team_name": "A",
        "away_team_id": 11,
        "away_team_name": "B",
        "home_team_halftime_goal": None,
        "away_team_halftime_goal": None,
        "home_team_fulltime_goal": home,
        "away_team_fulltime_goal": away,
    }
    return {**base, **other}


def put(folder, content, name="fixtures.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))


def test_scan_tree_of_array_files(spark, tmp_path):
    put(tmp_path / "england" / "premier-league" / "2023", [record(1), record(2)])
    put(tmp_path / "spain" / "la-liga" / "2024", [record(3, season=1900)])
    put(tmp_path / "spain" / "la-liga" / "2022", '[{"api_fixture_id": 4, ')
    put(tmp_path / "spain" / "la-liga" / "2021", [record(5)], "other.json")
    got = fixture_files.scan_fixture_tree(spark, str(tmp_path))
    assert got.columns == REQUIRED_COLUMNS
    assert sorted((r.api_fixture_id, r.season) for r in got.collect()) == [("1", "2023"), ("2", "2023"), ("3", "2024")]
    bad = [r.path for r in fixture_files.unreadable_files(spark, str(tmp_path)).collect()]
    assert len(bad) == 1 and "/2022/" in bad[0]


def test_missing_inputs_give_empty_frames(spark, tmp_path):
    assert fixture_files.scan_fixture_tree(spark, str(tmp_path / "none")).isEmpty()
    assert fixture_files.scan_fixture_tree(spark, str(tmp_path)).isEmpty()
    assert fixture_files.scan_update_file(spark, str(tmp_path / "none.json")).isEmpty()
    put(tmp_path, "not json", "bad.json")
    assert fixture_files.scan_update_file(spark, str(tmp_path / "bad.json")).isEmpty()
    put(tmp_path, [record(1)], "good.json")
    assert fixture_files.scan_update_file(spark, str(tmp_path / "good.json")).count() == 1


def test_tree_keeps_or_replaces_folders(spark, tmp_path):
    base = str(tmp_path / "tree")
    make = lambda status, *seasons: spark.createDataFrame(
        [("Côte d'Ivoire", "Ligue 1", s, i, status) for s in seasons for i in (1, 2)],
        "country string, league_name string, season int, api_fixture_id int, fixture_status string",
    )
    seen = lambda: sorted(
        (r.season, r.fixture_status)
        for r in fixture_files.scan_fixture_tree(spark, base, "*.json", multi_line=False).distinct().collect()
        if r.api_fixture_id == "1"
    )
    fixture_files.write_fixture_tree(make("first", 2021, 2022), base)
    fixture_files.write_fixture_tree(make("second", 2022, 2023), base, overwrite=False)
    assert seen() == [("2021", "first"), ("2022", "first"), ("2023", "second")]
    fixture_files.write_fixture_tree(make("third", 2022), base)
    assert seen() == [("2021", "first"), ("2022", "third"), ("2023", "second")]
    assert (tmp_path / "tree" / "country_slug=cote-d-ivoire" / "league_slug=ligue-1" / "season=2021").is_dir()


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1, "FT")], "api_fixture_id bigint, fixture_status string")
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.latest_snapshot(spark, root, "full")
    with pytest.raises(ValueError, match="unknown mode"):
        snapshots.write_snapshot(one, root, "daily", "20240101_000000")
    snapshots.write_snapshot(one, root, "full", "20240101_000000")
    snapshots.write_snapshot(one.selectExpr("2L as api_fixture_id", "fixture_status"), root, "full", "20240102_000000")
    # A snapshot whose write did not finish has no marker and is not seen.
    (tmp_path / "full" / "parquet" / "version=000000000009_20240103_000000_x").mkdir()
    assert snapshots.latest_snapshot(spark, root, "full").first().api_fixture_id == 2
    assert snapshots.read_csv_snapshot(spark, root, "full", one.schema).first().api_fixture_id == 2


def test_versions_are_ordered_by_number_and_never_written_over(spark, tmp_path):
    folder = str(tmp_path / "table")
    for i, stamp in enumerate(["20240102_000000", "stream00-000000000000", "20240101_000000", "20240101_000000"]):
        snapshots.write_version(spark.range(i, i + 1), folder, stamp)
    read = lambda **how: snapshots.read_version(spark, folder, **how).first().id
    # Both attempts of the last stamp are there, the later one counts.
    assert len(list((tmp_path / "table").iterdir())) == 4
    assert read() == 3 and read(back=1) == 1 and read(before="20240101_000000") == 1
    assert snapshots.has_version(spark, folder) and not snapshots.has_version(spark, folder + "x")
    assert snapshots.remove_old_versions(spark, folder, keep=2) == 1
    assert read() == 3 and read(back=1) == 1


def test_a_failure_midway_leaves_the_last_version(spark, tmp_path):
    folder = str(tmp_path / "table")
    snapshots.write_version(spark.range(3), folder, "20240101_000000")
    with pytest.raises(Exception, match="(?i)divi"):
        snapshots.write_version(spark.range(3).selectExpr("1 div (id - id) as id"), folder, "20240101_000000")
    assert snapshots.read_version(spark, folder).count() == 3


def test_incremental_retry_reads_the_version_before(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1, 1)], "k int, m int")
    tables.materialize(one, "incremental", "t", root, "a", ["k"])
    for _ in range(2):
        done = tables.materialize(spark.createDataFrame([(2, 2)], "k int, m int"), "incremental", "t", root, "b", ["k"])
    assert sorted(map(tuple, done.collect())) == [(1, 1), (2, 2)]


def test_slugs_of_other_scripts_stay_apart(spark):
    names = ["Ελλάδα", "Україна", "日本", "中国", "Việt Nam", "Côte d'Ivoire", "Türkiye", "Cote\u0301 X", "Straße", "a b", "日本 League"]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    found = {r["name"]: r["slug"] for r in rows.select("name", slugify(rows["name"]).alias("slug")).collect()}
    assert len(set(found.values())) == len(names) and all(re.fullmatch("[a-z0-9]+(-[a-z0-9]+)*", s) for s in found.values())
    assert found["Việt Nam"] == "viet-nam" and found["Côte d'Ivoire"] == "cote-d-ivoire" and found["Straße"] == "strasse"


def test_trees_of_two_countries_without_latin_names(spark, tmp_path):
    base = str(tmp_path / "tree")
    make = lambda country: spark.createDataFrame(
        [(country, "League", 2021, 1, "FT")], "country string, league_name string, season int, api_fixture_id int, fixture_status string"
    )
    for country in ("日本", "Україна"):
        fixture_files.write_fixture_tree(make(country), base)
    assert fixture_files.scan_fixture_tree(spark, base, "*.json", multi_line=False).count() == 2


def test_full_refresh_and_archive(spark, tmp_path):
    folder = str(tmp_path / "table")
    for i, stamp in enumerate(["20240101_000000", "20240102_000000"]):
        path = str(tmp_path / f"in{i}")
        spark.range(i, i + 1).write.parquet(path)
        snapshots.full_refresh(spark, path, folder, stamp)
    assert snapshots.read_version(spark, folder).first().id == 1
    assert snapshots.archived(spark, folder).first().id == 0
    with pytest.raises(FileNotFoundError):
        snapshots.full_refresh(spark, str(tmp_path / "none"), folder, "20240103_000000")


def test_scan_by_ids_pushes_the_list_down(spark, tmp_path):
    path = str(tmp_path / "fixtures")
    spark.range(100).selectExpr("id as api_fixture_id", "'FT' as fixture_status").write.parquet(path)
    few = snapshots.scan_by_ids(spark, path, [3, 5])
    assert sorted(r[0] for r in few.collect()) == [3, 5]
    assert "In(api_fixture_id, [3,5])" in few._jdf.queryExecution().toString()
    ids = spark.createDataFrame([(3,), (5,), (5,), (500,)], "api_fixture_id bigint")
    assert snapshots.scan_by_ids(spark, path, ids).count() == 2


def test_materialize(spark, tmp_path):
    root, df = str(tmp_path), spark.createDataFrame([(1, 1), (2, 1)], "k int, m int")
    assert tables.materialize(df, "view", "stg/things").count() == 2
    assert spark.table("stg_things").count() == 2
    tables.materialize(df, "incremental", "t", root, "20240101_000000", ["k"], "m")
    later = spark.createDataFrame([(2, 5), (3, 5), (1, 1)], "k int, m int")
    done = tables.materialize(later, "incremental", "t", root, "20240102_000000", ["k"], "m")
    assert sorted(tuple(r) for r in done.collect()) == [(1, 1), (2, 5), (3, 5)]
    assert tables.materialize(df, "table", "t", root, "20240103_000000").count() == 2
    with pytest.raises(ValueError):
        tables.materialize(df, "cube", "t", root, "20240104_000000")
    with pytest.raises(KeyError):
        tables.source_path(root, "raw.unknown")


def test_jdbc_options():
    plain = jdbc.read_options("jdbc:x", "raw.raw_fixtures", "u", "p")
    assert "partitionColumn" not in plain and plain["dbtable"] == "raw.raw_fixtures"
    split = jdbc.read_options("jdbc:x", "t", "u", "p", "api_fixture_id", (0, 100), 4)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "4")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", "u", "p", "api_fixture_id")


def test_transform_job(spark, tmp_path):
    root = str(tmp_path / "w")
    put(tmp_path / "in" / "x" / "y" / "2024", [record(1), record(2, "ft", 0, 0), record(3, "NS", None, None), record(4, "WO", "3", "0.0")])
    scanned = fixture_files.scan_fixture_tree(spark, str(tmp_path / "in"))
    assert jobs.transform_job(scanned, root, "full", "20240101_000000") == 4
    got = {r.api_fixture_id: r for r in snapshots.latest_snapshot(spark, f"{root}/snapshots", "full").collect()}
    assert [got[i].home_fulltime_result for i in (1, 2, 3, 4)] == ["win", "draw", None, "win"]
    assert got[1].kickoff_utc == datetime(2024, 8, 16, 19) and got[1].season == 2024
    assert jobs.transform_job(scanned.limit(0), root, "full", "20240102_000000") == 0
    with pytest.raises(MissingColumns):
        jobs.transform_job(scanned.drop("season"), root, "full", "20240102_000000")


def test_apply_updates(spark, tmp_path):
    root = str(tmp_path / "w")
    frame = lambda *records: fixture_files.scan_update_file(spark, str(tmp_path / records[0]))
    put(tmp_path, [record(1), record(2, "NS", None, None), record(3, "NS", None, None)], "base.json")
    jobs.transform_job(frame("base.json"), root, "full", "20240101_000000")
    jobs.load_raw(spark, root, "20240101_000000", datetime(2024, 1, 1))
    put(tmp_path, [record(1), record(3, "NS", None, None)], "same.json")
    jobs.transform_job(frame("same.json"), root, "update", "20240102_000000")
    assert jobs.apply_played_updates(spark, root, "20240102_000000", datetime(2024, 1, 2)) == 0
    put(tmp_path, [record(1), record(2, "FT", 2, 2), record(9)], "new.json")
    jobs.transform_job(frame("new.json"), root, "update", "20240103_000000")
    assert jobs.apply_played_updates(spark, root, "20240104_000000", datetime(2024, 1, 4)) == 1
    raw = {r.api_fixture_id: r for r in tables.source_table(spark, root, jobs.RAW).collect()}
    assert sorted(raw) == [1, 2, 3]
    assert (raw[2].home_fulltime_result, raw[2].updated_at) == ("draw", datetime(2024, 1, 4))
    assert raw[1].updated_at == datetime(2024, 1, 1)
    full = {r.api_fixture_id: r.fixture_status for r in snapshots.latest_snapshot(spark, f"{root}/snapshots", "full").collect()}
    assert full == {1: "FT", 2: "FT", 3: "NS"}
    # The feed stays as it came; what was applied of it has a snapshot of its own.
    assert snapshots.latest_snapshot(spark, f"{root}/snapshots", "update").count() == 3
    assert snapshots.latest_snapshot(spark, f"{root}/snapshots", "applied").count() == 1
