from datetime import datetime

import pytest

from streakline.functions.scalars import half_up_hundredths, parse_utc, season_label, slugify, title_case
from streakline.operators import clean, dims
from streakline.schemas import METADATA_DDL, PAYLOAD_DDL, REQUIRED_COLUMNS
from pyspark.sql import functions as F

GOOD = {
    "fixture": {"id": 1, "date": "2024-08-16T19:00:00+00:00", "status": {"short": "FT"}},
    "league": {"id": "39", "season": "2024"},
    "teams": {"home": {"id": 10, "name": "A"}, "away": {"id": 11, "name": "B"}},
    "score": {"halftime": {"home": 1, "away": 0}, "fulltime": {"home": 2, "away": 1}},
}


def payloads(spark, tmp_path, *records):
    import json

    path = tmp_path / "payloads.json"
    path.write_text("\n".join(json.dumps(r) for r in records))
    return spark.read.schema(PAYLOAD_DDL).json(str(path))


def test_flatten_payload(spark, tmp_path):
    row = clean.flatten_payload(payloads(spark, tmp_path, GOOD)).first()
    assert row.asDict() == {
        "api_fixture_id": 1,
        "api_league_id": 39,
        "season": 2024,
        "kickoff_utc": datetime(2024, 8, 16, 19),
        "fixture_status": "FT",
        "home_team_id": 10,
        "home_team_name": "A",
        "away_team_id": 11,
        "away_team_name": "B",
        "home_team_halftime_goal": 1,
        "away_team_halftime_goal": 0,
        "home_team_fulltime_goal": 2,
        "away_team_fulltime_goal": 1,
    }
    assert list(row.asDict()) == REQUIRED_COLUMNS


def test_payload_rules(spark, tmp_path):
    no_status = {**GOOD, "fixture": {"id": 2, "date": "2024-08-16T21:00:00+02:00"}}
    upcoming = {**GOOD, "fixture": {"id": 3}, "score": {"halftime": {"home": None}, "fulltime": {}}}
    unknown_league = {**GOOD, "fixture": {"id": 4}, "league": {"id": "unknown", "season": "unknown"}}
    empty_section = {**GOOD, "fixture": {"id": 5}, "teams": {}}
    two_missing = {"fixture": {"id": 6}, "teams": GOOD["teams"], "score": None}
    df = payloads(spark, tmp_path, no_status, upcoming, unknown_league, empty_section, two_missing)
    good, rejected = clean.split_payloads(df)
    flat = {r.api_fixture_id: r for r in clean.flatten_payload(df).collect()}
    assert sorted(flat) == [2, 3, 4]
    assert flat[2].fixture_status == "NS" and flat[2].kickoff_utc == datetime(2024, 8, 16, 19)
    assert flat[3].home_team_fulltime_goal is None
    assert flat[4].api_league_id is None and flat[4].season is None
    assert {r["fixture"]["id"]: r["missing"] for r in rejected.collect()} == {5: ["teams"], 6: ["score", "league"]}
    assert good.count() == 3


def test_validate_schema(spark):
    df = spark.createDataFrame([(1,)], "api_fixture_id bigint")
    with pytest.raises(clean.MissingColumns, match="away_team_id"):
        clean.validate_schema(df)
    assert clean.validate_schema(df, ["api_fixture_id"]) is df


def test_cast_numeric_columns(spark):
    texts = ["7", " 8 ", "3.0", "2.5", "unknown", None, "-1", "9007199254740993", "1e3", "99999999999999999999"]
    df = spark.createDataFrame([(t, t) for t in texts], "api_fixture_id string, other string")
    got = [r.api_fixture_id for r in clean.cast_numeric_columns(df).collect()]
    assert got == [7, 8, 3, None, None, None, -1, 9007199254740993, 1000, None]
    assert [r.other for r in clean.fractional_values(df).collect()] == ["2.5"]


def test_kickoff_in_any_session_zone(spark):
    df = spark.createDataFrame(
        [("2024-03-31T01:30:00+00:00",), ("2024-03-31T02:30:00Z",), ("2024-03-31 02:30:00",), ("soon",), (None,)],
        "t string",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(parse_utc(F.col("t"))).collect()]
            assert got == [
                datetime(2024, 3, 31, 1, 30),
                datetime(2024, 3, 31, 2, 30),
                datetime(2024, 3, 31, 2, 30),
                None,
                None,
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_text_functions(spark):
    df = spark.createDataFrame([("  São Tomé & Príncipe ",), ("Premier League",), ("Straße 1",)], "t string")
    assert [r[0] for r in df.select(slugify(F.col("t"))).collect()] == ["sao-tome-principe", "premier-league", "strasse-1"]
    df = spark.createDataFrame([("SAINT-étienne fc",), ("o'higgins",), (None,)], "t string")
    assert [r[0] for r in df.select(title_case(F.col("t"))).collect()] == ["Saint-Étienne Fc", "O'Higgins", None]
    df = spark.createDataFrame([(2023,), (1999,)], "y int")
    assert [r[0] for r in df.select(season_label(F.col("y"))).collect()] == ["2023/24", "1999/00"]


def test_half_up_hundredths(spark):
    df = spark.createDataFrame([(1, 3), (1, 8), (23, 40), (0, 5), (2, 0), (None, 2)], "t int, n int")
    got = [r[0] for r in df.select(half_up_hundredths(F.col("t"), F.col("n"))).collect()]
    assert got == [33, 13, 58, 0, None, None]


def test_metadata(spark, tmp_path):
    import json

    season = lambda y, *teams: {"year": y, "start": "2021-08-01", "end": None, "teams": [{"team": t} for t in teams]}
    tree = [
        {
            "country": "Spain",
            "leagues": [
                {
                    "name": "La Liga",
                    "matches": [
                        {
                            "league": {"id": 140},
                            "seasons": [
                                season("2019", {"id": 1, "name": "Old", "code": None}),
                                season("2021", {"id": 2, "name": "New", "code": "NEW"}, None, {"id": 0, "name": "Zero"}),
                                season("n/a", {"id": 4, "name": "Never"}),
                                season("2022", {"id": 2, "name": "New", "code": "NEW"}, {"id": 5, "name": ""}),
                            ],
                        },
                        {"league": {"id": 999}, "seasons": []},
                    ],
                },
                {"name": "Lost", "matches": []},
            ],
        },
        {"country": "Spain", "leagues": []},
    ]
    path = tmp_path / "tree.json"
    path.write_text(json.dumps(tree))
    df = spark.read.schema(METADATA_DDL).option("multiLine", True).json(str(path))
    assert [tuple(r) for r in dims.flatten_countries(df).collect()] == [("Spain",)]
    assert [tuple(r) for r in dims.flatten_leagues(df).collect()] == [("Spain", "La Liga", 140)]
    assert [tuple(r) for r in dims.missing_leagues(df).collect()] == [("Spain", "Lost")]
    seasons = {(r.api_league_id, r.season, r.season_label) for r in dims.flatten_seasons(df).collect()}
    assert seasons == {(140, 2021, "2021/22"), (140, 2022, "2022/23")}
    assert [tuple(r) for r in dims.flatten_teams(df).collect()] == [(2, "New", "NEW", "Spain")]


def test_season_is_current(spark):
    df = spark.createDataFrame(
        [(1, "2024-08-01", "2025-05-31"), (2, "2025-02-01", "2025-05-31"), (3, None, "2025-05-31"), (4, "2025-01-15", "2025-01-15")],
        "league_season_id int, s string, e string",
    ).selectExpr(
        "league_season_id", "1 as league_id", "2024 as season", "'' as season_label",
        "cast(s as date) as start_date", "cast(e as date) as end_date",
    )
    got = {r.league_season_id: r.is_current for r in dims.stg_league_seasons(df, datetime(2025, 1, 15)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}
