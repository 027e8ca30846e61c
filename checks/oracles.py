"""The same results in DuckDB SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

import re

# The events, their kinds and when they hold.
GOALS, RESULT, SPECIAL = "goal_streaks", "result_streaks", "special_streaks"
EVENTS = [
    ("score_1goal", GOALS, "goals_for >= 1"),
    ("score_2goals", GOALS, "goals_for >= 2"),
    ("score_3goals", GOALS, "goals_for >= 3"),
    ("concede_1", GOALS, "goals_against >= 1"),
    ("concede_2", GOALS, "goals_against >= 2"),
    ("concede_3", GOALS, "goals_against >= 3"),
    ("goalless", SPECIAL, "goals_for = 0"),
    ("clean_sheet", SPECIAL, "goals_against = 0"),
    ("win", RESULT, "fulltime_result = 'win'"),
    ("draw", RESULT, "fulltime_result = 'draw'"),
    ("loss", RESULT, "fulltime_result = 'loss'"),
    ("win_or_draw", RESULT, "fulltime_result IN ('win', 'draw')"),
    ("halftime_win", SPECIAL, "halftime_result = 'win'"),
    ("win_draw_over_1_5", SPECIAL, "fulltime_result IN ('win', 'draw') AND goals_for + goals_against > 1.5"),
    ("win_draw_under_4_5", SPECIAL, "fulltime_result IN ('win', 'draw') AND goals_for + goals_against < 4.5"),
]

# The columns of a flat fixture.
FLAT = [
    "api_fixture_id",
    "api_league_id",
    "season",
    "kickoff_utc",
    "fixture_status",
    "home_team_id",
    "home_team_name",
    "away_team_id",
    "away_team_name",
    "home_team_halftime_goal",
    "away_team_halftime_goal",
    "home_team_fulltime_goal",
    "away_team_fulltime_goal",
]
RESULTS = ["home_fulltime_result", "away_fulltime_result", "home_halftime_result", "away_halftime_result"]
flat_list = ", ".join(FLAT)
result_list = ", ".join(RESULTS)
NOW = "TIMESTAMP '2002-01-01 00:00:00'"
AS_OF = "TIMESTAMP '2000-06-30 00:00:00'"


def outcome(own: str, other: str) -> str:
    return f"CASE WHEN {own} > {other} THEN 'win' WHEN {own} < {other} THEN 'loss' WHEN {own} = {other} THEN 'draw' END"


def results(statuses: str) -> str:
    parts = []
    for part in ("fulltime", "halftime"):
        for own, other in (("home", "away"), ("away", "home")):
            o = outcome(f"{own}_team_{part}_goal", f"{other}_team_{part}_goal")
            parts.append(f"CASE WHEN upper(fixture_status) IN ({statuses}) THEN {o} END AS {own}_{part}_result")
    return ", ".join(parts)


ALL_STATUSES = "'FT', 'WO', 'AWD'"

BASE = {
    "sided": """
        SELECT l_orderkey AS k,
               CASE WHEN l_orderkey % 2 = 0 THEN min(l_suppkey) ELSE max(l_suppkey) END AS h,
               CASE WHEN l_orderkey % 2 = 0 THEN max(l_suppkey) ELSE min(l_suppkey) END AS w
        FROM lineitem GROUP BY l_orderkey HAVING min(l_suppkey) <> max(l_suppkey)""",
    "placed": """
        SELECT k, h, w, o_orderdate, o_orderstatus,
               CASE WHEN o_orderstatus = 'O' THEN 'NS'
                    WHEN o_orderstatus = 'P' AND k % 10 = 0 THEN 'WO'
                    WHEN o_orderstatus = 'P' AND k % 10 = 1 THEN 'AWD'
                    WHEN o_orderstatus = 'P' AND k % 10 = 2 THEN 'ABD'
                    WHEN k % 89 = 0 THEN 'ft' ELSE 'FT' END AS fixture_status
        FROM sided JOIN orders ON o_orderkey = k""",
    "goals": """
        SELECT *, CASE WHEN fixture_status <> 'NS' AND k % 97 <> 0 THEN CAST((k * 7 + h) % 4 AS INTEGER) END AS hg,
                  CASE WHEN fixture_status <> 'NS' AND k % 97 <> 0 THEN CAST((k * 11 + w) % 4 AS INTEGER) END AS wg
        FROM placed""",
    "flat": """
        SELECT k AS fixture_id, k AS api_fixture_id, CAST(1000 + hs.s_nationkey AS BIGINT) AS api_league_id,
               CAST(year(o_orderdate) AS INTEGER) AS season, o_orderdate + to_minutes(k % 1440) AS kickoff_utc,
               fixture_status, 5000 + h AS home_team_id, hs.s_name AS home_team_name,
               5000 + w AS away_team_id, ws.s_name AS away_team_name,
               CASE WHEN fixture_status <> 'WO' THEN CAST(hg // 2 AS INTEGER) END AS home_team_halftime_goal,
               CASE WHEN fixture_status <> 'WO' THEN CAST(wg // 2 AS INTEGER) END AS away_team_halftime_goal,
               hg AS home_team_fulltime_goal, wg AS away_team_fulltime_goal,
               o_orderdate AS created_at, o_orderdate + to_hours(k % 240) AS updated_at
        FROM goals JOIN supplier hs ON hs.s_suppkey = h JOIN supplier ws ON ws.s_suppkey = w""",
    "raw": f"SELECT *, {results(ALL_STATUSES)} FROM flat",
    "later": """
        SELECT flat.* REPLACE (
                 CASE WHEN fixture_status = 'NS' AND api_fixture_id % 3 = 0 THEN CAST(api_fixture_id % 4 AS INTEGER)
                      ELSE home_team_fulltime_goal END AS home_team_fulltime_goal,
                 CASE WHEN fixture_status = 'NS' AND api_fixture_id % 3 = 0 THEN CAST(api_fixture_id % 3 AS INTEGER)
                      ELSE away_team_fulltime_goal END AS away_team_fulltime_goal,
                 CASE WHEN fixture_status = 'NS' AND api_fixture_id % 7 = 0 THEN kickoff_utc + INTERVAL 1 DAY
                      ELSE kickoff_utc END AS kickoff_utc,
                 CASE WHEN fixture_status = 'NS' AND api_fixture_id % 3 = 0 THEN 'FT' ELSE fixture_status END AS fixture_status)
        FROM flat JOIN orders ON o_orderkey = fixture_id WHERE o_orderstatus IN ('O', 'P')""",
    "upd": f"SELECT {flat_list}, {results(ALL_STATUSES)} FROM later",
    "dim_countries": "SELECT CAST(r_regionkey AS BIGINT) AS country_id, r_name AS country_name FROM region",
    "dim_leagues": """
        SELECT CAST(n_nationkey AS BIGINT) AS league_id, n_name AS league_name,
               CAST(1000 + n_nationkey AS BIGINT) AS api_league_id, CAST(n_regionkey AS BIGINT) AS country_id FROM nation""",
    "dim_seasons": """
        SELECT CAST(n_nationkey * 10000 + y AS BIGINT) AS league_season_id, CAST(n_nationkey AS BIGINT) AS league_id,
               CAST(y AS INTEGER) AS season, y || '/' || right(CAST(y + 1 AS VARCHAR), 2) AS season_label,
               make_date(y, 1, 1) AS start_date, make_date(y, 12, 31) AS end_date, y < 2000 AS fixtures_bootstrap_done
        FROM nation, (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""",
    "stg_seasons": f"""
        SELECT league_season_id, league_id, season, season_label, start_date, end_date,
               CAST({AS_OF} AS DATE) BETWEEN start_date AND end_date AS is_current FROM dim_seasons""",
    "ctx": """
        SELECT country_name, league_name, l.league_id, api_league_id, season, league_season_id, is_current
        FROM stg_seasons s JOIN dim_leagues l ON l.league_id = s.league_id
        JOIN dim_countries c ON c.country_id = l.country_id""",
    "teams": """
        SELECT s_suppkey AS team_id, 5000 + s_suppkey AS api_team_id, s_name AS team_name,
               'T' || s_nationkey AS team_code, CAST(n_regionkey AS BIGINT) AS country_id
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "named": """
        SELECT flat.*, country_name, league_name FROM flat
        JOIN dim_leagues USING (api_league_id) JOIN dim_countries USING (country_id)""",
    "changed": """
        SELECT b.api_fixture_id,
               coalesce(u.fixture_status = 'FT' AND (b.fixture_status <> 'FT' OR b.fixture_status IS NULL), FALSE) AS now_played,
               coalesce(u.kickoff_utc <> b.kickoff_utc, TRUE) AS rescheduled
        FROM raw b JOIN upd u USING (api_fixture_id)""",
    "tree": """
        SELECT r_name AS country, n_name AS league_name, n_nationkey, s_suppkey, s_nationkey, s_acctbal, s_name
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
}


def merged(source: str, ids: str) -> str:
    """Raw rows with the non-NULL values of ``source``, for the ids a condition picks."""
    columns = [c for c in FLAT if c != "api_fixture_id"] + RESULTS
    sets = ", ".join(f"coalesce(u.{c}, b.{c}) AS {c}" for c in columns)
    return f"""
        SELECT b.* REPLACE ({sets}, CASE WHEN u.api_fixture_id IS NOT NULL THEN {NOW} ELSE b.updated_at END AS updated_at)
        FROM {source} b LEFT JOIN (SELECT * FROM upd WHERE {ids}) u ON u.api_fixture_id = b.api_fixture_id"""


def chain(raw: str, x: str = "") -> dict[str, str]:
    """Enrichment to mart for one raw table."""
    view = lambda own, other, home: f"""
        SELECT fixture_id, league_season_id, league_name, season, kickoff_utc, updated_at, is_played, is_current,
               {own}_team_id AS team_id, {own}_team_name AS team_name, {other}_team_id AS opponent_id,
               {other}_team_name AS opponent_name, {home} AS is_home, {own}_ftg AS goals_for, {other}_ftg AS goals_against,
               {own}_htg AS halftime_goals_for, {other}_htg AS halftime_goals_against,
               {own}_ftr AS fulltime_result, {own}_htr AS halftime_result FROM intf{x}"""  # noqa: E731
    events = ", ".join(
        f"{{'event_name': '{name}', 'event_flag': CAST(({holds}) AS INTEGER), 'streak_type': '{kind}'}}"
        for name, kind, holds in EVENTS
    )
    return {
        f"intf{x}": f"""
            SELECT f.fixture_id, c.league_season_id, c.league_name, f.season, f.kickoff_utc,
                   h.team_id AS home_team_id, a.team_id AS away_team_id, h.team_name AS home_team_name,
                   a.team_name AS away_team_name, home_team_fulltime_goal AS home_ftg, away_team_fulltime_goal AS away_ftg,
                   home_team_halftime_goal AS home_htg, away_team_halftime_goal AS away_htg,
                   home_fulltime_result AS home_ftr, away_fulltime_result AS away_ftr,
                   home_halftime_result AS home_htr, away_halftime_result AS away_htr, f.updated_at,
                   fixture_status = 'FT' AS is_played, fixture_status, c.is_current
            FROM {raw} f JOIN ctx c ON c.api_league_id = f.api_league_id AND c.season = f.season
            JOIN teams h ON h.api_team_id = f.home_team_id JOIN teams a ON a.api_team_id = f.away_team_id""",
        f"tf{x}": f"{view('home', 'away', 'TRUE')} UNION ALL {view('away', 'home', 'FALSE')}",
        f"ev{x}": f"""
            SELECT * EXCLUDE (e, updated_at, halftime_goals_for, halftime_goals_against, halftime_result), unnest(e)
            FROM (SELECT *, unnest([{events}]) AS e FROM tf{x} WHERE is_played)""",
        f"steps{x}": f"""
            SELECT *, row_number() OVER place AS rn, lag(event_flag, 1, 0) OVER place AS before
            FROM ev{x} WHERE is_current
            WINDOW place AS (PARTITION BY team_id, event_name ORDER BY kickoff_utc, fixture_id)""",
        f"runs{x}": f"""
            SELECT *, count(*) FILTER (event_flag = 1 AND before = 0)
                      OVER (PARTITION BY team_id, event_name ORDER BY rn) AS run FROM steps{x}""",
        f"st{x}": f"""
            SELECT *, coalesce(event_flag, 0) * count(*) OVER (PARTITION BY team_id, event_name, run ORDER BY rn)
                      AS streak_length FROM runs{x}""",
        f"cur{x}": f"""
            SELECT team_id, team_name, league_season_id, league_name, event_name, streak_type,
                   streak_length AS current_streak_length
            FROM (SELECT *, row_number() OVER (PARTITION BY team_id, event_name
                                               ORDER BY kickoff_utc DESC, fixture_id DESC) AS back FROM st{x})
            WHERE back = 1""",
        f"mart{x}": f"""
            SELECT row_number() OVER (ORDER BY team_id, league_season_id, event_name, streak_type) AS streak_id,
                   league_name, team_name, event_name, streak_type, current_streak_length
            FROM cur{x} WHERE current_streak_length > 2""",
    }


CTES = {**BASE, **chain("raw"), "raw2": merged("raw", "api_fixture_id IN (SELECT api_fixture_id FROM changed WHERE now_played OR rescheduled)"), **chain("raw2", "2")}

CTES |= {
    "srows": """
        SELECT fixture_id, CAST(kickoff_utc AS DATE) AS date, kickoff_utc, t.season, league_id, country_name AS country,
               t.league_name AS league, team_id, team_name, opponent_id, opponent_name, fulltime_result AS result,
               goals_for AS goals_scored, goals_against AS goals_conceded
        FROM tf t JOIN ctx c USING (league_season_id) WHERE is_played""",
    "days": """
        SELECT *, row_number() OVER (PARTITION BY league_id, season, team_id ORDER BY date, fixture_id) AS matchday,
               count(*) OVER w AS games_played,
               CAST(count(*) FILTER (result = 'win') OVER w AS BIGINT) AS wins,
               CAST(count(*) FILTER (result = 'loss') OVER w AS BIGINT) AS losses,
               CAST(count(*) FILTER (result = 'draw') OVER w AS BIGINT) AS draws,
               CAST(sum(goals_scored) OVER w AS BIGINT) AS goals_for,
               CAST(sum(goals_conceded) OVER w AS BIGINT) AS goals_against,
               count(goals_scored) OVER w AS n_scored, count(goals_conceded) OVER w AS n_conceded,
               CAST(sum(CASE result WHEN 'win' THEN 3 WHEN 'draw' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS rolling_points
        FROM srows WINDOW w AS (PARTITION BY league_id, season, team_id ORDER BY date)""",
    "cents": """
        SELECT *, (200 * wins + games_played) // (2 * games_played) AS cw,
               (200 * losses + games_played) // (2 * games_played) AS cl,
               (200 * draws + games_played) // (2 * games_played) AS cd,
               CASE WHEN n_scored > 0 THEN (200 * goals_for + n_scored) // (2 * n_scored) END AS cf,
               CASE WHEN n_conceded > 0 THEN (200 * goals_against + n_conceded) // (2 * n_conceded) END AS ca
        FROM days""",
    "standing": """
        SELECT *, cw / 100.0::DOUBLE AS rolling_win_rate, cl / 100.0::DOUBLE AS rolling_loss_rate,
               cd / 100.0::DOUBLE AS rolling_draw_rate, cf / 100.0::DOUBLE AS rolling_avg_goals_for,
               ca / 100.0::DOUBLE AS rolling_avg_goals_against, (cw + cd) / 100.0::DOUBLE AS aggregator,
               dense_rank() OVER (PARTITION BY league_id, season, matchday
                                  ORDER BY rolling_points DESC, cw + cd DESC) AS position
        FROM cents""",
    "completed": """
        SELECT raw.*, league_id, country_name, league_name FROM raw JOIN dim_leagues USING (api_league_id)
        JOIN dim_countries USING (country_id) WHERE fixture_status = 'FT'""",
    "stale": f"""
        SELECT raw.*, league_season_id FROM raw
        JOIN dim_leagues USING (api_league_id) JOIN stg_seasons USING (league_id, season)
        WHERE kickoff_utc < {AS_OF} - INTERVAL 2 HOURS
          AND (home_team_fulltime_goal IS NULL OR away_team_fulltime_goal IS NULL) AND is_current""",
    "windows": """
        SELECT league_season_id, api_league_id, season, strftime(CAST(min(kickoff_utc) AS DATE), '%Y-%m-%d') AS from_date
        FROM stale GROUP BY ALL""",
    "staged": f"""
        SELECT fixture_id, {flat_list}, {result_list}, fixture_status = 'FT' AS is_played, created_at, updated_at
        FROM raw""",
    "known_teams": f"SELECT *, {AS_OF} AS created_at, {AS_OF} AS updated_at FROM teams",
    "feed": """
        SELECT api_team_id, CASE WHEN s_acctbal < 0 THEN team_name || ' FC' ELSE team_name END AS team_name,
               CASE WHEN s_acctbal > 9000 THEN NULL WHEN s_acctbal > 8000 THEN 'NEW' ELSE team_code END AS team_code,
               country_id
        FROM teams JOIN supplier ON s_suppkey = team_id
        UNION ALL
        SELECT 1000000000 + c_custkey, c_name, NULL, CAST(n_regionkey AS BIGINT)
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "texts": """
        SELECT ' ' || api_fixture_id AS api_fixture_id, CAST(api_league_id AS VARCHAR) AS api_league_id,
               CASE WHEN api_fixture_id % 11 = 0 THEN 'unknown' ELSE CAST(season AS VARCHAR) END AS season,
               home_team_id || '.0' AS home_team_id, away_team_id,
               CASE WHEN api_fixture_id % 5 = 0 THEN home_team_fulltime_goal || '.0'
                    WHEN api_fixture_id % 5 = 1 THEN home_team_fulltime_goal || '.5'
                    ELSE CAST(home_team_fulltime_goal AS VARCHAR) END AS home_team_fulltime_goal,
               CAST(away_team_fulltime_goal AS DOUBLE) AS away_team_fulltime_goal FROM flat""",
    "good_payloads": f"""
        SELECT {", ".join(f"CASE WHEN api_fixture_id % 61 <> 0 THEN season END AS season" if c == "season" else c for c in FLAT)}
        FROM flat WHERE api_fixture_id % 53 <> 0 AND api_fixture_id % 59 <> 0""",
    "signals": """
        SELECT event_id, user_id, ts, event_type, value, CAST(event_type = 'error' AS INTEGER) AS is_error,
               CAST(value > 10 AS INTEGER) AS is_high FROM events""",
    "signal_steps": """
        SELECT *, row_number() OVER place AS rn, lag(is_error, 1, 0) OVER place AS error_before,
               lag(is_high, 1, 0) OVER place AS high_before
        FROM signals WINDOW place AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "signal_runs": """
        SELECT *, count(*) FILTER (is_error = 1 AND error_before = 0) OVER so_far AS is_error_run,
               count(*) FILTER (is_high = 1 AND high_before = 0) OVER so_far AS is_high_run
        FROM signal_steps WINDOW so_far AS (PARTITION BY user_id ORDER BY rn)""",
    "reset_steps": """
        SELECT *, coalesce(event_flag, 0) AS f, row_number() OVER place AS rn,
               lag(coalesce(event_flag, 0), 1, 0) OVER place AS before
        FROM ev WHERE is_current WINDOW place AS (PARTITION BY team_id, event_name ORDER BY kickoff_utc, fixture_id)""",
    "reset_runs": """
        SELECT *, count(*) FILTER (f = 1 AND before = 0) OVER (PARTITION BY team_id, event_name ORDER BY rn) AS run
        FROM reset_steps""",
}


# The running table of the older layout.
side = lambda own, other: f"""
    SELECT fixture_id, CAST(kickoff_utc AS DATE) AS date, kickoff_utc, season, league_id, country_name AS country,
        league_name AS league, {own}_team_id AS team_id, {own}_team_name AS team_name, {other}_team_id AS opponent_id,
        {other}_team_name AS opponent_name, {own}_fulltime_result AS result, {own}_team_fulltime_goal AS goals_scored,
        {other}_team_fulltime_goal AS goals_conceded FROM completed"""  # noqa: E731
CTES["srows_old"] = f"{side('home', 'away')} UNION ALL {side('away', 'home')}"
for new, name, source in (("days_old", "days", "srows"), ("cents_old", "cents", "days"), ("standing_old", "standing", "cents")):
    CTES[new] = CTES[name].replace(f"FROM {source}", f"FROM {source}_old")


def sql(body: str) -> str:
    """Prefix the CTEs a query uses, directly or through others, in definition order."""
    def used(text: str) -> set[str]:
        return {n for n in CTES if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)}

    todo, needed = used(body), set()
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= used(CTES[name]) - needed
    parts = [f"{n} AS ({CTES[n].strip()})" for n in CTES if n in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()


def iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def upsert_teams(differs: str) -> str:
    return f"""
        SELECT team_id, t.api_team_id,
               CASE WHEN {differs} THEN f.team_name ELSE t.team_name END AS team_name,
               CASE WHEN {differs} THEN f.team_code ELSE t.team_code END AS team_code,
               CASE WHEN {differs} THEN f.country_id ELSE t.country_id END AS country_id,
               created_at, CASE WHEN {differs} THEN {NOW} ELSE updated_at END AS updated_at
        FROM known_teams t LEFT JOIN feed f ON f.api_team_id = t.api_team_id
        UNION ALL
        SELECT (SELECT max(team_id) FROM known_teams) + row_number() OVER (ORDER BY api_team_id),
               api_team_id, team_name, team_code, country_id, {NOW}, {NOW}
        FROM feed WHERE api_team_id NOT IN (SELECT api_team_id FROM known_teams)"""


UNSAFE = "coalesce(t.team_name <> f.team_name, FALSE) OR coalesce(t.team_code <> f.team_code, FALSE) OR coalesce(t.country_id <> f.country_id, FALSE)"
SAFE = "f.api_team_id IS NOT NULL AND (t.team_name IS DISTINCT FROM f.team_name OR t.team_code IS DISTINCT FROM f.team_code OR t.country_id IS DISTINCT FROM f.country_id)"

# Words in title case: letters and digits in runs, each run's first letter upper.
TITLE = r"array_to_string(list_transform(regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), lambda w: upper(w[1]) || w[2:]), '')"

MERGED_ALL = merged("raw", "TRUE")

ORACLES: dict[str, str] = {
    # A
    "scan_fixture_tree": f"SELECT {flat_list} FROM flat",
    "scan_update_file": f"SELECT {flat_list} FROM upd",
    "scan_status_columns": "SELECT api_fixture_id, fixture_status, kickoff_utc FROM raw",
    "scan_by_ids": f"""SELECT {flat_list} FROM upd WHERE api_fixture_id IN
        (SELECT api_fixture_id FROM changed WHERE now_played OR rescheduled)""",
    "latest_snapshot": f"SELECT {flat_list} FROM upd",
    "write_snapshot": f"SELECT fixture_id, {flat_list}, {result_list}, created_at, updated_at FROM raw",
    "full_refresh_with_archive": f"""SELECT {flat_list}, 'current' AS version FROM upd
        UNION ALL SELECT {flat_list}, 'archive' FROM raw""",
    "flatten_payload": "SELECT * FROM good_payloads",
    "write_fixture_tree": """SELECT regexp_replace(lower(country_name), '[^a-z0-9]+', '-', 'g') AS country_slug,
        regexp_replace(lower(league_name), '[^a-z0-9]+', '-', 'g') AS league_slug, season, count(*) AS fixtures,
        count(*) FILTER (season >= 2000) AS written_again FROM named GROUP BY ALL""",
    "write_json_records": "SELECT * FROM good_payloads",
    "source_table": f"SELECT fixture_id, {flat_list}, {result_list}, created_at, updated_at FROM raw",
    "materialize_incremental": "SELECT * EXCLUDE (created_at) FROM staged",
    "materialize_view": "SELECT * FROM ev",
    "flatten_metadata_countries": "SELECT DISTINCT country AS country_name FROM tree",
    "flatten_metadata_leagues": """SELECT DISTINCT country AS country_name, league_name,
        CAST(n_nationkey + 1000 AS BIGINT) AS api_league_id FROM tree WHERE n_nationkey <> 7""",
    "flatten_metadata_seasons": """SELECT DISTINCT CAST(n_nationkey + 1000 AS BIGINT) AS api_league_id,
        CAST(y AS INTEGER) AS season, y || '/' || right(CAST(y + 1 AS VARCHAR), 2) AS season_label,
        y || '-08-01' AS start_date, (y + 1) || '-05-31' AS end_date
        FROM tree, (VALUES (2021), (2022)) AS v(y) WHERE n_nationkey <> 7""",
    "flatten_metadata_teams": """SELECT 5000 + s_suppkey AS api_team_id, s_name AS team_name,
        'T' || s_nationkey AS team_code, country AS country_name FROM tree WHERE n_nationkey <> 7 AND s_acctbal >= 0""",
    "flatten_team_payload": """SELECT s_name AS name, s_suppkey AS id, CAST(s_nationkey AS VARCHAR) AS code
        FROM supplier WHERE s_acctbal >= 0""",
    # B
    "stg_countries": "SELECT country_id, country_name FROM dim_countries",
    "stg_leagues": "SELECT league_id, api_league_id, league_name, country_id FROM dim_leagues",
    "stg_teams": "SELECT team_id, api_team_id, team_name FROM teams",
    "stg_league_seasons": f"""SELECT league_season_id, league_id, season, season_label, {iso('start_date')},
        {iso('end_date')}, is_current FROM stg_seasons""",
    "stg_fixtures": "SELECT * FROM staged",
    "validate_schema": f"SELECT {flat_list} FROM flat",
    "validate_payload": """SELECT home_team_fulltime_goal AS home_goals, home_team_id, away_team_id,
        CASE WHEN api_fixture_id % 53 = 0 AND api_fixture_id % 59 = 0 THEN 'fixture,league'
             WHEN api_fixture_id % 53 = 0 THEN 'fixture' WHEN api_fixture_id % 59 = 0 THEN 'league' ELSE '' END AS missing
        FROM flat""",
    "stg_completed_fixtures": f"""SELECT fixture_id, season, kickoff_utc AS date, fixture_status AS status,
        country_name AS country, league_name AS league, league_id, home_team_id, home_team_name, away_team_id, away_team_name,
        home_team_halftime_goal, away_team_halftime_goal, home_team_fulltime_goal, away_team_fulltime_goal, {result_list}
        FROM raw JOIN dim_leagues USING (api_league_id) JOIN dim_countries USING (country_id) WHERE fixture_status = 'FT'""",
    "cast_numeric_columns": """SELECT api_fixture_id, api_league_id,
        CASE WHEN api_fixture_id % 11 <> 0 THEN season END AS season, home_team_id, away_team_id,
        CASE WHEN api_fixture_id % 5 <> 1 THEN home_team_fulltime_goal END AS home_team_fulltime_goal,
        away_team_fulltime_goal FROM flat""",
    "fractional_values": """SELECT api_fixture_id, home_team_fulltime_goal || '.5' AS home_team_fulltime_goal FROM flat
        WHERE api_fixture_id % 5 = 1 AND home_team_fulltime_goal IS NOT NULL""",
    "normalize_status": "SELECT api_fixture_id, fixture_status, upper(fixture_status) AS status_upper FROM flat",
    "special_results": f"SELECT api_fixture_id, {results(chr(39) + 'WO' + chr(39) + ', ' + chr(39) + 'AWD' + chr(39))} FROM flat",
    "game_results": f"SELECT api_fixture_id, {results(chr(39) + 'FT' + chr(39))} FROM flat",
    "compute_results": f"SELECT api_fixture_id, {result_list} FROM raw",
    "upcoming_fixtures": "SELECT api_fixture_id, fixture_status FROM raw WHERE home_fulltime_result IS NULL",
    "season_rows": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season,
        year(o_orderdate) || '/' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) AS season_label,
        strftime(o_orderdate, '%Y-%m-%d') AS start_date, CAST(NULL AS VARCHAR) AS end_date
        FROM orders WHERE o_orderstatus <> 'P' AND year(o_orderdate) >= 1999""",
    "valid_teams": "SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey <> 0 AND s_nationkey NOT IN (3, 4)",
    "played_only": "SELECT fixture_id, team_id FROM tf WHERE is_played",
    "current_played_only": "SELECT fixture_id, team_id FROM tf WHERE is_played AND is_current",
    "stale_predicate": f"""SELECT api_fixture_id, kickoff_utc FROM raw WHERE kickoff_utc < {AS_OF} - INTERVAL 2 HOURS
        AND (home_team_fulltime_goal IS NULL OR away_team_fulltime_goal IS NULL)""",
    "dim_teams": f"SELECT team_id, api_team_id, {TITLE.format(x='upper(team_name)')} AS team_name FROM teams",
    "bootstrap_worklist": """SELECT country_name, league_name, api_league_id, CAST(year(start_date) AS INTEGER) AS season_year,
        league_season_id FROM dim_seasons JOIN dim_leagues USING (league_id) JOIN dim_countries USING (country_id)
        WHERE NOT fixtures_bootstrap_done""",
    # C
    "league_context": "SELECT * FROM ctx",
    "enrich_fixtures": "SELECT * FROM intf",
    "diff_join": """SELECT b.api_fixture_id, b.fixture_status AS fixture_status_base, b.kickoff_utc AS kickoff_utc_base,
        u.fixture_status AS fixture_status_upd, u.kickoff_utc AS kickoff_utc_upd FROM raw b JOIN upd u USING (api_fixture_id)""",
    "stale_fixture_ids": "SELECT DISTINCT api_fixture_id FROM stale",
    "refresh_windows": "SELECT * FROM windows",
    "season_catalog": """SELECT country_name, league_name, api_league_id, CAST(year(start_date) AS INTEGER) AS season_year,
        league_season_id, fixtures_bootstrap_done
        FROM dim_seasons JOIN dim_leagues USING (league_id) JOIN dim_countries USING (country_id)""",
    "unpivot_team_rows": "SELECT * FROM tf",
    "fact_team_fixtures": """SELECT * EXCLUDE (updated_at), lead(opponent_id) OVER w AS next_opponent_id,
        lead(kickoff_utc) OVER w AS next_kickoff_utc
        FROM tf WINDOW w AS (PARTITION BY team_id ORDER BY kickoff_utc, fixture_id)""",
    "fact_team_events": "SELECT * FROM ev",
    "update_join": f"""SELECT b.api_fixture_id, coalesce(u.kickoff_utc, b.kickoff_utc) AS kickoff_utc,
        CASE WHEN u.api_fixture_id IS NOT NULL THEN {NOW} ELSE b.updated_at END AS updated_at
        FROM raw b LEFT JOIN upd u ON u.api_fixture_id = b.api_fixture_id""",
    "missing_leagues": """SELECT r_name AS country, n_name AS league FROM nation JOIN region ON r_regionkey = n_regionkey
        WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
          AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""",
    "missing_leagues_in_tree": "SELECT DISTINCT country, league_name AS league FROM tree WHERE n_nationkey = 7",
    "orphan_check": """SELECT home_team_id, count(*) AS failing FROM intf
        WHERE home_team_id NOT IN (SELECT team_id FROM teams WHERE country_id <> 2) GROUP BY home_team_id""",
    "only_known_ids": """SELECT api_fixture_id, fixture_status FROM upd WHERE api_fixture_id IN
        (SELECT api_fixture_id FROM raw WHERE home_fulltime_result IS NULL)""",
    # D
    "group_min": "SELECT api_league_id, season, min(kickoff_utc) AS first_kickoff FROM raw GROUP BY ALL",
    "distinct_ids": "SELECT DISTINCT fixture_id FROM tf",
    "high_water_mark": """SELECT api_fixture_id, updated_at FROM raw WHERE updated_at >
        (SELECT max(updated_at) FROM raw WHERE updated_at < TIMESTAMP '2000-01-01 00:00:00')""",
    "keep_last_per_key": """SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_returnflag FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""",
    "count_missing": "SELECT count(*) AS fixtures, count(*) FILTER (home_fulltime_result IS NULL) AS upcoming FROM raw",
    "change_counts": """SELECT count(*) FILTER (now_played) AS now_played, count(*) FILTER (rescheduled) AS rescheduled
        FROM changed""",
    # E
    "next_fixture": """SELECT fixture_id, team_id, lead(opponent_id) OVER w AS next_opponent_id,
        lead(kickoff_utc) OVER w AS next_kickoff_utc FROM tf
        WINDOW w AS (PARTITION BY team_id ORDER BY kickoff_utc, fixture_id)""",
    "next_event": """SELECT event_id, user_id, ts, event_type, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "number_rows": "SELECT team_id, event_name, kickoff_utc, fixture_id, event_flag, rn FROM steps",
    "previous_flag": "SELECT team_id, fixture_id, event_name, streak_type, event_flag, before AS prev_flag FROM steps",
    "streak_id": "SELECT team_id, fixture_id, event_name, streak_type, event_flag, run AS streak_id FROM runs",
    "streak_length": "SELECT team_id, fixture_id, event_name, streak_type, event_flag, streak_length FROM st",
    "fact_team_streaks": """SELECT team_id, team_name, league_season_id, league_name, fixture_id, kickoff_utc, event_name,
        streak_type, event_flag, streak_length FROM st""",
    "null_resets_streaks": """SELECT team_id, team_name, league_season_id, league_name, fixture_id, kickoff_utc, event_name,
        streak_type, event_flag, f * count(*) OVER (PARTITION BY team_id, event_name, run ORDER BY rn) AS streak_length
        FROM reset_runs""",
    "latest_row": """SELECT team_id, event_name, kickoff_utc, fixture_id, event_flag, streak_length FROM st
        QUALIFY row_number() OVER (PARTITION BY team_id, event_name ORDER BY kickoff_utc DESC, fixture_id DESC) = 1""",
    "display_id": """SELECT *, row_number() OVER (ORDER BY team_id, league_season_id, event_name, streak_type) AS streak_id
        FROM cur WHERE current_streak_length > 2""",
    "running_counts": "SELECT fixture_id, team_id, games_played, wins, losses, draws FROM days",
    "running_goals": "SELECT fixture_id, team_id, goals_for, goals_against FROM days",
    "rolling_rates": "SELECT fixture_id, team_id, rolling_win_rate, rolling_loss_rate, rolling_draw_rate FROM standing",
    "rolling_averages": "SELECT fixture_id, team_id, rolling_avg_goals_for, rolling_avg_goals_against FROM standing",
    "rolling_points": "SELECT fixture_id, team_id, rolling_points FROM days",
    "tie_breaker": "SELECT fixture_id, team_id, aggregator FROM standing",
    "matchday_numbers": "SELECT fixture_id, team_id, matchday FROM days",
    "league_position": "SELECT fixture_id, team_id, matchday, position FROM standing",
    "team_running_table": f"""SELECT fixture_id, {iso('date')}, matchday, team_name, team_id, position, league, league_id, country,
        season, result, opponent_name, opponent_id, games_played, wins, losses, draws, goals_scored, goals_conceded, goals_for,
        goals_against, rolling_win_rate, rolling_draw_rate, rolling_loss_rate, rolling_avg_goals_for,
        rolling_avg_goals_against, rolling_points FROM standing""",
    # F, G
    "rank_current_streaks": "SELECT *, row_number() OVER (ORDER BY current_streak_length DESC, team_name, streak_id) AS place FROM mart",
    "min_length_filter": "SELECT * FROM cur WHERE current_streak_length > 4",
    "top_one_per_group": """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "page_batches": """SELECT CAST((nr - 1) // 20 AS BIGINT) AS batch,
        string_agg(CAST(api_fixture_id AS VARCHAR), '-' ORDER BY api_fixture_id) AS ids, count(*) AS n_ids
        FROM (SELECT api_fixture_id, row_number() OVER (ORDER BY api_fixture_id) AS nr FROM raw) GROUP BY ALL""",
    "number_all_rows": "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS nr FROM orders",
    "concat_frames": """SELECT api_fixture_id, fixture_status, updated_at, NULL::TIMESTAMP AS kickoff_utc FROM raw
        UNION ALL SELECT api_fixture_id, fixture_status, NULL, kickoff_utc FROM upd""",
    "union_ids": "SELECT api_fixture_id FROM changed WHERE now_played OR rescheduled",
    # H, J
    "scalar_functions": f"""SELECT o_orderkey,
        trim(regexp_replace(strip_accents(lower(o_orderpriority || ' & São Café & ' || o_orderstatus)), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
        {TITLE.format(x="o_orderpriority || ' saint-étienne fc'")} AS title,
        year(o_orderdate) || '/' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) AS label,
        strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp, strftime(o_orderdate, '%Y-%m-%d') AS day,
        o_orderdate - INTERVAL 2 HOURS AS two_hours_before FROM orders""",
    "custom_event_catalog": """WITH own_events AS (
            SELECT *, unnest([
                {'event_name': 'narrow_win', 'streak_type': 'result_streaks',
                 'flag': CAST((fulltime_result = 'win' AND goals_for - goals_against = 1) AS INTEGER)},
                {'event_name': 'away_goal', 'streak_type': 'goal_streaks',
                 'flag': CAST((NOT is_home AND goals_for > 0) AS INTEGER)}], recursive := true)
            FROM tf WHERE is_played AND is_current),
        own_steps AS (SELECT *, row_number() OVER place AS rn, lag(flag, 1, 0) OVER place AS before FROM own_events
               WINDOW place AS (PARTITION BY team_id, event_name ORDER BY kickoff_utc, fixture_id)),
        own_runs AS (SELECT *, count(*) FILTER (flag = 1 AND before = 0)
                         OVER (PARTITION BY team_id, event_name ORDER BY rn) AS run FROM own_steps)
        SELECT team_id, team_name, league_season_id, league_name, event_name, streak_type,
               coalesce(flag, 0) * count(*) OVER (PARTITION BY team_id, event_name, run ORDER BY rn) AS current_streak_length
        FROM own_runs QUALIFY row_number() OVER (PARTITION BY team_id, event_name ORDER BY rn DESC) = 1""",
    # I
    "stream_update_files": f"SELECT fixture_id, {flat_list}, {result_list}, created_at, updated_at FROM ({MERGED_ALL})",
    # K
    "insert_or_ignore": """SELECT country_id, country_name FROM dim_countries WHERE country_id < 3
        UNION ALL SELECT 2 + row_number() OVER (ORDER BY name), name
        FROM (SELECT r_name AS name FROM region UNION SELECT n_name FROM nation)
        WHERE name NOT IN (SELECT country_name FROM dim_countries WHERE country_id < 3)""",
    "upsert_teams": upsert_teams(UNSAFE),
    "upsert_teams_null_safe": upsert_teams(SAFE),
    "upsert_leagues": f"""SELECT league_id, league_name, api_league_id, country_id, {AS_OF} AS created_at,
            CASE WHEN league_id > 10 THEN {NOW} ELSE {AS_OF} END AS updated_at FROM dim_leagues WHERE country_id < 3
        UNION ALL SELECT (SELECT max(league_id) FROM dim_leagues WHERE country_id < 3)
            + row_number() OVER (ORDER BY api_league_id), league_name, api_league_id, country_id, {NOW}, {NOW}
        FROM dim_leagues WHERE country_id >= 3""",
    "upsert_league_seasons": f"""SELECT league_season_id, league_id, season, season_label, {iso('start_date')},
            CASE WHEN season <> 1998 THEN strftime(end_date, '%Y-%m-%d') END AS end_date, {AS_OF} AS updated_at
        FROM dim_seasons WHERE season < 2001
        UNION ALL SELECT (SELECT max(league_season_id) FROM dim_seasons WHERE season < 2001)
            + row_number() OVER (ORDER BY league_id, season), league_id, season, season_label,
            strftime(start_date, '%Y-%m-%d'), strftime(end_date, '%Y-%m-%d'), {NOW}
        FROM dim_seasons WHERE season >= 2001""",
    "coalesce_update": f"SELECT fixture_id, {flat_list}, {result_list}, created_at, updated_at FROM ({MERGED_ALL})",
    "changed_ids": "SELECT api_fixture_id FROM changed WHERE now_played OR rescheduled",
    "incremental_append": """WITH mark AS (SELECT max(updated_at) AS m FROM raw WHERE updated_at < TIMESTAMP '2000-06-30 00:00:00')
        SELECT api_fixture_id, CASE WHEN updated_at > m THEN lower(fixture_status) ELSE fixture_status END AS fixture_status,
               updated_at FROM raw, mark""",
    "replace_by_key": f"""SELECT {flat_list} FROM upd
        UNION ALL SELECT {flat_list} FROM raw WHERE api_fixture_id NOT IN (SELECT api_fixture_id FROM upd)""",
    "mark_bootstrap_done": f"""SELECT league_season_id,
        fixtures_bootstrap_done OR league_season_id IN (SELECT league_season_id FROM intf) AS fixtures_bootstrap_done,
        CASE WHEN league_season_id IN (SELECT league_season_id FROM intf) THEN {NOW} END AS fixtures_bootstrap_at
        FROM dim_seasons""",
    "apply_played_updates": f"""SELECT {flat_list}, {result_list},
        CASE WHEN updated_at = {NOW} THEN updated_at ELSE TIMESTAMP '2001-01-01 00:00:00' END AS updated_at FROM raw2""",
    # L
    "check_not_null": "SELECT api_fixture_id FROM raw WHERE home_fulltime_result IS NULL",
    "check_unique": "SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
    "check_relationship": """SELECT league_season_id, count(*) AS failing FROM intf
        WHERE league_season_id NOT IN (SELECT league_season_id FROM ctx WHERE season > 1998) GROUP BY ALL""",
    "check_unique_by_bitmap": """SELECT o_orderkey, count(*) AS occurrences FROM (
        SELECT o_orderkey FROM orders UNION ALL SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7
        ) GROUP BY o_orderkey HAVING count(*) > 1""",
    "check_relationship_by_bitmap": """SELECT l_orderkey, count(*) AS failing FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY l_orderkey""",
    "check_accepted_values": """SELECT api_fixture_id, fixture_status FROM raw
        WHERE fixture_status NOT IN ('FT', 'NS', 'WO', 'AWD')""",
    "quality_report": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", '{kind}' AS "check", {count} AS failing FROM {source}"""
        for t, s, filled, unique in [
            ("raw_fixtures", "raw", [*FLAT[:9], "created_at", "updated_at"], ["api_fixture_id"]),
            ("int_league_context", "ctx", ["league_season_id", "league_id", "season", "league_name", "country_name"], ["league_season_id"]),
            ("dim_teams", "teams", ["team_id", "api_team_id", "team_name"], ["team_id", "api_team_id"]),
            ("int_fixtures", "intf", ["fixture_id", "league_season_id", "kickoff_utc", "home_team_id", "away_team_id", "is_played"], ["fixture_id"]),
            ("fact_team_fixtures", "tf", ["fixture_id", "team_id", "opponent_id", "is_home"], []),
            ("int_teams_stats", "standing", ["team_id", "matchday", "position", "games_played", "rolling_points"], []),
            ("mart_top_team_streaks", "mart", ["streak_id", "league_name", "team_name", "event_name", "streak_type", "current_streak_length"], ["streak_id"]),
        ]
        for c, kind, count, source in [
            *[(c, "not_null", f"count(*) FILTER ({c} IS NULL)", s) for c in filled],
            *[(c, "unique", "count(*)", f"(SELECT {c} FROM {s} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for c in unique],
        ]
    )
    + "".join(
        f""" UNION ALL SELECT '{t}', '{c}', 'accepted_values', count(*) FILTER ({c} NOT IN ({values})) FROM {s}"""
        for t, s, c, values in [
            *[("raw_fixtures", "raw", c, "'win', 'draw', 'loss'") for c in RESULTS],
            ("fact_team_fixtures", "tf", "fulltime_result", "'win', 'draw', 'loss'"),
            ("mart_top_team_streaks", "mart", "event_name", ", ".join(f"'{e[0]}'" for e in EVENTS)),
            ("mart_top_team_streaks", "mart", "streak_type", f"'{GOALS}', '{RESULT}', '{SPECIAL}'"),
        ]
    )
    + "".join(
        f""" UNION ALL SELECT 'int_fixtures', '{c}', 'relationship', count(*) FROM intf WHERE {c} NOT IN (SELECT {p} FROM {s})"""
        for c, p, s in [
            ("league_season_id", "league_season_id", "ctx"),
            ("home_team_id", "team_id", "teams"),
            ("away_team_id", "team_id", "teams"),
        ]
    ),
    # M
    "mart_top_team_streaks": "SELECT * FROM mart",
    "mart_latest_team_streaks": "SELECT team_id, team_name, event_name, current_streak_length AS streak_count FROM cur",
    "list_streaks": """SELECT streak_id, streak_type, current_streak_length AS streak_count, event_name, team_name, league_name
        FROM mart""",
    "full_refresh_job": "SELECT * FROM mart",
    "daily_update_job": "SELECT * FROM mart2",
    "metadata_load_job": """WITH asked AS (
            SELECT DISTINCT country AS country_name, league_name, CAST(n_nationkey + 1000 AS BIGINT) AS api_league_id
            FROM tree WHERE n_nationkey <> 7
        ), counted AS (
            SELECT country AS country_name, count(DISTINCT s_suppkey) AS teams FROM tree
            WHERE n_nationkey <> 7 AND s_acctbal >= 0 GROUP BY country
        )
        SELECT country_name, league_name, api_league_id, CAST(y AS INTEGER) AS season,
            y || '/' || right(CAST(y + 1 AS VARCHAR), 2) AS season_label, teams, false AS fixtures_bootstrap_done
        FROM asked LEFT JOIN counted USING (country_name), (VALUES (2021), (2022)) AS v(y)""",
    "bootstrap_job": f"""WITH wanted AS (
            SELECT league_season_id, api_league_id, CAST(year(start_date) AS INTEGER) AS season FROM dim_seasons
            JOIN dim_leagues USING (league_id) WHERE season >= 1994
        ), fetched AS (
            SELECT f.*, w.league_season_id FROM flat f JOIN wanted w USING (api_league_id, season)
            WHERE api_fixture_id % 53 <> 0 AND api_fixture_id % 59 <> 0 AND api_fixture_id % 61 <> 0
        )
        SELECT {flat_list}, (SELECT count(*) FROM wanted WHERE league_season_id NOT IN (SELECT league_season_id FROM fetched))
            AS seasons_left FROM fetched""",
    "blanked_values": """SELECT CAST(o_orderkey AS VARCHAR) AS api_fixture_id, 'home_team_fulltime_goal' AS "column",
            CAST(o_totalprice AS VARCHAR) AS value FROM orders WHERE o_totalprice <> floor(o_totalprice)
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'away_team_fulltime_goal', o_orderpriority FROM orders WHERE o_orderkey % 7 = 0
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'kickoff_utc', 'soon' FROM orders WHERE o_orderkey % 11 = 0""",
    "retry_is_harmless": "SELECT *, (SELECT count(*) FROM upd) AS feed_rows FROM mart2",
    "transform_fixtures_job": f"SELECT {flat_list}, {result_list} FROM raw",
    "update_by_league_season": """SELECT league_season_id, api_league_id AS league, season, from_date AS "from",
        '2000-06-30' AS "to" FROM windows""",
    "update_by_ids": """SELECT CAST((nr - 1) // 20 AS BIGINT) AS batch,
        string_agg(CAST(api_fixture_id AS VARCHAR), '-' ORDER BY api_fixture_id) AS ids, count(*) AS n_ids
        FROM (SELECT api_fixture_id, row_number() OVER (ORDER BY api_fixture_id) AS nr
              FROM (SELECT DISTINCT api_fixture_id FROM stale)) GROUP BY ALL""",
}

for kind in ("goal_streaks", "result_streaks", "special_streaks"):
    ORACLES[f"list_{kind}"] = f"{ORACLES['list_streaks']} WHERE streak_type = '{kind}'"

lengths = ", ".join(
    f"{f} * count(*) OVER (PARTITION BY user_id, {f}_run ORDER BY rn) AS {f}_length" for f in ("is_error", "is_high")
)
ORACLES["run_length_streaks"] = f"""SELECT event_id, user_id, ts, event_type, value, is_error, is_high, {lengths},
    is_error_run, is_high_run FROM signal_runs"""
ORACLES["run_length_chunked"] = ORACLES["run_length_streaks"]
ORACLES["team_running_table_cut"] = ORACLES["team_running_table"]
ORACLES["team_running_table_completed"] = ORACLES["team_running_table"].replace("FROM standing", "FROM standing_old")
ORACLES["materialize_buckets"] = ORACLES["materialize_incremental"]
ORACLES["update_touched_buckets"] = ORACLES["coalesce_update"]
ORACLES["replace_touched_buckets"] = ORACLES["replace_by_key"]
ORACLES["incremental_streaks"] = ORACLES["fact_team_streaks"]
ORACLES["incremental_current_streaks"] = """SELECT team_id, team_name, league_season_id, league_name, event_name, streak_type,
    current_streak_length FROM cur"""
ORACLES["repaired_next_fixtures"] = ORACLES["fact_team_fixtures"]
ORACLES["incremental_update_job"] = ORACLES["daily_update_job"]
ORACLES["incremental_update_streaks"] = """SELECT team_id, team_name, league_season_id, league_name, fixture_id, kickoff_utc,
    event_name, streak_type, event_flag, streak_length FROM st2"""
ORACLES["stream_increments_streaks"] = ORACLES["incremental_update_streaks"]
ORACLES["stream_late_records"] = f"""SELECT {flat_list}, FALSE AS late FROM raw2
    UNION ALL SELECT {", ".join("f." + c for c in FLAT)}, TRUE FROM flat f JOIN upd u USING (api_fixture_id)
    WHERE f.api_fixture_id % 2 = 0 AND (f.fixture_status <> u.fixture_status OR f.kickoff_utc <> u.kickoff_utc)"""
ORACLES["quality_report_by_bitmap"] = f"""SELECT * FROM ({ORACLES["quality_report"]})
    WHERE "table" IN ('raw_fixtures', 'int_league_context', 'dim_teams', 'int_fixtures') AND "check" IN ('unique', 'relationship')"""
ORACLES["quality_report_scanned"] = f"""SELECT * FROM ({ORACLES["quality_report"]})
    WHERE "table" IN ('raw_fixtures', 'int_league_context', 'dim_teams', 'int_fixtures')"""
ORACLES["append_by_mark"] = """WITH edge AS (SELECT max(updated_at) AS m FROM raw WHERE updated_at < TIMESTAMP '1999-06-30 00:00:00')
    SELECT api_fixture_id, fixture_status, updated_at,
        CASE WHEN updated_at <= m AND NOT (updated_at >= m - INTERVAL 1 DAY AND api_fixture_id % 2 = 1) THEN 1
             WHEN updated_at < TIMESTAMP '2000-06-30 00:00:00' THEN 2 ELSE 3 END AS run FROM raw, edge"""
ORACLES["changed_ids_by_digest"] = ORACLES["changed_ids"]
ORACLES["intake_new_files"] = f"SELECT {flat_list} FROM raw WHERE season >= 1996"
ORACLES["served_by_type"] = ORACLES["list_streaks"]
ORACLES["served_second_page"] = f"{ORACLES['list_streaks']} ORDER BY current_streak_length DESC, team_name, streak_id LIMIT 5 OFFSET 5"
merged_list = f"""SELECT {flat_list} FROM upd UNION ALL
    SELECT {flat_list} FROM raw WHERE api_fixture_id NOT IN (SELECT api_fixture_id FROM upd)"""
ORACLES["persist_merged_snapshot"] = merged_list


def all_sql() -> dict[str, str]:
    out = {}
    for name, body in ORACLES.items():
        text = sql(body)
        # A body with its own WITH continues the list of CTEs.
        if body.strip().startswith("WITH ") and text.startswith("WITH ") and not text.startswith(body.strip()[:20]):
            head, own = text[: -len(body.strip())].rstrip(), body.strip()[len("WITH ") :]
            text = f"{head}, {own}"
        out[name] = text
    return out
