"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streakline import testbed as tb
from streakline.functions.ordered import next_values, number_all, previous_values, row_numbers
from streakline.functions.scalars import as_time, run_stamp, season_label, slugify, title_case
from streakline.operators import clean, digests, dims, facts, key_bits, marks, merge, quality, standings, streaks
from streakline.plans import increments, jobs, loads, marts, serving, worklists
from streakline.plans.model_checks import MODEL_CHECKS, checks_of
from streakline.schemas import EVENT_CATALOG, STREAK_TYPES, Event
from streakline.session import scratch_path, stage
from streakline.sources import buckets, fixture_files, ledger, snapshots, tables
from streakline.streaming.updates import late_records, stream_increments, stream_updates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AS_OF = tb.AS_OF
NOW = tb.BATCH_TIME
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


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def iso(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as ISO text."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- Shared inputs ---------------------------------------------------------------------


def seasons(spark, sf):
    return dims.stg_league_seasons(tb.dim_league_seasons(spark, sf), AS_OF)


def context(spark, sf):
    return dims.league_context(
        seasons(spark, sf),
        dims.stg_leagues(tb.dim_leagues(spark, sf)),
        dims.stg_countries(tb.dim_countries(spark, sf)),
    )


def staged_fixtures(spark, sf):
    return clean.stg_fixtures(tb.raw_fixtures(spark, sf))


def enriched(spark, sf):
    return facts.enrich_fixtures(
        staged_fixtures(spark, sf), context(spark, sf), dims.stg_teams(tb.dim_teams(spark, sf))
    )


def team_rows(spark, sf):
    return facts.unpivot_team_rows(enriched(spark, sf))


def event_rows(spark, sf):
    """Event rows that count for streaks, as the generic ordered operators take them."""
    return facts.team_events(clean.current_played_only(team_rows(spark, sf)))


def standings_rows(spark, sf):
    return standings.standings_input(team_rows(spark, sf), context(spark, sf))


def named_fixtures(spark, sf):
    """Flat fixtures with country and league names, as the tree writer takes them."""
    names = (
        tb.dim_leagues(spark, sf)
        .join(tb.dim_countries(spark, sf), "country_id")
        .selectExpr("api_league_id", "country_name as country", "league_name")
    )
    return tb.flat_fixtures(spark, sf).select(*FLAT).join(names, "api_league_id")


def typed(df):
    return clean.parse_kickoff(clean.cast_numeric_columns(df))


# --- A. Sources and sinks ----------------------------------------------------------------


@query
def scan_fixture_tree(spark, sf):
    base = scratch_path(spark, "tree")
    fixture_files.write_fixture_tree(named_fixtures(spark, sf), base)
    return typed(fixture_files.scan_fixture_tree(spark, base, "*.json", multi_line=False)).select(*FLAT)


@query
def scan_update_file(spark, sf):
    path = scratch_path(spark, "updates")
    fixture_files.write_records(tb.updated_fixtures(spark, sf).select(*FLAT), path)
    return typed(fixture_files.scan_update_file(spark, path, multi_line=False)).select(*FLAT)


@query
def scan_status_columns(spark, sf):
    path = scratch_path(spark, "raw")
    tb.raw_fixtures(spark, sf).write.parquet(path)
    return snapshots.scan_status_columns(spark, path)


@query
def scan_by_ids(spark, sf):
    path = scratch_path(spark, "updates")
    tb.updated_fixtures(spark, sf).write.parquet(path)
    ids = merge.changed_ids(tb.raw_fixtures(spark, sf), spark.read.parquet(path))
    return snapshots.scan_by_ids(spark, path, ids).select(*FLAT)


@query
def latest_snapshot(spark, sf):
    root = scratch_path(spark, "snapshots")
    snapshots.write_snapshot(tb.raw_fixtures(spark, sf).select(*FLAT), root, "full", "20000101_000000")
    snapshots.write_snapshot(tb.updated_fixtures(spark, sf).select(*FLAT), root, "full", "20000102_000000")
    return snapshots.latest_snapshot(spark, root, "full")


@query
def write_snapshot(spark, sf):
    root = scratch_path(spark, "snapshots")
    stored = snapshots.write_snapshot(tb.raw_fixtures(spark, sf), root, "update", "20000101_000000")
    return snapshots.read_csv_snapshot(spark, root, "update", stored.schema)


@query
def full_refresh_with_archive(spark, sf):
    root = scratch_path(spark, "refresh")
    tb.raw_fixtures(spark, sf).select(*FLAT).write.parquet(f"{root}/first")
    tb.updated_fixtures(spark, sf).select(*FLAT).write.parquet(f"{root}/second")
    snapshots.full_refresh(spark, f"{root}/first", f"{root}/table", "20000101_000000")
    now = snapshots.full_refresh(spark, f"{root}/second", f"{root}/table", "20000102_000000")
    before = snapshots.archived(spark, f"{root}/table")
    return now.withColumn("version", F.lit("current")).unionByName(
        before.withColumn("version", F.lit("archive"))
    )


@query
def flatten_payload(spark, sf):
    return clean.flatten_payload(tb.payloads(spark, sf))


@query
def write_fixture_tree(spark, sf):
    base = scratch_path(spark, "tree")
    rows = named_fixtures(spark, sf)
    fixture_files.write_fixture_tree(rows.where("season < 2000"), base)
    fixture_files.write_fixture_tree(rows.withColumn("fixture_status", F.lit("again")), base, overwrite=False)
    stored = spark.read.schema("fixture_status string, country_slug string, league_slug string, season int").json(base)
    return stored.groupBy("country_slug", "league_slug", "season").agg(
        F.count(F.lit(1)).alias("fixtures"), F.count_if(F.col("fixture_status") == "again").alias("written_again")
    )


@query
def write_json_records(spark, sf):
    path = scratch_path(spark, "payloads")
    fixture_files.write_records(tb.payloads(spark, sf), path)
    return clean.flatten_payload(fixture_files.read_payloads(spark, path))


@query
def source_table(spark, sf):
    root = scratch_path(spark, "warehouse")
    snapshots.write_version(
        tb.raw_fixtures(spark, sf), tables.source_path(root, "raw.raw_fixtures"), "20000101_000000"
    )
    return tables.source_table(spark, root, "raw.raw_fixtures")


@query
def materialize_incremental(spark, sf):
    root = scratch_path(spark, "warehouse")
    rows = staged_fixtures(spark, sf).drop("created_at")
    early = rows.where("updated_at < timestamp_ntz '2000-01-01 00:00:00'")
    keep = ("incremental", "stg/fixtures", root)
    tables.materialize(early, *keep, "20000101_000000", merge.FIXTURE_KEY, "updated_at")
    return tables.materialize(rows, *keep, "20000102_000000", merge.FIXTURE_KEY, "updated_at")


@query
def materialize_buckets(spark, sf):
    root = scratch_path(spark, "warehouse")
    rows = staged_fixtures(spark, sf).drop("created_at")
    early = rows.where("updated_at < timestamp_ntz '2000-01-01 00:00:00'")
    keep = ("buckets", "stg/fixtures", root)
    tables.materialize(early, *keep, "20000101_000000", merge.FIXTURE_KEY, "updated_at")
    return tables.materialize(rows, *keep, "20000102_000000", merge.FIXTURE_KEY, "updated_at")


@query
def materialize_view(spark, sf):
    return tables.materialize(facts.team_events(team_rows(spark, sf)), "view", "fact_team_events")


@query
def flatten_metadata_countries(spark, sf):
    return dims.flatten_countries(tb.metadata_tree(spark, sf))


@query
def flatten_metadata_leagues(spark, sf):
    return dims.flatten_leagues(tb.metadata_tree(spark, sf))


@query
def flatten_metadata_seasons(spark, sf):
    return iso(dims.flatten_seasons(tb.metadata_tree(spark, sf)), "start_date", "end_date")


@query
def flatten_metadata_teams(spark, sf):
    return dims.flatten_teams(tb.metadata_tree(spark, sf))


@query
def flatten_team_payload(spark, sf):
    supplier = tb.table(spark, sf, "supplier")
    team = "if(s_acctbal >= 0, named_struct('id', s_suppkey, 'name', s_name, 'code', cast(s_nationkey as string)), null)"
    return dims.flatten_team_payload(supplier.selectExpr(f"{team} as team"))


# --- B. Projections, filters, predicates ---------------------------------------------------


@query
def stg_countries(spark, sf):
    return dims.stg_countries(tb.dim_countries(spark, sf))


@query
def stg_leagues(spark, sf):
    return dims.stg_leagues(tb.dim_leagues(spark, sf))


@query
def stg_teams(spark, sf):
    return dims.stg_teams(tb.dim_teams(spark, sf))


@query
def stg_league_seasons(spark, sf):
    return iso(seasons(spark, sf), "start_date", "end_date")


@query
def stg_fixtures(spark, sf):
    return staged_fixtures(spark, sf)


@query
def validate_schema(spark, sf):
    return clean.validate_schema(tb.flat_fixtures(spark, sf)).select(*FLAT)


@query
def validate_payload(spark, sf):
    checked = clean.validate_payload(tb.payloads(spark, sf))
    return checked.select(
        F.col("score.fulltime.home").alias("home_goals"),
        F.col("teams.home.id").alias("home_team_id"),
        F.col("teams.away.id").alias("away_team_id"),
        F.array_join("missing", ",").alias("missing"),
    )


@query
def stg_completed_fixtures(spark, sf):
    return clean.stg_completed_fixtures(tb.completed_fixtures_v1(spark, sf))


def goal_texts(spark, sf):
    """Fixture numbers as a feed may spell them: plain, with a point, with a fraction, not at all."""
    k = "api_fixture_id"
    return tb.flat_fixtures(spark, sf).selectExpr(
        f"concat(' ', cast({k} as string)) as {k}",
        "cast(api_league_id as string) as api_league_id",
        f"if({k} % 11 = 0, 'unknown', cast(season as string)) as season",
        "concat(cast(home_team_id as string), '.0') as home_team_id",
        "away_team_id",
        f"""case when {k} % 5 = 0 then concat(home_team_fulltime_goal, '.0')
                 when {k} % 5 = 1 then concat(home_team_fulltime_goal, '.5')
                 else cast(home_team_fulltime_goal as string) end as home_team_fulltime_goal""",
        "cast(away_team_fulltime_goal as double) as away_team_fulltime_goal",
    )


@query
def cast_numeric_columns(spark, sf):
    return clean.cast_numeric_columns(goal_texts(spark, sf))


@query
def fractional_values(spark, sf):
    return clean.fractional_values(goal_texts(spark, sf)).select(
        F.trim("api_fixture_id").cast("bigint").alias("api_fixture_id"), "home_team_fulltime_goal"
    )


@query
def normalize_status(spark, sf):
    return clean.normalize_status(tb.flat_fixtures(spark, sf)).select(
        "api_fixture_id", "fixture_status", "status_upper"
    )


RESULTS = ["home_fulltime_result", "away_fulltime_result", "home_halftime_result", "away_halftime_result"]


@query
def special_results(spark, sf):
    return clean.special_results(tb.flat_fixtures(spark, sf)).select("api_fixture_id", *RESULTS)


@query
def game_results(spark, sf):
    return clean.game_results(tb.flat_fixtures(spark, sf)).select("api_fixture_id", *RESULTS)


@query
def compute_results(spark, sf):
    return clean.compute_results(tb.flat_fixtures(spark, sf)).select("api_fixture_id", *RESULTS)


@query
def upcoming_fixtures(spark, sf):
    return clean.upcoming_fixtures(tb.raw_fixtures(spark, sf)).select("api_fixture_id", "fixture_status")


@query
def season_rows(spark, sf):
    """Order years as season texts: usable, too old (before 1999 here) and unusable ones."""
    orders = tb.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "if(o_orderstatus = 'P', 'soon', cast(year(o_orderdate) as string)) as year",
        "cast(cast(o_orderdate as date) as string) as start",
        "cast(null as string) as end",
    )
    return iso(dims.season_rows(orders, min_season=1999), "start_date", "end_date")


@query
def valid_teams(spark, sf):
    return dims.valid_teams(
        tb.table(spark, sf, "supplier").selectExpr(
            "s_suppkey as id", "case when s_nationkey = 3 then '' when s_nationkey <> 4 then s_name end as name"
        )
    )


@query
def played_only(spark, sf):
    return clean.played_only(team_rows(spark, sf)).select("fixture_id", "team_id")


@query
def current_played_only(spark, sf):
    return clean.current_played_only(team_rows(spark, sf)).select("fixture_id", "team_id")


@query
def stale_predicate(spark, sf):
    return tb.raw_fixtures(spark, sf).where(worklists.is_stale(AS_OF)).select("api_fixture_id", "kickoff_utc")


@query
def dim_teams(spark, sf):
    shouted = tb.dim_teams(spark, sf).withColumn("team_name", F.upper("team_name"))
    return dims.int_teams(dims.stg_teams(shouted))


@query
def bootstrap_worklist(spark, sf):
    return worklists.bootstrap_worklist(
        tb.dim_league_seasons(spark, sf), tb.dim_leagues(spark, sf), tb.dim_countries(spark, sf)
    )


# --- C. Joins and lateral expansion -----------------------------------------------------------


@query
def league_context(spark, sf):
    return context(spark, sf)


@query
def enrich_fixtures(spark, sf):
    return enriched(spark, sf)


@query
def diff_join(spark, sf):
    return merge.diff_join(tb.raw_fixtures(spark, sf), tb.updated_fixtures(spark, sf))


@query
def stale_fixture_ids(spark, sf):
    return worklists.stale_fixture_ids(
        staged_fixtures(spark, sf), dims.stg_leagues(tb.dim_leagues(spark, sf)), seasons(spark, sf), AS_OF
    )


@query
def refresh_windows(spark, sf):
    windows = worklists.refresh_windows(
        staged_fixtures(spark, sf), dims.stg_leagues(tb.dim_leagues(spark, sf)), seasons(spark, sf), AS_OF
    )
    return iso(windows, "from_date")


@query
def season_catalog(spark, sf):
    return worklists.season_catalog(
        tb.dim_league_seasons(spark, sf), tb.dim_leagues(spark, sf), tb.dim_countries(spark, sf)
    )


@query
def unpivot_team_rows(spark, sf):
    return team_rows(spark, sf)


@query
def fact_team_fixtures(spark, sf):
    return facts.team_fixtures(enriched(spark, sf)).drop("updated_at")


@query
def fact_team_events(spark, sf):
    return facts.team_events(team_rows(spark, sf))


@query
def update_join(spark, sf):
    """Keyed update of kickoffs only; everything else stays."""
    base = tb.raw_fixtures(spark, sf)
    moved = tb.updated_fixtures(spark, sf).select("api_fixture_id", "kickoff_utc")
    return merge.coalesce_update(base, moved, now=NOW).select("api_fixture_id", "kickoff_utc", "updated_at")


@query
def missing_leagues(spark, sf):
    """Leagues asked for per customer nation and region that have no supplier-side catalog entry."""
    region, nation = tb.table(spark, sf, "region"), tb.table(spark, sf, "nation")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    pairs = lambda side, key: side.join(named, F.col(key) == F.col("n_nationkey")).selectExpr(
        "r_name as country", "n_name as league"
    )
    requested = pairs(tb.table(spark, sf, "customer"), "c_nationkey")
    catalog = pairs(tb.table(spark, sf, "supplier").where("s_acctbal > 5000"), "s_nationkey")
    return dims.missing_from_catalog(requested, catalog)


@query
def missing_leagues_in_tree(spark, sf):
    return dims.missing_leagues(tb.metadata_tree(spark, sf))


@query
def orphan_check(spark, sf):
    """Home teams of fixtures that a shortened team table lacks, with the rows concerned."""
    parents = tb.dim_teams(spark, sf).where("country_id <> 2")
    return quality.relationship_failures(enriched(spark, sf), "home_team_id", parents, "team_id")


@query
def only_known_ids(spark, sf):
    upcoming = clean.upcoming_fixtures(tb.raw_fixtures(spark, sf)).select("api_fixture_id")
    return merge.only_known_ids(tb.updated_fixtures(spark, sf), upcoming).select("api_fixture_id", "fixture_status")


# --- D. Aggregations --------------------------------------------------------------------------------


@query
def group_min(spark, sf):
    return worklists.first_kickoffs(tb.raw_fixtures(spark, sf))


@query
def distinct_ids(spark, sf):
    return worklists.fixture_ids(team_rows(spark, sf))


@query
def high_water_mark(spark, sf):
    rows = tb.raw_fixtures(spark, sf)
    early = rows.where("updated_at < timestamp_ntz '2000-01-01 00:00:00'")
    return merge.rows_after(rows, early).select("api_fixture_id", "updated_at")


@query
def keep_last_per_key(spark, sf):
    """Each supplier's last line: by ship date, then order and line."""
    lines = tb.table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag")
    return merge.keep_last_per_key([lines], ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])


@query
def count_missing(spark, sf):
    return clean.step_counts(tb.raw_fixtures(spark, sf))


@query
def change_counts(spark, sf):
    return merge.change_counts(tb.raw_fixtures(spark, sf), tb.updated_fixtures(spark, sf))


# --- E. Window functions -----------------------------------------------------------------------------


@query
def next_fixture(spark, sf):
    return facts.next_fixture(team_rows(spark, sf)).select(
        "fixture_id", "team_id", "next_opponent_id", "next_kickoff_utc"
    )


@query
def next_event(spark, sf):
    """The generic look-ahead on the event stream: each user's next event."""
    return next_values(
        tb.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"),
        ["user_id"],
        ["ts", "event_id"],
        {"next_type": "event_type", "next_ts": "ts"},
    )


T_E = ["team_id", "event_name"]


@query
def number_rows(spark, sf):
    rows = event_rows(spark, sf).select(*T_E, "kickoff_utc", "fixture_id", "event_flag")
    return row_numbers(rows, T_E, ["kickoff_utc", "fixture_id"], "rn")


@query
def previous_flag(spark, sf):
    """Every flag's predecessor, 0 where no row precedes."""
    rows = clean.current_played_only(team_rows(spark, sf)).withColumns(facts.event_flags())
    names = [e.name for e in EVENT_CATALOG]
    lagged = previous_values(
        rows, facts.TEAM_KEY, facts.FIXTURE_ORDER, {f"{n}_before": n for n in names}, default=0
    )
    return facts.stack_events(lagged, ["team_id", "fixture_id"], {"event_flag": "{}", "prev_flag": "{}_before"})


def numbered_streaks(spark, sf):
    return streaks.team_run_lengths(team_rows(spark, sf), with_ids=True)


@query
def streak_id(spark, sf):
    return facts.stack_events(
        numbered_streaks(spark, sf), ["team_id", "fixture_id"], {"event_flag": "{}", "streak_id": "{}_run"}
    )


@query
def streak_length(spark, sf):
    return facts.stack_events(
        numbered_streaks(spark, sf), ["team_id", "fixture_id"], {"event_flag": "{}", "streak_length": "{}_length"}
    )


@query
def fact_team_streaks(spark, sf):
    return streaks.team_streaks(team_rows(spark, sf))


@query
def run_length_streaks(spark, sf):
    """The generic operator on the event stream: runs of errors and of high values per user."""
    rows = tb.table(spark, sf, "events").selectExpr("event_id", "user_id", "ts", "event_type", "value")
    flags = {"is_error": F.expr("cast(event_type = 'error' as int)"), "is_high": F.expr("cast(value > 10 as int)")}
    return streaks.run_lengths(rows, ["user_id"], ["ts", "event_id"], flags, with_ids=True)


@query
def run_length_chunked(spark, sf):
    """The same through the path for keys too long for one task."""
    rows = tb.table(spark, sf, "events").selectExpr("event_id", "user_id", "ts", "event_type", "value")
    flags = {"is_error": F.expr("cast(event_type = 'error' as int)"), "is_high": F.expr("cast(value > 10 as int)")}
    return streaks.run_lengths(rows, ["user_id"], ["ts", "event_id"], flags, with_ids=True, chunk_rows=1_000, hot=True)


@query
def null_resets_streaks(spark, sf):
    return streaks.team_streaks(team_rows(spark, sf), null_resets=True)


@query
def latest_row(spark, sf):
    rows = streaks.team_streaks(team_rows(spark, sf))
    return streaks.latest_per_key(
        rows, T_E, ["kickoff_utc", "fixture_id"], ["kickoff_utc", "fixture_id", "event_flag", "streak_length"]
    )


@query
def display_id(spark, sf):
    lengths = marts.longer_than(streaks.current_streaks(team_rows(spark, sf)))
    return marts.display_ids(lengths)


@query
def running_counts(spark, sf):
    totals = standings.running_totals(stage(standings_rows(spark, sf)))
    return totals.select("fixture_id", "team_id", "games_played", "wins", "losses", "draws")


@query
def running_goals(spark, sf):
    totals = standings.running_totals(stage(standings_rows(spark, sf)))
    return totals.select("fixture_id", "team_id", "goals_for", "goals_against")


@query
def rolling_rates(spark, sf):
    table = standings.team_running_table(standings_rows(spark, sf))
    return table.select("fixture_id", "team_id", "rolling_win_rate", "rolling_loss_rate", "rolling_draw_rate")


@query
def rolling_averages(spark, sf):
    table = standings.team_running_table(standings_rows(spark, sf))
    return table.select("fixture_id", "team_id", "rolling_avg_goals_for", "rolling_avg_goals_against")


@query
def rolling_points(spark, sf):
    totals = standings.running_totals(stage(standings_rows(spark, sf)))
    return totals.select("fixture_id", "team_id", "rolling_points")


@query
def tie_breaker(spark, sf):
    totals = standings.running_totals(stage(standings_rows(spark, sf)))
    return standings.tie_breaker(standings.rates(totals)).selectExpr(
        "fixture_id", "team_id", "_aggregator / 100.0D as aggregator"
    )


@query
def matchday_numbers(spark, sf):
    return standings.matchdays(standings_rows(spark, sf)).select("fixture_id", "team_id", "matchday")


@query
def league_position(spark, sf):
    table = standings.team_running_table(standings_rows(spark, sf))
    return table.select("fixture_id", "team_id", "matchday", "position")


@query
def team_running_table(spark, sf):
    return iso(standings.team_running_table(standings_rows(spark, sf)), "date")


@query
def team_running_table_cut(spark, sf):
    """The same with seasons cut into small chunks, as over-long ones are."""
    return iso(standings.team_running_table(standings_rows(spark, sf), chunk_rows=20), "date")


@query
def team_running_table_completed(spark, sf):
    """The running table from the older layout of finished matches."""
    rows = standings.completed_input(clean.stg_completed_fixtures(tb.completed_fixtures_v1(spark, sf)))
    return iso(standings.team_running_table(rows), "date")


# --- F. Sorts, limits, top-k; G. set operations ----------------------------------------------------------


@query
def rank_current_streaks(spark, sf):
    """The ranked rows with their places in the sorted result, so that their order is compared too."""
    at = F.monotonically_increasing_id()
    ranked = stage(marts.top_team_streaks(team_rows(spark, sf)).withColumns({"part": F.spark_partition_id(), "at": at}))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sorted partition.
    parts = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    offsets = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    place = (F.col("before") + F.col("at") - F.col("first") + 1).alias("place")
    return ranked.join(offsets, "part").select(*marts.MART_COLUMNS, place)


@query
def min_length_filter(spark, sf):
    return marts.longer_than(streaks.current_streaks(team_rows(spark, sf)), 4)


@query
def top_one_per_group(spark, sf):
    """Each customer's latest order."""
    orders = tb.table(spark, sf, "orders")
    return streaks.latest_per_key(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate", "o_orderstatus"]
    )


@query
def page_batches(spark, sf):
    return worklists.batch_ids(tb.raw_fixtures(spark, sf), "api_fixture_id")


@query
def number_all_rows(spark, sf):
    """Global numbering, here cut into chunks as for a very large table."""
    orders = tb.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return number_all(orders, ["o_orderdate", "o_orderkey"], "nr", chunk_rows=1_000)


@query
def concat_frames(spark, sf):
    return merge.concat_frames(
        tb.raw_fixtures(spark, sf).select("api_fixture_id", "fixture_status", "updated_at"),
        tb.updated_fixtures(spark, sf).select("api_fixture_id", "fixture_status", "kickoff_utc"),
    )


@query
def union_ids(spark, sf):
    flags = merge.flag_changes(tb.raw_fixtures(spark, sf), tb.updated_fixtures(spark, sf))
    return merge.union_ids(
        flags.where("now_played").select("api_fixture_id"), flags.where("rescheduled").select("api_fixture_id")
    )


# --- H. Scalar functions, J. event catalog -------------------------------------------------------------------


@query
def scalar_functions(spark, sf):
    orders = tb.table(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        slugify(F.concat_ws(" & ", "o_orderpriority", F.lit("São Café"), "o_orderstatus")).alias("slug"),
        title_case(F.concat(F.lower("o_orderpriority"), F.lit(" saint-étienne fc"))).alias("title"),
        season_label(F.year("o_orderdate")).alias("label"),
        run_stamp(F.col("o_orderdate")).alias("stamp"),
        F.to_date("o_orderdate").cast("string").alias("day"),
        (F.col("o_orderdate") - F.expr("INTERVAL 2 HOURS")).alias("two_hours_before"),
    )


@query
def custom_event_catalog(spark, sf):
    """Streaks of events a user of the library adds."""
    catalog = [
        Event("narrow_win", "fulltime_result = 'win' and goals_for - goals_against = 1", "result_streaks"),
        Event("away_goal", "not is_home and goals_for > 0", "goal_streaks"),
    ]
    return streaks.current_streaks(team_rows(spark, sf), catalog)


# --- I. Streaming --------------------------------------------------------------------------------------------------


@query
def stream_update_files(spark, sf):
    root = scratch_path(spark, "stream")
    base = tb.raw_fixtures(spark, sf)
    snapshots.write_version(base, f"{root}/table", "20000101_000000")
    fixture_files.write_records(tb.updated_fixtures(spark, sf).select(*FLAT), f"{root}/incoming")
    stream_updates(spark, f"{root}/incoming", f"{root}/table", f"{root}/progress", NOW).awaitTermination()
    return snapshots.read_version(spark, f"{root}/table")


# --- K. Upserts and change detection ----------------------------------------------------------------------------------


@query
def insert_or_ignore(spark, sf):
    """Countries so far: regions of well-off suppliers' nations; arriving: all regions and nations by name."""
    known = tb.dim_countries(spark, sf).where("country_id < 3")
    arriving = tb.table(spark, sf, "region").selectExpr("r_name as country_name").union(
        tb.table(spark, sf, "nation").select("n_name")
    )
    return merge.insert_or_ignore(known, arriving, ["country_name"], "country_id")


def team_feed(spark, sf):
    """Teams as a new feed has them: some renamed, some without a code, and clubs not seen before."""
    known = tb.dim_teams(spark, sf).join(
        tb.table(spark, sf, "supplier").selectExpr("s_suppkey as team_id", "s_acctbal"), "team_id"
    )
    nation = tb.table(spark, sf, "nation")
    clubs = tb.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return known.selectExpr(
        "api_team_id",
        "if(s_acctbal < 0, concat(team_name, ' FC'), team_name) as team_name",
        "case when s_acctbal > 9000 then null when s_acctbal > 8000 then 'NEW' else team_code end as team_code",
        "country_id",
    ).unionByName(
        clubs.selectExpr(
            "1000000000 + c_custkey as api_team_id",
            "c_name as team_name",
            "cast(null as string) as team_code",
            "cast(n_regionkey as bigint) as country_id",
        )
    )


def stamped_teams(spark, sf):
    return tb.dim_teams(spark, sf).withColumns(
        {"created_at": as_time(AS_OF), "updated_at": as_time(AS_OF)}
    )


TRACKED = ["team_name", "team_code", "country_id"]


@query
def upsert_teams(spark, sf):
    return merge.conditional_upsert(
        stamped_teams(spark, sf), team_feed(spark, sf), ["api_team_id"], "team_id", TRACKED, now=NOW
    )


@query
def upsert_teams_null_safe(spark, sf):
    return merge.conditional_upsert(
        stamped_teams(spark, sf), team_feed(spark, sf), ["api_team_id"], "team_id", TRACKED, now=NOW, null_safe=True
    )


@query
def upsert_leagues(spark, sf):
    """Leagues so far: those of three regions, under lower-case names."""
    leagues = tb.dim_leagues(spark, sf)
    known = leagues.where("country_id < 3").withColumns(
        {
            "league_name": F.when(F.col("league_id") > 10, F.lower("league_name")).otherwise(F.col("league_name")),
            "created_at": as_time(AS_OF),
            "updated_at": as_time(AS_OF),
        }
    )
    return merge.conditional_upsert(
        known, leagues.drop("league_id"), ["api_league_id"], "league_id", ["league_name", "country_id"], now=NOW
    )


@query
def upsert_league_seasons(spark, sf):
    """Seasons so far: before 2001, some without an end date; ``updated_at`` is left alone."""
    every = tb.dim_league_seasons(spark, sf).drop("fixtures_bootstrap_done")
    known = every.where("season < 2001").withColumns(
        {
            "start_date": F.when(F.col("season") == 1999, F.date_add("start_date", 30)).otherwise(F.col("start_date")),
            "end_date": F.when(F.col("season") != 1998, F.col("end_date")),
            "updated_at": as_time(AS_OF),
        }
    )
    merged = merge.conditional_upsert(
        known,
        every.drop("league_season_id"),
        ["league_id", "season"],
        "league_season_id",
        ["season_label", "start_date", "end_date"],
        touch=False,
        now=NOW,
    )
    return iso(merged, "start_date", "end_date")


@query
def coalesce_update(spark, sf):
    return merge.coalesce_update(tb.raw_fixtures(spark, sf), tb.updated_fixtures(spark, sf), now=NOW)


@query
def changed_ids(spark, sf):
    return merge.changed_ids(tb.raw_fixtures(spark, sf), tb.updated_fixtures(spark, sf))


@query
def incremental_append(spark, sf):
    """The target ends at mid-2000; later source rows come in, and only those."""
    rows = staged_fixtures(spark, sf)
    target = rows.where("updated_at < timestamp_ntz '2000-06-30 00:00:00'")
    source = rows.withColumn("fixture_status", F.lower("fixture_status"))
    return merge.incremental_append(target, source, merge.FIXTURE_KEY).select(
        "api_fixture_id", "fixture_status", "updated_at"
    )


@query
def replace_by_key(spark, sf):
    return merge.replace_by_key(
        tb.raw_fixtures(spark, sf).select(*FLAT), tb.updated_fixtures(spark, sf).select(*FLAT), merge.FIXTURE_KEY
    )


@query
def persist_merged_snapshot(spark, sf):
    root = scratch_path(spark, "snapshots")
    merged = merge.keep_last_per_key(
        [tb.raw_fixtures(spark, sf).select(*FLAT), tb.updated_fixtures(spark, sf).select(*FLAT)], merge.FIXTURE_KEY
    )
    return snapshots.write_snapshot(merged, root, "full", "20000101_000000")


@query
def mark_bootstrap_done(spark, sf):
    """League-seasons that have fixtures are marked."""
    done = enriched(spark, sf).select("league_season_id")
    marked = merge.mark_bootstrap_done(tb.dim_league_seasons(spark, sf), done, NOW)
    return marked.selectExpr(
        "league_season_id", "fixtures_bootstrap_done", "cast(fixtures_bootstrap_at as timestamp_ntz) as fixtures_bootstrap_at"
    )


def warehouse(spark, sf, root):
    """A warehouse with dimensions and one full load."""
    for name, df in {
        "etl.dim_countries": tb.dim_countries(spark, sf),
        "etl.dim_leagues": tb.dim_leagues(spark, sf),
        "etl.dim_league_seasons": tb.dim_league_seasons(spark, sf),
        "etl.dim_teams": tb.dim_teams(spark, sf),
    }.items():
        snapshots.write_version(df, tables.source_path(root, name), "20000101_000000")
    jobs.transform_job(tb.flat_fixtures(spark, sf).select(*FLAT), root, "full", "20000101_000000")
    jobs.load_raw(spark, root, "20000101_000000", datetime(2001, 1, 1))


@query
def apply_played_updates(spark, sf):
    root = scratch_path(spark, "warehouse")
    warehouse(spark, sf, root)
    jobs.transform_job(tb.updated_fixtures(spark, sf).select(*FLAT), root, "update", "20000102_000000")
    jobs.apply_played_updates(spark, root, "20000103_000000", NOW)
    return tables.source_table(spark, root, jobs.RAW).drop("fixture_id", "created_at")


# --- Incremental models: what a feed touches ---------------------------------------------------------------------


@query
def update_touched_buckets(spark, sf):
    """``coalesce_update`` on a table in buckets, in two feeds that touch some of them each."""
    root = scratch_path(spark, "buckets")
    buckets.write_buckets(tb.raw_fixtures(spark, sf), root, merge.FIXTURE_KEY, "20000101_000000", 64)
    update = lambda old, new: merge.coalesce_update(old, new, now=NOW)
    feed = tb.updated_fixtures(spark, sf).withColumn("_bucket", buckets.bucket_of(merge.FIXTURE_KEY, 64))
    for nth, some in enumerate(("_bucket < 20", "_bucket >= 20")):
        buckets.update_buckets(stage(feed.where(some).drop("_bucket")), root, f"2000010{2 + nth}_000000", update)
    return buckets.read_buckets(spark, root)


@query
def replace_touched_buckets(spark, sf):
    """``replace_by_key`` on a table in buckets."""
    root = scratch_path(spark, "buckets")
    buckets.write_buckets(tb.raw_fixtures(spark, sf).select(*FLAT), root, merge.FIXTURE_KEY, "20000101_000000", 64)
    feed = stage(tb.updated_fixtures(spark, sf).select(*FLAT))
    replace = lambda old, new: merge.replace_by_key(old, new, merge.FIXTURE_KEY)
    return buckets.update_buckets(feed, root, "20000102_000000", replace).read(spark)


#: The fixtures in three feeds: the second brings later ones, the third backdated ones.
FEEDS = [
    "fixture_id % 11 <> 5 and kickoff_utc < timestamp_ntz '2000-03-01 00:00:00'",
    "fixture_id % 11 <> 5 and kickoff_utc >= timestamp_ntz '2000-03-01 00:00:00'",
    "fixture_id % 11 = 5",
]


def in_three_feeds(spark, sf) -> str:
    root = scratch_path(spark, "increments")
    fixtures = stage(enriched(spark, sf))
    first, *others = [fixtures.where(some) for some in FEEDS]
    increments.start(first, root, "20000101_000000", 64)
    for nth, feed in enumerate(others):
        increments.apply(feed, root, f"2000010{2 + nth}_000000")
    return root


@query
def incremental_streaks(spark, sf):
    """The streak fact, grown feed by feed from saved state."""
    return increments.team_streaks(spark, in_three_feeds(spark, sf))


@query
def incremental_current_streaks(spark, sf):
    """The latest streaks from the states alone."""
    return increments.current_streaks(spark, in_three_feeds(spark, sf))


@query
def repaired_next_fixtures(spark, sf):
    """The team-row fact, its next fixtures repaired where a feed changed a neighbour."""
    return increments.team_fixtures(spark, in_three_feeds(spark, sf)).drop("updated_at")


def updated_increments(spark, sf) -> str:
    root = scratch_path(spark, "warehouse")
    warehouse(spark, sf, root)
    increments.start_job(spark, root, "20000102_000000", AS_OF, 64)
    increments.update_job(spark, tb.updated_fixtures(spark, sf).select(*FLAT), root, "20000103_000000", AS_OF, NOW)
    return root


@query
def incremental_update_job(spark, sf):
    """Daily updates to the mart without a rebuild."""
    return snapshots.read_version(spark, f"{updated_increments(spark, sf)}/{increments.MART}")


@query
def incremental_update_streaks(spark, sf):
    """The streak fact after the daily update: corrected, moved and newly played matches."""
    return increments.team_streaks(spark, updated_increments(spark, sf))


def streamed_increments(spark, sf, keep_late: bool = False) -> str:
    """Records in the wrong order: new ones first, then, for some fixtures, the old ones again."""
    root = scratch_path(spark, "warehouse")
    warehouse(spark, sf, root)
    increments.start_job(spark, root, "20000102_000000", AS_OF, 64)
    new, old = tb.updated_fixtures(spark, sf).select(*FLAT), tb.flat_fixtures(spark, sf).select(*FLAT)
    records = new.where("api_fixture_id % 2 = 0").unionByName(old.where("api_fixture_id % 2 = 1"))
    for part in (records, new.where("api_fixture_id % 2 = 1").unionByName(old.where("api_fixture_id % 2 = 0"))):
        fixture_files.write_records(part, f"{root}/incoming", mode="append", compression="gzip")
        stream_increments(
            spark, f"{root}/incoming", root, f"{root}/progress", AS_OF, NOW, keep_late=keep_late
        ).awaitTermination()
    return root


@query
def stream_increments_streaks(spark, sf):
    """The streak fact after files have come in as a stream."""
    return increments.team_streaks(spark, streamed_increments(spark, sf))


@query
def stream_late_records(spark, sf):
    """Records that came after better ones, and the raw rows that the same stream left, told apart by ``late``."""
    root = streamed_increments(spark, sf, keep_late=True)
    late = late_records(spark, root).select(*FLAT, F.lit(True).alias("late"))
    return late.unionByName(increments.raw_fixtures(spark, root).select(*FLAT, F.lit(False).alias("late")))


@query
def append_by_mark(spark, sf):
    """Three runs over a growing source; some rows of the first mark's last two days come only after it."""
    source = staged_fixtures(spark, sf).select("api_fixture_id", "fixture_status", "updated_at")
    source = stage(source)
    mark = source.where("updated_at < timestamp_ntz '1999-06-30 00:00:00'").agg(F.max("updated_at")).first()[0]
    late = (F.col("updated_at") >= F.lit(mark) - F.expr("INTERVAL 1 DAY")) & (F.col("api_fixture_id") % 2 == 1)
    runs = [
        source.where((F.col("updated_at") <= F.lit(mark)) & ~late),
        source.where("updated_at < timestamp_ntz '2000-06-30 00:00:00'"),
        source,
        source,
    ]
    taken, listed = source.limit(0).withColumn("run", F.lit(0)), marks.empty_ledger(source, merge.FIXTURE_KEY)
    for nth, seen in enumerate(runs, 1):
        new = stage(marks.not_taken(seen, listed, merge.FIXTURE_KEY))
        listed = stage(marks.grown_ledger(listed, new, merge.FIXTURE_KEY))
        taken = taken.unionByName(new.withColumn("run", F.lit(nth)))
    return taken


@query
def changed_ids_by_digest(spark, sf):
    """Two whole snapshots; leagues and seasons without a change are not joined."""
    base = stage(tb.raw_fixtures(spark, sf).select(*FLAT))
    later = stage(merge.replace_by_key(base, tb.updated_fixtures(spark, sf).select(*FLAT), merge.FIXTURE_KEY))
    return digests.changed_ids_by_digest(base, later)


@query
def intake_new_files(spark, sf):
    """What a second intake reads after more files have come: those and nothing else."""
    root, found = scratch_path(spark, "intake"), []
    records = stage(tb.flat_fixtures(spark, sf).select(*FLAT))
    read = lambda paths: clean.parse_kickoff(clean.cast_numeric_columns(fixture_files.read_lines(spark, paths)))
    for nth, some in enumerate(("season < 1996", "season >= 1996", "false")):
        if nth < 2:
            fixture_files.write_records(records.where(some), f"{root}/incoming", mode="append")
        ledger.intake(spark, f"{root}/incoming", f"{root}/ledger", f"2000010{nth}_000000", read, lambda df: found.append(stage(df)))
    assert len(found) == 2
    return found[1].select(*FLAT)


def served_streaks(spark, sf) -> str:
    root = scratch_path(spark, "served")
    serving.write_served(marts.numbered_streaks(team_rows(spark, sf)), root, "20000101_000000")
    return root


@query
def served_by_type(spark, sf):
    """Each type's streaks from its own partition."""
    root = served_streaks(spark, sf)
    first, *others = [marts.list_streaks(serving.served(spark, root, kind)) for kind in STREAK_TYPES]
    for other in others:
        first = first.unionByName(other)
    return first


@query
def served_second_page(spark, sf):
    """Five rows after the fifth, by key."""
    rows = serving.served(spark, served_streaks(spark, sf))
    last = serving.page(rows, 5).collect()[-1]
    return marts.list_streaks(serving.page(rows, 5, last))


# --- L. Data quality ------------------------------------------------------------------------------------------------------


@query
def check_not_null(spark, sf):
    return quality.not_null_failures(tb.raw_fixtures(spark, sf), "home_fulltime_result").select("api_fixture_id")


@query
def check_unique(spark, sf):
    return quality.unique_failures(tb.table(spark, sf, "lineitem"), "l_orderkey")


@query
def check_relationship(spark, sf):
    parents = context(spark, sf).where("season > 1998")
    return quality.relationship_failures(enriched(spark, sf), "league_season_id", parents, "league_season_id")


@query
def check_unique_by_bitmap(spark, sf):
    """Orders and the orders of seventh lines, stacked: an order with seven lines stands twice."""
    lines = tb.table(spark, sf, "lineitem").where("l_linenumber = 7").select(F.col("l_orderkey").alias("o_orderkey"))
    return key_bits.repeated_keys(tb.table(spark, sf, "orders").select("o_orderkey").unionByName(lines), "o_orderkey")


@query
def check_relationship_by_bitmap(spark, sf):
    parents = tb.table(spark, sf, "orders").where("o_orderstatus <> 'F'")
    return key_bits.orphaned_keys(tb.table(spark, sf, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query
def check_accepted_values(spark, sf):
    return quality.accepted_values_failures(
        tb.raw_fixtures(spark, sf), "fixture_status", ["FT", "NS", "WO", "AWD"]
    ).select("api_fixture_id", "fixture_status")


@query
def quality_report(spark, sf):
    """All declared checks on the models, row-wise ones counted while the models are stored."""
    counted = {}

    def keep(name, df):
        stored, counts = quality.counted_write(df, checks_of(name), stage)
        counted.update(counts)
        return stored

    raw, league = keep("raw_fixtures", tb.raw_fixtures(spark, sf)), keep("int_league_context", context(spark, sf))
    teams = keep("dim_teams", tb.dim_teams(spark, sf))
    fixtures = keep("int_fixtures", facts.enrich_fixtures(clean.stg_fixtures(raw), league, dims.stg_teams(teams)))
    rows = keep("fact_team_fixtures", facts.unpivot_team_rows(fixtures))
    models = {
        "raw_fixtures": raw,
        "int_fixtures": fixtures,
        "int_league_context": league,
        "dim_teams": teams,
        "fact_team_fixtures": rows,
        "int_teams_stats": keep("int_teams_stats", standings.team_running_table(standings.standings_input(rows, league))),
        "mart_top_team_streaks": keep("mart_top_team_streaks", marts.numbered_streaks(rows)),
    }
    return quality.quality_report(models, MODEL_CHECKS, counted)


@query
def quality_report_scanned(spark, sf):
    """The checks of the stored raw table, teams and fixtures without what writes have counted."""
    raw, league, teams = stage(tb.raw_fixtures(spark, sf)), stage(context(spark, sf)), stage(tb.dim_teams(spark, sf))
    fixtures = stage(facts.enrich_fixtures(clean.stg_fixtures(raw), league, dims.stg_teams(teams)))
    models = {"raw_fixtures": raw, "int_league_context": league, "dim_teams": teams, "int_fixtures": fixtures}
    return quality.quality_report(models, [c for c in MODEL_CHECKS if c.table in models])


@query
def quality_report_by_bitmap(spark, sf):
    """The key checks of the raw table, teams and fixtures, whole-number keys through bitmaps."""
    raw, league, teams = stage(tb.raw_fixtures(spark, sf)), stage(context(spark, sf)), stage(tb.dim_teams(spark, sf))
    fixtures = stage(facts.enrich_fixtures(clean.stg_fixtures(raw), league, dims.stg_teams(teams)))
    models = {"raw_fixtures": raw, "int_league_context": league, "dim_teams": teams, "int_fixtures": fixtures}
    checks = [c for c in MODEL_CHECKS if c.table in models and c.kind in ("unique", "relationship")]
    return quality.quality_report(models, checks, bitmaps=True)


# --- M. Marts and jobs ------------------------------------------------------------------------------------------------------


@query
def mart_top_team_streaks(spark, sf):
    return marts.top_team_streaks(team_rows(spark, sf))


@query
def mart_latest_team_streaks(spark, sf):
    return marts.latest_team_streaks(team_rows(spark, sf))


@query
def list_streaks(spark, sf):
    root = scratch_path(spark, "warehouse")
    tables.materialize(marts.numbered_streaks(team_rows(spark, sf)), "table", "mart/mart_top_team_streaks", root, "20000101_000000")
    return marts.list_streaks(jobs.read_mart(spark, root))


def _typed_streaks(kind: str):
    def run(spark, sf):
        """From the stored mart, as a client reads it."""
        root = scratch_path(spark, "warehouse")
        tables.materialize(marts.numbered_streaks(team_rows(spark, sf)), "table", "mart/mart_top_team_streaks", root, "20000101_000000")
        return marts.streaks_by_type(jobs.read_mart(spark, root), kind)

    run.__name__ = f"list_{kind}"
    return query(run)


list_goal_streaks = _typed_streaks("goal_streaks")
list_result_streaks = _typed_streaks("result_streaks")
list_special_streaks = _typed_streaks("special_streaks")


@query
def transform_fixtures_job(spark, sf):
    root = scratch_path(spark, "warehouse")
    path = scratch_path(spark, "records")
    fixture_files.write_records(tb.flat_fixtures(spark, sf).select(*FLAT), path)
    jobs.transform_job(fixture_files.scan_update_file(spark, path, multi_line=False), root, "full", "20000101_000000")
    return snapshots.latest_snapshot(spark, f"{root}/snapshots", "full")


@query
def full_refresh_job(spark, sf):
    root = scratch_path(spark, "warehouse")
    warehouse(spark, sf, root)
    jobs.build_models(spark, root, "20000101_000000", AS_OF)
    return jobs.read_mart(spark, root)


@query
def daily_update_job(spark, sf):
    root = scratch_path(spark, "warehouse")
    warehouse(spark, sf, root)
    jobs.build_models(spark, root, "20000101_000000", AS_OF)
    jobs.daily_update_job(spark, tb.updated_fixtures(spark, sf).select(*FLAT), root, "20000102_000000", AS_OF, NOW)
    return jobs.read_mart(spark, root)


@query
def metadata_load_job(spark, sf):
    """The tree loaded twice, the first time in part: dimensions with ids resolved, seen by natural keys."""
    root, tree = scratch_path(spark, "warehouse"), tb.metadata_tree(spark, sf)
    loads.metadata_load_job(spark, tree.where("country < 'B'"), root, "20000101_000000", AS_OF)
    loads.metadata_load_job(spark, tree, root, "20000102_000000", NOW)
    source = lambda name: tables.source_table(spark, root, name)
    return (
        source("etl.dim_league_seasons")
        .join(source("etl.dim_leagues"), "league_id")
        .join(source("etl.dim_countries"), "country_id")
        .join(source("etl.dim_teams").groupBy("country_id").agg(F.count(F.lit(1)).alias("teams")), "country_id", "left")
        .select("country_name", "league_name", "api_league_id", "season", "season_label", "teams", "fixtures_bootstrap_done")
    )


@query
def bootstrap_job(spark, sf):
    """Payloads to the raw table through the tree, with the seasons still to be loaded at the end."""
    root = scratch_path(spark, "warehouse")
    for name, df in {
        "etl.dim_countries": tb.dim_countries(spark, sf),
        "etl.dim_leagues": tb.dim_leagues(spark, sf),
        "etl.dim_league_seasons": tb.dim_league_seasons(spark, sf).withColumn("fixtures_bootstrap_done", F.col("season") < 1994),
    }.items():
        snapshots.write_version(df, tables.source_path(root, name), "20000101_000000")
    loads.bootstrap_job(spark, tb.payloads(spark, sf), root, "20000102_000000", NOW)
    left = tables.source_table(spark, root, "etl.dim_league_seasons").where("not fixtures_bootstrap_done").count()
    raw = tables.source_table(spark, root, jobs.RAW)
    return raw.select(*FLAT).withColumn("seasons_left", F.lit(left).cast("bigint"))


@query
def blanked_values(spark, sf):
    """Orders as records with prices for goals: what typing would blank."""
    rows = tb.table(spark, sf, "orders").selectExpr(
        "o_orderkey as api_fixture_id", "cast(o_totalprice as string) as home_team_fulltime_goal",
        "if(o_orderkey % 7 = 0, o_orderpriority, '3') as away_team_fulltime_goal",
        "if(o_orderkey % 11 = 0, 'soon', '2024-01-01T00:00:00Z') as kickoff_utc",
    )
    return clean.blanked_values(rows)


@query
def retry_is_harmless(spark, sf):
    """A run, an update and its retry under one stamp, with an empty feed after it: one mart, and the feed as it came."""
    root = scratch_path(spark, "warehouse")
    warehouse(spark, sf, root)
    jobs.build_models(spark, root, "20000101_000000", AS_OF)
    jobs.build_models(spark, root, "20000101_000000", AS_OF)
    feed = tb.updated_fixtures(spark, sf).select(*FLAT)
    for _ in range(2):
        jobs.daily_update_job(spark, feed, root, "20000102_000000", AS_OF, NOW)
    jobs.daily_update_job(spark, feed.limit(0), root, "20000103_000000", AS_OF, NOW)
    kept = snapshots.latest_snapshot(spark, f"{root}/snapshots", "update").count()
    return jobs.read_mart(spark, root).withColumn("feed_rows", F.lit(kept).cast("bigint"))


@query
def update_by_league_season(spark, sf):
    return worklists.league_season_requests(
        staged_fixtures(spark, sf), dims.stg_leagues(tb.dim_leagues(spark, sf)), seasons(spark, sf), AS_OF
    )


@query
def update_by_ids(spark, sf):
    return worklists.id_requests(
        staged_fixtures(spark, sf), dims.stg_leagues(tb.dim_leagues(spark, sf)), seasons(spark, sf), AS_OF
    )
