"""The driver's tables seen as fixtures, dimensions and nested payloads.

Every expression is plain column arithmetic over whole tables; the mapping is
written down in FIXTURES.md.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streakline.operators.clean import compute_results
from streakline.functions.scalars import season_label

AS_OF = datetime(2000, 6, 30)
BATCH_TIME = datetime(2002, 1, 1)


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; file footers are read for the schema only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def flat_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures before results: one per order with at least two suppliers."""
    sides = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.expr("min(l_suppkey) as low"), F.expr("max(l_suppkey) as high"))
        .where("low <> high")
        .withColumnRenamed("l_orderkey", "k")
    )
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_orderstatus", "o_orderdate")
    supplier = table(spark, sf_dir, "supplier")
    home = supplier.selectExpr("s_suppkey as home", "s_name as home_team_name", "s_nationkey")
    away = supplier.selectExpr("s_suppkey as away", "s_name as away_team_name")
    scored = (
        orders.join(sides, "k")
        .selectExpr(
            "k",
            "o_orderdate",
            "if(k % 2 = 0, low, high) as home",
            "if(k % 2 = 0, high, low) as away",
            """case when o_orderstatus = 'O' then 'NS'
                    when o_orderstatus = 'P' and k % 10 = 0 then 'WO'
                    when o_orderstatus = 'P' and k % 10 = 1 then 'AWD'
                    when o_orderstatus = 'P' and k % 10 = 2 then 'ABD'
                    when k % 89 = 0 then 'ft'
                    else 'FT' end as fixture_status""",
        )
        .selectExpr(
            "*",
            "if(fixture_status = 'NS' or k % 97 = 0, null, cast((k * 7 + home) % 4 as int)) as home_goals",
            "if(fixture_status = 'NS' or k % 97 = 0, null, cast((k * 11 + away) % 4 as int)) as away_goals",
        )
    )
    return (
        scored.join(home, "home")
        .join(away, "away")
        .selectExpr(
            "k as fixture_id",
            "k as api_fixture_id",
            "cast(1000 + s_nationkey as bigint) as api_league_id",
            "year(o_orderdate) as season",
            "timestampadd(MINUTE, cast(k % 1440 as int), o_orderdate) as kickoff_utc",
            "fixture_status",
            "5000 + home as home_team_id",
            "home_team_name",
            "5000 + away as away_team_id",
            "away_team_name",
            "if(fixture_status = 'WO', null, shiftright(home_goals, 1)) as home_team_halftime_goal",
            "if(fixture_status = 'WO', null, shiftright(away_goals, 1)) as away_team_halftime_goal",
            "home_goals as home_team_fulltime_goal",
            "away_goals as away_team_fulltime_goal",
            "o_orderdate as created_at",
            "timestampadd(HOUR, cast(k % 240 as int), o_orderdate) as updated_at",
        )
    )


def raw_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse's raw fixture table, results included."""
    df = compute_results(flat_fixtures(spark, sf_dir))
    tail = ["created_at", "updated_at"]
    return df.select(*[c for c in df.columns if c not in tail], *tail)


def updated_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later feed: every fixture not yet settled (order status O or P).

    Some have now been played, some were moved by a day, the rest are unchanged.
    """
    open_orders = table(spark, sf_dir, "orders").where("o_orderstatus in ('O', 'P')")
    df = flat_fixtures(spark, sf_dir).join(
        open_orders.select(F.col("o_orderkey").alias("fixture_id")), "fixture_id", "left_semi"
    )
    k = F.col("api_fixture_id")
    unplayed = F.col("fixture_status") == "NS"
    now_played = unplayed & (k % 3 == 0)
    moved = unplayed & (k % 7 == 0)
    return compute_results(
        df.withColumns(
            {
                "home_team_fulltime_goal": F.when(now_played, (k % 4).cast("int")).otherwise(
                    F.col("home_team_fulltime_goal")
                ),
                "away_team_fulltime_goal": F.when(now_played, (k % 3).cast("int")).otherwise(
                    F.col("away_team_fulltime_goal")
                ),
                "kickoff_utc": F.when(moved, F.timestamp_add("DAY", F.lit(1), F.col("kickoff_utc"))).otherwise(
                    F.col("kickoff_utc")
                ),
                "fixture_status": F.when(now_played, "FT").otherwise(F.col("fixture_status")),
            }
        )
    ).drop("fixture_id", "created_at", "updated_at")


def completed_fixtures_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older raw layout: one wide row with country and league by name."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    leagues = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        (F.col("n_nationkey") + 1000).cast("bigint").alias("api_league_id"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("league"),
        F.col("n_nationkey").cast("bigint").alias("league_id"),
    )
    return (
        raw_fixtures(spark, sf_dir)
        .join(leagues, "api_league_id")
        .withColumnsRenamed({"kickoff_utc": "match_date", "fixture_status": "match_status"})
        .drop("api_league_id", "api_fixture_id", "created_at", "updated_at")
    )


# --- Dimensions ---------------------------------------------------------------


def dim_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("country_id"), F.col("r_name").alias("country_name")
    )


def dim_leagues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("league_id"),
        F.col("n_name").alias("league_name"),
        (F.col("n_nationkey") + 1000).cast("bigint").alias("api_league_id"),
        F.col("n_regionkey").cast("bigint").alias("country_id"),
    )


def dim_league_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One season per league and calendar year in which any order was placed.

    The list of years is one short value (a scalar subquery), so no join is
    needed and the planner sees that the result is as small as ``nation``.
    """
    years = table(spark, sf_dir, "orders").select(
        F.collect_set(F.year("o_orderdate")).alias("years")
    )
    season = F.col("season")
    return (
        table(spark, sf_dir, "nation")
        .select("n_nationkey", F.explode(years.scalar()).alias("season"))
        .select(
            (F.col("n_nationkey") * 10000 + season).cast("bigint").alias("league_season_id"),
            F.col("n_nationkey").cast("bigint").alias("league_id"),
            season,
            season_label(season).alias("season_label"),
            F.make_date(season, F.lit(1), F.lit(1)).alias("start_date"),
            F.make_date(season, F.lit(12), F.lit(31)).alias("end_date"),
            (season < 2000).alias("fixtures_bootstrap_done"),
        )
    )


def dim_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("team_id"),
        (F.col("s_suppkey") + 5000).alias("api_team_id"),
        F.col("s_name").alias("team_name"),
        F.concat(F.lit("T"), F.col("s_nationkey").cast("string")).alias("team_code"),
        F.col("n_regionkey").cast("bigint").alias("country_id"),
    )


# --- Nested payloads ------------------------------------------------------------


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures as the feed sends them: nested, with status or sections missing at times."""
    k = F.col("api_fixture_id")
    side = lambda s: F.struct(
        F.col(f"{s}_team_id").alias("id"), F.col(f"{s}_team_name").alias("name")
    )
    score = lambda part: F.struct(
        F.col(f"home_team_{part}_goal").alias("home"), F.col(f"away_team_{part}_goal").alias("away")
    )
    status = F.struct(F.when(F.col("fixture_status") != "NS", F.col("fixture_status")).alias("short"))
    return flat_fixtures(spark, sf_dir).select(
        F.when(
            k % 53 != 0,
            F.struct(
                k.alias("id"),
                F.concat(F.replace(F.col("kickoff_utc").cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00")).alias("date"),
                status.alias("status"),
            ),
        ).alias("fixture"),
        F.when(
            k % 59 != 0,
            F.struct(
                F.col("api_league_id").cast("string").alias("id"),
                F.when(k % 61 != 0, F.col("season").cast("string")).alias("season"),
            ),
        ).alias("league"),
        F.struct(side("home").alias("home"), side("away").alias("away")).alias("teams"),
        F.struct(score("halftime").alias("halftime"), score("fulltime").alias("fulltime")).alias("score"),
    )


def metadata_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata tree in fragments: each row is a country holding one league
    and one team, under four seasons (one too old, one without a usable year).

    Fragments keep every row small however many teams a league has.
    """
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    team = F.struct(
        (F.col("s_suppkey") + 5000).alias("id"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).otherwise("").alias("name"),
        F.concat(F.lit("T"), F.col("s_nationkey").cast("string")).alias("code"),
    )
    teams = F.array(F.struct(team.alias("team")), F.struct(F.lit(None).cast(team_type()).alias("team")))
    season = lambda year: F.struct(
        F.lit(year).alias("year"),
        F.lit(f"{year}-08-01" if year.isdigit() else None).cast("string").alias("start"),
        F.lit(f"{int(year) + 1}-05-31" if year.isdigit() else None).cast("string").alias("end"),
        teams.alias("teams"),
    )
    match = lambda shift: F.struct(
        F.struct((F.col("n_nationkey") + shift).cast("bigint").alias("id")).alias("league"),
        F.array(*[season(y) for y in ("2019", "2021", "2022", "later")]).alias("seasons"),
    )
    # A league asked for by name may match twice (the first counts) or not at all.
    matches = F.when(F.col("n_nationkey") != 7, F.array(match(1000), match(2000)))
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("r_name").alias("country"),
            F.array(F.struct(F.col("n_name").alias("name"), matches.alias("matches"))).alias("leagues"),
        )
    )


def team_type() -> str:
    return "struct<id: bigint, name: string, code: string>"
