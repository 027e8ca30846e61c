"""The physical plans are the ones intended."""

import re

from checks import queries as q
from streakline import testbed as tb
from streakline.operators import facts, merge, standings, streaks
from streakline.plans import worklists


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def team_rows(spark, tmp_path, sf):
    path = str(tmp_path / "rows")
    q.team_rows(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def test_streaks_take_one_shuffle_and_one_sort(spark, sf, tmp_path):
    rows = team_rows(spark, tmp_path, sf)
    text = plan(streaks.current_streaks(rows, hot=False))
    assert len(re.findall(r"Exchange ", text)) == 1
    assert len(re.findall(r"[^a-zA-Z]Sort \[", text)) == 1
    # Filters reach the scan, unused columns are not read, and the shuffle comes before the events.
    assert "EqualTo(is_current,true)" in text and "EqualTo(is_played,true)" in text
    scan = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "opponent_name" not in scan and "halftime_goals_for" not in scan
    assert text.index("Generate inline") < text.index("Exchange ")


def test_inputs_are_worked_out_once(spark, sf, tmp_path):
    """Counting keys, splitting and cutting read stored rows, not the input's plan."""
    source = spark.sparkContext.accumulator(0)
    rows = team_rows(spark, tmp_path, sf)
    total = rows.count()

    def count(batches):
        for b in batches:
            source.add(b.num_rows)
            yield b

    counted = rows.mapInArrow(count, rows.schema)
    streaks.current_streaks(counted, chunk_rows=total // 10).count()
    assert source.value <= total


def test_running_table_has_no_one_task_window(spark, sf, tmp_path):
    path = str(tmp_path / "standings")
    q.standings_rows(spark, sf).write.parquet(path)
    text = plan(standings.team_running_table(spark.read.parquet(path)))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    # By team and season for the totals, by matchday for the positions; nothing is joined back.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2 and "Join" not in text
    assert len(re.findall(r"[^a-zA-Z]Sort \[", text)) == 2


def test_next_fixture_is_pruned_when_unused(spark, sf, tmp_path):
    rows = team_rows(spark, tmp_path, sf)
    text = plan(facts.next_fixture(rows, hot=False).select("fixture_id", "team_id"))
    assert "Window" not in text and "Exchange" not in text


def test_small_dimensions_are_broadcast(spark, sf):
    text = plan(facts.enrich_fixtures(q.staged_fixtures(spark, sf), q.context(spark, sf), tb.dim_teams(spark, sf)))
    assert "SortMergeJoin" not in text


def test_large_dimensions_are_not_hinted(spark, sf, monkeypatch):
    monkeypatch.setattr(facts, "is_small", lambda df: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = facts.enrich_fixtures(q.staged_fixtures(spark, sf), q.context(spark, sf), tb.dim_teams(spark, sf))
        assert plan(df).count("SortMergeJoin") >= 2
        assert df.count() == q.enriched(spark, sf).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_updates_do_not_shuffle_the_table(spark, sf, tmp_path):
    base, few = str(tmp_path / "base"), str(tmp_path / "few")
    tb.raw_fixtures(spark, sf).write.parquet(base)
    tb.updated_fixtures(spark, sf).write.parquet(few)
    table, updates = spark.read.parquet(base), spark.read.parquet(few)
    for df in (merge.coalesce_update(table, updates, now=tb.AS_OF), merge.replace_by_key(table, updates, merge.FIXTURE_KEY)):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_hot_keys_are_cut_and_the_rest_is_not(spark, sf, tmp_path):
    rows = team_rows(spark, tmp_path, sf)
    text = plan(facts.next_fixture(rows, chunk_rows=rows.count() // 10))
    ordinary, cut_rows = text.split("LeftAnti", 1)
    assert "_chunk" in text and "Union" in text
    assert cut_rows.count("_chunk#") > 0
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_stale_filter_reaches_the_scan(spark, sf, tmp_path):
    path = str(tmp_path / "raw")
    tb.raw_fixtures(spark, sf).write.parquet(path)
    text = plan(spark.read.parquet(path).where(worklists.is_stale(tb.AS_OF)).select("api_fixture_id"))
    assert "LessThan(kickoff_utc" in text
    assert "home_team_name" not in text


def test_change_detection_reads_three_columns(spark, sf, tmp_path):
    path = str(tmp_path / "raw")
    tb.raw_fixtures(spark, sf).write.parquet(path)
    base = spark.read.parquet(path)
    text = plan(merge.changed_ids(base, base))
    for scan in re.findall(r"ReadSchema: struct<(.*?)>", text):
        assert scan == "api_fixture_id:bigint,kickoff_utc:timestamp_ntz,fixture_status:string"


def test_no_cartesian_products(spark, sf):
    for name in ("mart_top_team_streaks", "team_running_table", "quality_report", "coalesce_update", "flatten_metadata_teams"):
        assert "CartesianProduct" not in plan(q.QUERIES[name](spark, sf)), name
