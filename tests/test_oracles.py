"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.oracles import all_sql
from checks.queries import QUERIES
from checks.verify import compare, connect

TEXTS = all_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(TEXTS) == set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["streak_id", "league_name", "team_name", "event_name", "streak_type", "current_streak_length"]
    lengths = [r.current_streak_length for r in df.collect()]
    assert len(lengths) == 18 and lengths == sorted(lengths, reverse=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    verdict = compare(spark, duck, sf, name, TEXTS)
    assert verdict.startswith("ok") and "types" not in verdict, verdict
