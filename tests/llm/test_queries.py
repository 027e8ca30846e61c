from __future__ import annotations

import pytest

from checks.verify import compare, connect
from streakline.llm.queries import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, name):
    verdict = compare(spark, connect(sf), sf, name, SQL)
    assert verdict.startswith("ok") and "types" not in verdict, verdict
