"""Every query of the library against the same in SQL, over the smallest tables."""

from __future__ import annotations

import pytest

from termsieve.plans import catalogue
from tests.compare import differences


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_agrees_with_sql(spark, tables, name):
    assert differences(spark, catalogue.queries()[name], catalogue.oracle_sql()[name], tables) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_has_rows(spark, tables, name):
    assert catalogue.queries()[name](spark, tables).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_filters_reach_the_scan(spark, tables):
    plan = catalogue.queries()["initial_stats"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type)" in plan and "GreaterThanOrEqual(ts" in plan
    assert "value" not in plan.split("ReadSchema")[1]
