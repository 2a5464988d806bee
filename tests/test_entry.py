"""The driver contract: entry() runs on sf0.001, queries and SQL twins pair up."""

import os

import pytest

import __spark_entry__ as entry_module

pytestmark = pytest.mark.skipif(not os.path.isdir(entry_module.SMOKE_DIR), reason="test tables not present")


def test_entry_runs_with_stable_schema(spark):
    df = entry_module.entry(spark)
    first = df.schema
    assert df.count() == 1227  # region-days at sf0.001
    assert entry_module.entry(spark).schema == first
    assert [f.name for f in first] == [
        "sales_date", "region_name", "order_count", "units_sold", "revenue", "returns", "average_line_revenue"]


def test_every_query_has_a_sql_twin():
    from tillroll.plans.queries import QUERIES

    qs, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(QUERIES) <= set(qs) and set(QUERIES) <= set(sql) and set(sql) <= set(qs)
    assert len(QUERIES) == 44
    assert all(s.lstrip().upper().startswith("SELECT") for s in sql.values())


def test_scenarios_can_be_dropped(spark):
    from tillroll.plans import scenario

    first = scenario.scenario(spark, entry_module.SMOKE_DIR)
    assert scenario.scenario(spark, entry_module.SMOKE_DIR) is first
    scenario.reset(spark)
    assert scenario.scenario(spark, entry_module.SMOKE_DIR) is not first
