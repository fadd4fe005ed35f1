"""Every registered query against its SQL on the small tables, and rules all queries keep."""

import pytest

import __spark_entry__ as entry_points
from oracle import database, differences
from voltframe.registry import all_oracles, all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    assert differences(duck, ORACLES[name], QUERIES[name](spark, SF)) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "carbon_intensity_g_per_kwh" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", ["carbon_hourly", "flow_one_resolution", "merge_actions", "xml_to_silver", "v_cards", "plan_resume",
                                  "dq_completeness", "rls_filter", "scd2_asof", "latest_wins"])
def test_plans_stay_in_the_engine(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Scan ExistingRDD"))
