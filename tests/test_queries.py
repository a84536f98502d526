"""Every registered query against its SQL, and what its plan must not hold."""

import os

import pytest

from tabmill.plans import all_queries
from tabmill.plans.check import compare, oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def duck():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, SF) == ""


CHEAP = ["fraud_flow", "split_head_tail", "split_stratified", "asof_join", "latest_values", "snapshot_stats",
         "tfidf", "lags", "skew", "drift_daily", "mi_top10", "run_table", "weighted_pr", "best_model", "one_hot"]


@pytest.mark.parametrize("name", CHEAP)
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in plan


def test_filter_and_columns_reach_the_scan(spark):
    plan = QUERIES["column_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,25.0)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_linestatus:string>" in plan


def test_split_label_needs_no_shuffle(spark):
    plan = QUERIES["holdout_fixed"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_subset_read_prunes_the_history(spark):
    plan = QUERIES["asof_one_feature"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "value:double" not in plan


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 12
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
