"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as contract
from marketflow.operators.forecast import recent_windows
from marketflow.plans.queries import QUERIES


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", ["bars_15m", "forecast_close", "rank_newest", "route_by_tag", "word_count", "ols_by_region"])
def test_no_python_in_the_hot_path(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not any(node in text for node in PYTHON_NODES)


@pytest.mark.parametrize("name", ["bars_15m", "bars_line_items", "bars_multi_day"])
def test_bars_are_one_hash_aggregation_each(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "SortAggregate" not in text and "partial_min_by" in text
    assert text.count("Exchange hashpartitioning") == (2 if name == "bars_multi_day" else 1)


def test_groups_are_limited_before_both_shuffles(spark, small):
    daily = QUERIES["sector_lookup"](spark, small)
    frames = [
        QUERIES["last_n_strict"](spark, small),
        QUERIES["last_n_inclusive"](spark, small),
        recent_windows(daily),
    ]
    for frame in frames:
        text = plan(frame)
        assert text.count("WindowGroupLimit") == 4
        assert text.count("Exchange hashpartitioning") <= 3


def test_the_forecast_gathers_no_sector(spark, small):
    text = plan(QUERIES["forecast_features"](spark, small))
    assert "Window" not in text and "Exchange hashpartitioning" not in text
    assert text.count("BroadcastHashJoin") == 1


def test_lookup_and_scores_broadcast_the_small_side(spark, small):
    text = plan(QUERIES["score_fixed_coeffs"](spark, small))
    assert text.count("BuildRight") == 2 and "SortMergeJoin" not in text


def test_look_back_reaches_the_scan(spark, small):
    plan_of = QUERIES["range_lookback"](spark, small)._jdf.queryExecution()
    text = plan_of.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in text and "LessThanOrEqual(l_shipdate,2001-01-01" in text
    assert "l_discount" not in text


def test_ranking_shuffles_the_rows_once(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["rank_newest"](spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the window feeds the join as it is; beside it stand the three small shuffles of the counts
    below_join = text.split("SortMergeJoin")[1].splitlines()[1]
    assert below_join.strip().startswith(":- Window")
    assert text.count("Exchange hashpartitioning") == 4


def test_history_is_not_shuffled_by_the_full_join(spark, small):
    text = plan(QUERIES["history_full_join_forecast"](spark, small))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 3


def test_limit_is_a_top_k(spark, small):
    assert "TakeOrderedAndProject" in plan(QUERIES["latest_20"](spark, small))


def test_no_cross_joins(spark, small):
    for name in ("standard_scale", "multi_avg", "forecast_one_step", "sector_completeness"):
        text = plan(contract.queries()[name](spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
