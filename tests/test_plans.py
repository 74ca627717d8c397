"""Shape of the physical plans: shuffles, pruning, no Python and no pairwise joins."""

import pytest
from panels import to_spark, weather_frame

from panelcast.operators.features import build_features
from panelcast.operators.split import time_split
from panelcast.plans import models, scoring, training
from panelcast.plans.store import scoring_rows, training_rows
from panelcast.weather import WEATHER
from workload import QUERIES
from workload.panels import SPEC, order_requests, status_store

SF_DIR = "/root/testdata/sf0.001"
TRAINING = ("train_", "model_", "feature_importance", "actual_vs", "batch_", "forecast_",
            "all_entities_glance", "scaled_", "category_", "linear_fit", "deep_forest", "importance_",
            "linear_grad", "logistic_grad", "penalised_")
PLAIN = sorted(n for n in QUERIES if not n.startswith(TRAINING))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan as it ran."""
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_pairwise_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_all_features_share_one_window_and_one_shuffle(spark):
    plan = plan_of(build_features(to_spark(spark, weather_frame(days=5)), WEATHER))
    assert plan.count("Window [") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_entity_filter_goes_below_the_window(spark):
    table = build_features(to_spark(spark, weather_frame(days=5)), WEATHER)
    plan = plan_of(table.where("city = 'A'"))
    assert plan.count(" = A)") == 1 and plan.index("Window [") < plan.index(" = A)")


def test_bucketed_panel_needs_no_shuffle(spark):
    plan = plan_of(QUERIES["bucketed_feature_table"](spark, SF_DIR))
    assert "Window [" in plan and "Exchange" not in plan


def test_scan_reads_only_the_needed_columns(spark):
    plan = plan_of(QUERIES["n_years"](spark, SF_DIR))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan


def test_chunked_windows_are_one_window_and_one_sort(spark):
    plan = executed(QUERIES["feature_table_chunked"](spark, SF_DIR))
    assert plan.count("Window [") == 1 and plan.count("Sort [") == 1


def test_scoring_reads_the_stored_table_and_runs_each_model_once(spark):
    """With models that are quick to fit; the forecast queries differ in the models only."""
    store = status_store(spark, SF_DIR)
    with training.training_set(training_rows(store, SPEC), SPEC) as data:
        value, flag = (training.fit(data, c).model for c in (models.linear(), models.logistic(5)))
    scored = scoring.score(
        order_requests(spark, SF_DIR), None, SPEC, value, flag, features=scoring_rows(store, SPEC)
    )
    plan = executed(scored)
    assert "lineitem" not in plan and "lag(" not in plan and "lead(" not in plan
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_training_rows_come_from_the_training_years(spark):
    store = training_rows(status_store(spark, SF_DIR), SPEC)
    plan = executed(time_split(store, SPEC)[0])
    assert "Window" not in plan and "Exchange" not in plan and "year#" in plan.split("PartitionFilters")[1]
