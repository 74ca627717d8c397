import os

import pytest
from panels import from_rows, rows_of, to_spark, weather_frame

from panelcast.catalogue import Catalogue, source_fingerprint
from panelcast.operators.features import build_features, scoring_features
from panelcast.plans.store import feature_store, panel_rows, scoring_rows, training_rows
from panelcast.weather import WEATHER
from workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    """The plan as executed."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def catalogue(spark, tmp_path):
    return Catalogue(spark, str(tmp_path / "catalogue"))


@pytest.fixture
def panel(spark, tmp_path):
    path = str(tmp_path / "panel")
    to_spark(spark, weather_frame(days=30, keep=0.8)).write.parquet(path)
    return spark.read.parquet(path)


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_one_table_serves_training_and_scoring(catalogue, panel):
    store = feature_store(catalogue, panel, WEATHER)
    same(training_rows(store, WEATHER), build_features(panel, WEATHER))
    same(scoring_rows(store, WEATHER), scoring_features(panel, WEATHER, actuals=True))
    same(panel_rows(store, WEATHER), panel.select("city", "date", *WEATHER.measures))
    plan = plan_of(training_rows(store, WEATHER))
    assert "Window" not in plan and "Exchange" not in plan


def test_a_table_is_built_once(spark, catalogue, panel, tmp_path):
    built = []

    def build():
        built.append(1)
        return panel

    made_of = source_fingerprint(panel)
    assert catalogue.find("t", made_of) is None
    first = catalogue.table("t", made_of, build)
    again = catalogue.table("t", source_fingerprint(spark.read.parquet(str(tmp_path / "panel"))), build)
    assert built == [1]
    same(first, again)
    catalogue.table("t", made_of + "other", build)
    catalogue.table("u", made_of, build)
    assert built == [1, 1, 1]


def test_changed_files_and_plans_have_other_names(spark, panel, tmp_path):
    path = str(tmp_path / "panel")
    before = source_fingerprint(panel)
    assert source_fingerprint(panel.where("city = 'A'")) != before
    panel.where("city = 'A'").write.mode("append").parquet(path)
    assert source_fingerprint(spark.read.parquet(path)) != before
    rows = from_rows(spark, rows_of("A", ["2024-01-01"]))
    assert source_fingerprint(rows) == source_fingerprint(from_rows(spark, rows_of("A", ["2024-01-01"])))
    assert source_fingerprint(rows) != source_fingerprint(from_rows(spark, rows_of("A", ["2024-01-02"])))


def test_an_unfinished_table_is_not_found(spark, catalogue, panel):
    with pytest.raises(ZeroDivisionError):
        catalogue.table("t", "x", lambda: panel, lambda df, path: (df.write.parquet(path), 1 / 0))
    assert catalogue.find("t", "x") is None
    assert catalogue.table("t", "x", lambda: panel).count() == panel.count()


def test_the_owner_deletes_its_tables(spark, tmp_path, panel):
    root = str(tmp_path / "owned")
    with Catalogue(spark, root) as catalogue:
        feature_store(catalogue, panel, WEATHER)
        assert os.path.exists(root)
    assert not os.path.exists(root)
    assert Catalogue(spark, root).find("features", "x") is None


@pytest.mark.parametrize("name", ["request_status", "threshold_decisions", "baseline_forecast", "baseline_cards"])
def test_requests_read_the_stored_table_only(spark, name):
    QUERIES[name](spark, SF_DIR)
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "lineitem" not in plan and plan.count("lag(") == 0
