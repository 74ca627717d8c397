import datetime as dt
import re

import numpy as np
import pytest
from panels import from_rows, rows_of, to_spark, weather_frame
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelcast.operators.features import build_features, feature_names, scoring_features
from panelcast.operators.split import time_split
from panelcast.plans import models, reports, scoring, training
from panelcast.storage import fresh_path
from panelcast.weather import WEATHER


@pytest.fixture(scope="module")
def frame():
    return weather_frame(days=500, seed=7, start="2023-01-01")


@pytest.fixture(scope="module")
def features(spark, frame):
    return training.stored_features(build_features(to_spark(spark, frame), WEATHER), WEATHER)


@pytest.fixture(scope="module")
def fitted(features):
    configs = {
        "linear": models.linear(),
        "forest": models.forest_regressor(trees=8, depth=4),
        "logistic": models.logistic(),
        "classifier": models.forest_classifier(trees=8, depth=4),
    }
    with training.training_set(features, WEATHER) as data:
        return {k: training.fit(data, c) for k, c in configs.items()}


def prepared_arrays(fitted, rows, label):
    table = fitted.model.transform(rows).select(
        vector_to_array("features").alias("x"), F.col(label).alias("y"), "prediction"
    ).toPandas()
    return np.array(table["x"].tolist()), table["y"].to_numpy(float), table["prediction"]


def test_linear_regression_solves_least_squares(features, fitted):
    train, test = time_split(features, WEATHER)
    x, y, _ = prepared_arrays(fitted["linear"], train, "temp_tomorrow")
    design = np.c_[x, np.ones(len(x))]
    solution, *_ = np.linalg.lstsq(design, y, rcond=None)
    xt, _, predicted = prepared_arrays(fitted["linear"], test, "temp_tomorrow")
    np.testing.assert_allclose(predicted, np.c_[xt, np.ones(len(xt))] @ solution, atol=1e-4)


def test_linear_model_beats_persistence_on_autocorrelated_noise(features):
    rows = training.leaderboard(features, WEATHER, [models.linear()]).collect()
    rmse = {r["model"]: r["RMSE"] for r in rows if r["task"] == "temperature"}
    assert rmse["Linear Regression"] < 0.9 * rmse["Baseline (tomorrow = today)"]
    seconds = {r["model"]: r["seconds"] for r in rows}
    assert seconds["Linear Regression"] >= 0
    assert seconds["Baseline (tomorrow = today)"] is None


def test_scaling_is_by_sample_deviation_without_centring(features, fitted):
    train, _ = time_split(features, WEATHER)
    x, _, _ = prepared_arrays(fitted["linear"], train, "temp_tomorrow")
    np.testing.assert_allclose(x.std(axis=0, ddof=1), 1.0, rtol=1e-9)
    assert abs(x[:, 0].mean()) > 0.5
    assert len(fitted["linear"].names) == 23 + 3
    assert fitted["linear"].names[-3:] == ["city_vec_A", "city_vec_B", "city_vec_C"]


def test_unseen_entity_is_all_zero(features, fitted):
    row = features.limit(1).withColumn("city", F.lit("ZZ"))
    out = fitted["linear"].model.transform(row).select(vector_to_array("city_vec")).first()[0]
    assert out == [0.0, 0.0, 0.0]


def test_weighted_logistic_has_zero_gradient(features, fitted):
    train, _ = time_split(features, WEATHER)
    trained = fitted["logistic"].model
    table = trained.transform(train).select(
        vector_to_array("features").alias("x"),
        F.col("rain_tomorrow").alias("y"),
        models.positive_score().alias("p"),
    ).toPandas()
    x, y, p = np.array(table["x"].tolist()), table["y"].to_numpy(float), table["p"].to_numpy()
    w = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    gradient = (x * (w * (p - y))[:, None]).sum(axis=0) / w.sum()
    assert np.abs(gradient).max() < 1e-3


def test_penalised_logistic_minimises_the_penalised_loss(features):
    train, _ = time_split(features, WEATHER)
    rows = train.count()
    config = models.penalised_logistic(rows)
    with training.training_set(features, WEATHER, [config.centred]) as data:
        model = training.fit(data, config).model
    table = model.transform(train).select(
        vector_to_array("features").alias("x"),
        F.col("rain_tomorrow").alias("y"),
        models.positive_score().alias("p"),
    ).toPandas()
    x, y, p = np.array(table["x"].tolist()), table["y"].to_numpy(float), table["p"].to_numpy()
    assert np.abs(x[:, :23].mean(axis=0)).max() < 1e-6
    w = np.where(y == 1, rows / 2 / (y == 1).sum(), rows / 2 / (y == 0).sum())
    b = model.stages[-1].coefficients.toArray()
    gradient = (x * (w * (p - y))[:, None]).sum(axis=0) + b
    assert np.abs(gradient).max() / rows < 1e-3


def test_forest_settings():
    plain = models.forest_regressor().build("f", "y")
    assert (plain.getNumTrees(), plain.getMaxDepth(), plain.getSeed()) == (100, 10, 42)
    deep = models.deep_forest_regressor().build("f", "y")
    assert (deep.getNumTrees(), deep.getMaxDepth()) == (200, 15)
    assert deep.getMinInstancesPerNode() == 3 and deep.getFeatureSubsetStrategy() == "all"
    deep = models.deep_forest_classifier().build("f", "y")
    assert (deep.getNumTrees(), deep.getMaxDepth(), deep.getMinInstancesPerNode()) == (200, 12, 5)
    assert models.deep_forest_classifier().weights == "balanced"
    names = [(c.task, c.name) for c in models.standard_configs()]
    assert len(names) == 4


def test_remembering_nodes_does_not_change_the_forest(features):
    configs = [models.forest_regressor(5, 6, cacheNodeIds=keep) for keep in (True, False)]
    with training.training_set(features, WEATHER) as data:
        kept, sent = [training.fit(data, c).model.stages[-1] for c in configs]
    assert kept.toDebugString.split("\n", 1)[1] == sent.toDebugString.split("\n", 1)[1]


def test_forest_does_not_depend_on_input_partitions(features):
    found = set()
    for parts in (1, 3, 8):
        with training.training_set(features.repartition(parts), WEATHER) as data:
            forest = training.fit(data, models.forest_regressor(5, 6)).model.stages[-1]
            found.add(forest.toDebugString.split("\n", 1)[1])
    assert len(found) == 1


def test_importances_carry_names(spark, fitted):
    forest = fitted["forest"]
    table = models.importances(forest.model.stages[-1], forest.names, spark)
    rows = {r["feature"]: r["importance"] for r in table.collect()}
    assert len(rows) == 26 and sum(rows.values()) == pytest.approx(1.0)
    best = reports.importance_bars(table).collect()
    assert len(best) == 10
    assert [r["importance"] for r in best] == sorted(rows.values(), reverse=True)[:10]
    assert best[0]["feature"].startswith("temp")


def test_saved_model_predicts_the_same(spark, features, fitted):
    path = fresh_path(spark, "model")
    numeric = feature_names(features.columns, WEATHER)
    models.save_model(fitted["forest"].model, path, WEATHER, numeric, spark)
    loaded, spec, inputs = models.load_model(path, spark)
    assert spec == WEATHER and inputs == numeric
    test = time_split(features, spec)[1].orderBy("city", "date")
    before = [r["prediction"] for r in fitted["forest"].model.transform(test).collect()]
    assert before == [r["prediction"] for r in loaded.transform(test).collect()]


def test_saved_model_must_use_its_recorded_inputs(spark, fitted):
    path = fresh_path(spark, "model")
    models.save_model(fitted["forest"].model, path, WEATHER, ["no_such_input"], spark)
    with pytest.raises(ValueError, match="no_such_input"):
        models.load_model(path, spark)


@pytest.fixture(scope="module")
def scored(spark, frame, fitted):
    last = frame["date"].max()
    first = frame["date"].min()
    asked = [
        ("A", dt.date(2023, 6, 1), 0.0),
        ("A", dt.date(2024, 3, 1), 1.01),
        ("B", first, 0.5),
        ("B", last, 0.5),
        ("B", last + dt.timedelta(days=1), 0.5),
        ("ZZ", last, 0.5),
        ("A", dt.date(2023, 6, 1), 0.0),
    ]
    requests = spark.createDataFrame(asked, "city string, date date, threshold double")
    panel = to_spark(spark, frame)
    return scoring.score(
        requests, panel, WEATHER, fitted["linear"].model, fitted["classifier"].model
    ).cache()


def test_every_request_is_answered(scored, frame):
    rows = {(r["city"], r["date"]): r for r in scored.collect()}
    assert scored.count() == 7
    status = [r["status"] for r in rows.values()]
    assert sorted(status) == [
        "insufficient_history", "no_such_day", "ok", "ok", "ok", "unknown_entity"
    ]
    early = rows["A", dt.date(2023, 6, 1)]
    assert early["decision"] == "YES" and early["era"] == "Training date"
    assert early["tomorrow"]["label"] == "Rain" and early["next_day"] == dt.date(2023, 6, 2)
    actual = frame[(frame.city == "A") & (frame.date == dt.date(2023, 6, 2))].iloc[0]
    assert early["actual_value"] == actual["temperature_2m_mean"]
    assert early["actual_event"] == ("rainy" if actual["precipitation_sum"] >= 1 else "dry")
    later = rows["A", dt.date(2024, 3, 1)]
    assert later["decision"] == "NO" and later["era"] == "Unseen test date"
    last = rows["B", frame["date"].max()]
    assert last["predicted"] is not None and last["actual_value"] is None
    refused = rows["B", frame["date"].min()]
    assert refused["predicted"] is None and refused["decision"] is None


def test_scores_equal_the_model_on_the_training_table(scored, features, fitted):
    day = dt.date(2024, 3, 1)
    row = features.where((F.col("city") == "A") & (F.col("date") == F.lit(day)))
    want = fitted["linear"].model.transform(row).first()["prediction"]
    share = fitted["classifier"].model.transform(row).select(models.positive_score()).first()[0]
    got = scored.where((F.col("city") == "A") & (F.col("date") == F.lit(day))).first()
    assert got["predicted"] == pytest.approx(want) and got["score"] == pytest.approx(share)


def test_stored_features_give_the_same_answers(spark, scored, frame, fitted):
    panel = to_spark(spark, frame)
    stored = training.stored_features(scoring_features(panel, WEATHER, actuals=True), WEATHER)
    requests = scored.select("city", "date", "threshold")
    again = scoring.score(
        requests, panel, WEATHER, fitted["linear"].model, fitted["classifier"].model,
        features=stored,
    )
    key = ["city", "date", "status", "predicted", "score", "decision", "actual_value"]
    assert sorted(map(str, again.select(key).collect())) == sorted(
        map(str, scored.select(key).collect())
    )


def test_default_threshold(spark, frame, fitted):
    requests = spark.createDataFrame([("A", dt.date(2024, 3, 1))], "city string, date date")
    row = scoring.score(
        requests, to_spark(spark, frame), WEATHER, fitted["linear"].model,
        fitted["classifier"].model,
    ).first()
    assert row["decision"] == ("YES" if row["score"] >= 0.5 else "NO")


def test_cards_and_glance(scored, frame):
    cards = {(r["city"], r["date"]): r for r in reports.cards(scored, WEATHER).collect()}
    assert len(cards) == 3
    last = cards["B", frame["date"].max()]
    assert last["predicted_foot"].endswith("No actual data for this day")
    early = cards["A", dt.date(2023, 6, 1)]
    today = frame[(frame.city == "A") & (frame.date == dt.date(2023, 6, 1))].iloc[0]
    tomorrow = frame[(frame.city == "A") & (frame.date == dt.date(2023, 6, 2))].iloc[0]
    assert early["observed_day"] == "Thu, 01 Jun 2023" and early["predicted_day"] == "Fri, 02 Jun"
    assert early["observed_level"] == f"{today['temperature_2m_mean']:.0f}"
    numbers = re.findall(r"-?\d+\.\d", early["predicted_foot"].split(" · ")[1])
    want = [tomorrow["temperature_2m_mean"], tomorrow["precipitation_sum"]]
    assert [float(n) for n in numbers] == [float(np.round(v, 1)) for v in want]
    assert reports.glance(scored, WEATHER).where("city = 'A'").count() == 3


def test_chart_has_history_forecast_and_actual(spark, scored, frame):
    requests = scored.select("city", "date").distinct()
    chart = reports.history_chart(requests, to_spark(spark, frame), WEATHER, scored.distinct())
    day = dt.date(2023, 6, 1)
    rows = chart.where((F.col("city") == "A") & (F.col("request_day") == F.lit(day))).collect()
    by_series = {}
    for r in rows:
        by_series.setdefault(r["series"], []).append(r["chart_day"])
    fortnight = [day - dt.timedelta(days=i) for i in range(13, -1, -1)]
    assert sorted(by_series["Last 14 days"]) == fortnight
    assert by_series["Predicted tomorrow"] == [dt.date(2023, 6, 2)]
    assert by_series["Actual"] == [dt.date(2023, 6, 2)]


def test_glance_asks_for_every_entity_present_on_the_day(spark):
    panel = from_rows(spark, rows_of("A", ["2024-01-01"]) + rows_of("B", ["2024-01-02"]))
    days = spark.createDataFrame([(dt.date(2024, 1, 1),)] * 2, "date date")
    rows = reports.glance_requests(panel, days, WEATHER).collect()
    assert [tuple(r) for r in rows] == [("A", dt.date(2024, 1, 1))]


def test_prepared_test_rows_give_the_same_predictions(features):
    config = models.linear()
    with training.training_set(features, WEATHER) as data:
        trained = training.fit(data, config)
        rows = data.test_rows(False)
        assert data.test_rows(False) is rows and rows.is_cached
        got = training.predict_prepared(trained, rows).orderBy("city", "date").collect()
        want = training.predict(trained, data.test).orderBy("city", "date").collect()
        assert [r.prediction for r in got] == [r.prediction for r in want]
    assert not rows.is_cached


def test_scatter_points(features, fitted):
    _, test = time_split(features, WEATHER)
    points = reports.actual_vs_predicted(
        training.predict(fitted["linear"], test), WEATHER, rows=100
    )
    assert points.columns == ["city", "date", "actual", "predicted"] and points.count() == 100
