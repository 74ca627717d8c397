"""Training rows that are all of one class: models forecast that class instead of failing."""

import datetime as dt

import pytest
from panels import to_spark, weather_frame
from pyspark.sql import functions as F

from panelcast.operators import split
from panelcast.operators.features import build_features
from panelcast.operators.splits import best_split
from panelcast.plans import models, scoring, training
from panelcast.plans.certificates import certificate
from panelcast.plans.models import positive_score
from panelcast.weather import WEATHER


@pytest.fixture(scope="module", params=[0, 1])
def one_class(request, spark):
    """The class, the panel and its features; days of 2023 are for training."""
    frame = weather_frame(cities=("A", "B"), days=400, seed=3, start="2023-01-01")
    frame[["rain_sum", "precipitation_sum"]] = 100.0 * request.param
    panel = to_spark(spark, frame)
    return request.param, panel, training.stored_features(build_features(panel, WEATHER), WEATHER)


def classifiers(rows):
    return [
        models.logistic(),
        models.penalised_logistic(rows),
        models.forest_classifier(trees=3, depth=2),
        models.deep_forest_classifier(),
    ]


def test_weights(spark):
    for label, ratio in ((0, 1.0), (1, 0.0)):
        rows = spark.createDataFrame([(label,), (label,)], "y int")
        assert [r.w for r in split.with_class_weight(rows, "y", one_class=True).collect()] == [ratio] * 2
        assert [r.w for r in split.with_balanced_weight(rows, "y", one_class=True).collect()] == [1.0] * 2
        for weigh in (split.with_class_weight, split.with_balanced_weight):
            with pytest.raises(ValueError, match="both classes"):
                weigh(rows.limit(0), "y", one_class=True)


def test_classifiers_forecast_the_class(one_class):
    label, _, features = one_class
    train, test = split.time_split(features, WEATHER)
    configs = classifiers(train.count())
    with training.training_set(features, WEATHER, [False, True]) as data:
        for config in configs:
            trained = training.fit(data, config)
            found = training.predict(trained, test).select("prediction", positive_score().alias("s")).distinct()
            assert [tuple(r) for r in found.collect()] == [(float(label), float(label))]
            if config.name.startswith("Logistic"):
                assert {r.relative for r in certificate(data, trained).collect()} == {0.0}
    board = training.leaderboard(features, WEATHER, configs, baselines=False).collect()
    assert [r.Accuracy for r in board] == [1.0] * 4


def test_requests_are_scored(spark, one_class):
    label, panel, features = one_class
    with training.training_set(features, WEATHER) as data:
        value, flag = (training.fit(data, c).model for c in (models.linear(), models.forest_classifier(3, 2)))
    requests = spark.createDataFrame([(c, dt.date(2024, 1, 10)) for c in "AB"], "city string, date date")
    scored = scoring.score(requests, panel, WEATHER, value, flag).collect()
    assert [(r.status, r.score, r.decision) for r in scored] == [("ok", float(label), "YES" if label else "NO")] * 2


def test_a_constant_label_has_no_split(one_class):
    _, _, features = one_class
    label = WEATHER.flag_target.alias
    rows = split.with_class_weight(features.withColumn(label, F.col(label).cast("double")), label, one_class=True)
    assert best_split(rows, ["month"], label, split.WEIGHT).count() == 0
