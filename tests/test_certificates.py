import pytest
from panels import to_spark, weather_frame
from pyspark.sql import functions as F

from panelcast.operators.features import build_features
from panelcast.operators.split import time_split
from panelcast.plans import models, training
from panelcast.plans.certificates import certificate, fitted_values, gradient
from panelcast.weather import WEATHER


@pytest.fixture(scope="module")
def features(spark):
    frame = weather_frame(days=420, seed=7, start="2023-01-01")
    return training.stored_features(build_features(to_spark(spark, frame), WEATHER), WEATHER)


@pytest.mark.parametrize("kind", ["linear", "logistic", "penalised"])
def test_fitted_models_are_optimal(features, kind):
    rows = time_split(features, WEATHER)[0].count()
    config = {"linear": models.linear, "logistic": models.logistic, "penalised": lambda: models.penalised_logistic(rows)}[kind]()
    with training.training_set(features, WEATHER, [config.centred]) as data:
        trained = training.fit(data, config)
        found = certificate(data, trained).collect()
        assert [r.input for r in sorted(found)] == [*trained.names, "intercept"]
        assert max(abs(r.relative) for r in found) < (1e-3 if kind == "linear" else 2e-3)
        # A model that is off by a little is not.
        moved = fitted_values(data, trained).withColumn("fitted", F.col("fitted") * 0.9)
        assert max(abs(r.relative) for r in gradient(moved, trained.names).collect()) > 0.02


def test_a_model_stopped_early_is_found_out(features):
    config = models.logistic(iterations=2)
    with training.training_set(features, WEATHER) as data:
        found = certificate(data, training.fit(data, config)).collect()
    assert max(abs(r.relative) for r in found) > 0.005


def test_gradient_of_a_small_table(spark):
    rows = [([1.0, 0.0], 1.0, 2.0, 1.5), ([3.0, 0.0], 2.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "x array<double>, y double, w double, fitted double")
    found = {r.input: r for r in gradient(df, ["a", "b"], [0.5, 7.0], penalty=2.0).collect()}
    # a: (2 * 0.5 * 1 - 1 * 3) / 3 + 2 * 0.5
    assert found["a"].gradient == pytest.approx(-2 / 3 + 1) and found["a"].scale == pytest.approx(4 / 3 + 1)
    assert found["b"].gradient == 14.0 and found["intercept"].gradient == pytest.approx(0.0)
    assert {r.relative for r in gradient(df, ["a", "b"]).collect() if r.input == "b"} == {0.0}
    with pytest.raises(ValueError, match="coefficients"):
        gradient(df, ["a", "b"], [1.0])
