import math

import pytest
from panels import to_spark, weather_frame
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from panelcast.operators import baselines, metrics, split
from panelcast.operators.features import build_features
from panelcast.operators.sampling import sample_rows, sample_rows_by, top
from panelcast.plans.training import baseline_rows, task_results
from panelcast.weather import WEATHER


def binary(spark, pairs):
    return spark.createDataFrame([(float(y), float(p)) for y, p in pairs], "y double, p double")


@pytest.mark.parametrize(
    "pairs,want",
    [
        ([(1, 0), (0, 0), (0, 0), (1, 0)], (0.5, 0.0, 0.0, 0.0)),
        ([(0, 1), (0, 0)], (0.5, 0.0, 0.0, 0.0)),
        ([(0, 0), (0, 0)], (1.0, 0.0, 0.0, 0.0)),
        ([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], (0.6, 0.667, 0.667, 0.667)),
    ],
)
def test_binary_metrics(spark, pairs, want):
    assert tuple(metrics.binary_metrics(binary(spark, pairs), "y", "p").first()) == want


def test_metrics_agree_with_evaluators(spark):
    df = spark.range(500).select(
        (F.rand(1) * 10).alias("t"),
        (F.rand(2) * 10).alias("q"),
        (F.rand(3) > 0.6).cast("double").alias("y"),
        (F.rand(4) > 0.5).cast("double").alias("p"),
    ).cache()
    got = metrics.regression_metrics(df, "t", "q", digits=None).first()
    for name, metric in (("RMSE", "rmse"), ("MAE", "mae"), ("R2", "r2")):
        ev = RegressionEvaluator(labelCol="t", predictionCol="q", metricName=metric)
        assert got[name] == pytest.approx(ev.evaluate(df))
    got = metrics.binary_metrics(df, "y", "p", digits=None).first()
    for name, metric in (
        ("Accuracy", "accuracy"),
        ("Precision", "precisionByLabel"),
        ("Recall", "recallByLabel"),
        ("F1", "fMeasureByLabel"),
    ):
        ev = MulticlassClassificationEvaluator(
            labelCol="y", predictionCol="p", metricName=metric, metricLabel=1.0
        )
        assert got[name] == pytest.approx(ev.evaluate(df))


def test_constant_label_has_r2_of_zero_unless_exact(spark):
    df = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert (row["RMSE"], row["MAE"], row["R2"]) == (0.5, 0.5, 0.0)


def test_confusion_matrix_lists_both_classes(spark):
    df = binary(spark, [(1, 0), (1, 0), (0, 0)])
    rows = [tuple(r) for r in metrics.confusion_matrix(df, "y", "p").collect()]
    assert rows == [("Dry", 1, 0), ("Rain", 2, 0)]


def test_sweep_equals_one_evaluation_per_threshold(spark):
    df = spark.range(400).select(
        F.round(F.rand(1), 2).alias("s"), (F.rand(2) > 0.7).cast("int").alias("y")
    ).cache()
    sweep = metrics.threshold_sweep(df, "y", "s").collect()
    assert len(sweep) == 17
    for row in sweep:
        decided = df.withColumn("p", (F.col("s") >= row["threshold"]).cast("double"))
        assert tuple(row)[1:] == tuple(metrics.binary_metrics(decided, "y", "p").first())


def test_sweep_counts_ties_as_reached(spark):
    df = spark.createDataFrame([(0.5, 1), (0.45, 0)], "s double, y int")
    rows = {r["threshold"]: r for r in metrics.threshold_sweep(df, "y", "s").collect()}
    assert rows[0.5]["Recall"] == 1.0 and rows[0.5]["Accuracy"] == 1.0
    assert rows[0.55]["Recall"] == 0.0


def test_class_weights(spark):
    df = binary(spark, [(1, 0), (0, 0), (0, 0), (0, 0)]).select(F.col("y").cast("int").alias("y"))
    assert tuple(split.class_weights(df, "y").first()) == (1, 3, 3.0)
    weighted = {r["y"]: r["w"] for r in split.with_class_weight(df, "y").distinct().collect()}
    assert weighted == {1: 3.0, 0: 1.0}
    balanced = {r["y"]: r["weight"] for r in split.balanced_weights(df, "y").collect()}
    assert balanced == {0: pytest.approx(4 / 6), 1: 2.0}
    column = {r["y"]: r["w"] for r in split.with_balanced_weight(df, "y").distinct().collect()}
    assert column == {k: pytest.approx(v) for k, v in balanced.items()}


def test_class_without_rows_is_an_error(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    assert split.class_weights(df, "y").first()["ratio"] is None
    assert [r["weight"] for r in split.balanced_weights(df, "y").collect()] == [1.0]
    for weigh in (split.with_class_weight, split.with_balanced_weight):
        with pytest.raises(ValueError, match="both classes"):
            weigh(df, "y")


def test_split_is_by_time_and_baselines_score_the_test_years(spark):
    features = build_features(to_spark(spark, weather_frame(days=120)), WEATHER).cache()
    train, test = split.time_split(features, WEATHER)
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    counts = {r["part"]: r["rows"] for r in split.split_counts(features, WEATHER).collect()}
    assert counts == {"train": train.count(), "test": test.count()}
    inputs = split.feature_list(features, WEATHER).collect()
    assert len(inputs) == 24 and inputs[-1]["kind"] == "category"

    frame = test.toPandas()
    error = frame["temp_tomorrow"] - frame["temperature_2m_mean"]
    rows = baseline_rows(test, WEATHER, digits=None)
    table = {r["model"]: r for r in rows.collect()}
    assert table["Baseline (tomorrow = today)"]["RMSE"] == pytest.approx(
        math.sqrt((error**2).mean())
    )
    assert table["Baseline (always dry)"]["Accuracy"] == pytest.approx(
        (frame["rain_tomorrow"] == 0).mean()
    )
    repeat = baselines.persistence_flag(test, WEATHER)
    assert table["Baseline (rain today -> rain tomorrow)"]["F1"] == pytest.approx(
        metrics.binary_metrics(repeat, "rain_tomorrow", "prediction", digits=None).first()["F1"]
    )
    assert task_results(rows, "temperature").columns == ["model", "RMSE", "MAE", "R2"]
    assert task_results(rows, "rain").columns == ["model", *metrics.BINARY]


def test_sample_is_exact_and_independent_of_partitions(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    first = {r["k"] for r in sample_rows(df, ["k"], 50).collect()}
    again = {r["k"] for r in sample_rows(df.repartition(7), ["k"], 50).collect()}
    other = {r["k"] for r in sample_rows(df, ["k"], 50, seed=1).collect()}
    assert len(first) == 50 and first == again and first != other
    with pytest.raises(ValueError, match="301 of 300"):
        sample_rows(df, ["k"], 301)


def test_top_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "feature string, v double")
    assert [r["feature"] for r in top(df, "v", "feature", 2).collect()] == ["c", "a"]


def test_samples_are_the_least_md5_of_key_and_seed(spark):
    import hashlib

    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(100)], "k int, g string").repartition(4)
    place = {i: hashlib.md5(f"{i}|7".encode()).hexdigest() for i in range(100)}
    want = sorted(place, key=place.get)[:30]
    assert sorted(r.k for r in sample_rows(df, ["k"], 30, seed=7).collect()) == sorted(want)
    for group in (0, 1):
        own = sorted((i for i in place if i % 2 == group), key=place.get)[:5]
        found = sample_rows_by(df, ["g"], ["k"], 5, seed=7).where(F.col("g") == "ab"[group])
        assert sorted(r.k for r in found.collect()) == sorted(own)
    assert sample_rows(df, ["k"], 500, strict=False).count() == 100
    assert sample_rows_by(df, ["g"], ["k"], 500).count() == 100
    plan = sample_rows_by(df, ["g"], ["k"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
