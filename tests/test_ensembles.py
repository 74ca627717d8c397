import numpy as np
import pytest
from panels import to_spark, weather_frame
from pyspark.sql import functions as F

from panelcast.operators.features import build_features
from panelcast.plans import ensembles, models, training
from panelcast.storage import fresh_path, read_marker, write_marker
from panelcast.weather import WEATHER


@pytest.fixture(scope="module")
def features(spark):
    frame = weather_frame(days=420, seed=7, start="2023-01-01")
    return training.stored_features(build_features(to_spark(spark, frame), WEATHER), WEATHER)


def small(trees, seed):
    return models.forest_regressor(trees, 4, seed)


def predictions(trained, rows):
    return [r.prediction for r in training.predict(trained, rows).orderBy("city", "date").collect()]


def test_batch_sizes():
    assert ensembles.batch_sizes(7, 3) == [3, 3, 1] and ensembles.batch_sizes(2, 5) == [2]
    for trees, per_batch in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            ensembles.batch_sizes(trees, per_batch)


def test_prediction_is_the_mean_of_all_trees(spark, features):
    path = fresh_path(spark, "forest")
    with training.training_set(features, WEATHER) as data:
        trained, fitted = ensembles.fit_in_batches(data, small, 7, 3, path, seed=5)
        alone = [training.fit(data, small(size, 5 + i)) for i, size in enumerate((3, 3, 1))]
    assert fitted == 3 and trained.config.name == "Random Forest (7 trees)"
    test = data.test
    parts = [np.array(predictions(t, test)) for t in alone]
    mean = (3 * parts[0] + 3 * parts[1] + parts[2]) / 7
    np.testing.assert_allclose(predictions(trained, test), mean, rtol=1e-12)
    rows = training.predict(trained, test)
    columns = ensembles.batch_columns(trained.model)
    assert len(columns) == 3 and set(columns) <= set(rows.columns)
    importance = ensembles.ensemble_importances(trained.model)
    assert len(importance) == len(trained.names) and sum(importance) == pytest.approx(1.0)
    # Trees of different batches differ.
    assert not np.allclose(parts[0], parts[1])


def test_a_broken_run_is_resumed(spark, features):
    path = fresh_path(spark, "forest")
    with training.training_set(features, WEATHER) as data:
        first, fitted = ensembles.fit_in_batches(data, small, 4, 2, path)
        assert fitted == 2
        again, fitted = ensembles.fit_in_batches(data, small, 4, 2, path)
        assert fitted == 0 and predictions(first, data.test) == predictions(again, data.test)
        # A larger forest keeps the batches it has.
        more, fitted = ensembles.fit_in_batches(data, small, 6, 2, path)
        assert fitted == 1 and len(ensembles.batch_columns(more.model)) == 3
        # A batch whose marker is of something else is trained again.
        write_marker(spark, f"{path}/batch-0001/marker", "other")
        _, fitted = ensembles.fit_in_batches(data, small, 4, 2, path)
        assert fitted == 1
        _, fitted = ensembles.fit_in_batches(data, lambda n, seed: models.forest_regressor(n, 3, seed), 4, 2, path)
        assert fitted == 2
    with training.training_set(features.where("city <> 'A'"), WEATHER) as data:
        _, fitted = ensembles.fit_in_batches(data, lambda n, seed: models.forest_regressor(n, 3, seed), 4, 2, path)
        assert fitted == 2


def test_an_averaged_forest_is_saved_like_any_model(spark, features):
    with training.training_set(features, WEATHER) as data:
        trained, _ = ensembles.fit_in_batches(data, small, 4, 2, fresh_path(spark, "forest"))
        made_of = models.manifest(trained.model, data.train, WEATHER, data.numeric, data.rows_fingerprint())
    path = fresh_path(spark, "model")
    models.save_model(trained.model, path, WEATHER, data.numeric, spark, made_of)
    loaded = models.load_checked(path, spark, WEATHER, data.test)
    after = [r.prediction for r in loaded.transform(data.test).orderBy("city", "date").collect()]
    assert after == predictions(trained, data.test)


def test_flags_are_not_averaged(spark, features):
    with training.training_set(features, WEATHER) as data:
        with pytest.raises(ValueError, match="values"):
            ensembles.fit_in_batches(data, lambda n, seed: models.forest_classifier(n, 3, seed), 2, 1, fresh_path(spark, "forest"))


def test_markers(spark):
    path = fresh_path(spark, "marker")
    assert read_marker(spark, path) is None
    write_marker(spark, path, "one")
    write_marker(spark, path, "two")
    assert read_marker(spark, path) == "two"


def test_a_stored_model_is_fitted_once(spark, features, monkeypatch):
    folder, fits = fresh_path(spark, "models"), []
    for config in (models.linear(), models.logistic(5), models.forest_classifier(3, 3)):
        with training.training_set(features, WEATHER) as data:
            first = training.fit_stored(data, config, folder)
            plain = training.fit(data, config)
        with training.training_set(features, WEATHER) as data:
            with monkeypatch.context() as patch:
                patch.setattr(training, "write_marker", lambda *a: fits.append(a))
                again = training.fit_stored(data, config, folder)
        assert predictions(first, data.test) == predictions(again, data.test) == predictions(plain, data.test)
    assert fits == []
    # Other rows, partitions or settings are other models.
    for rows, parts, config in ((features.where("city = 'A'"), 8, models.linear()), (features, 3, models.linear()), (features, 8, models.logistic(6))):
        with training.training_set(rows, WEATHER, partitions=parts) as data, monkeypatch.context() as patch:
            patch.setattr(training, "write_marker", lambda *a: fits.append(a))
            training.fit_stored(data, config, folder)
    assert len(fits) == 3


@pytest.fixture(scope="module")
def saved(spark, features):
    with training.training_set(features, WEATHER) as data:
        trained = training.fit(data, small(3, 1))
        rows = data.rows_fingerprint()
        made_of = models.manifest(trained.model, data.train, WEATHER, data.numeric, rows)
    path = fresh_path(spark, "model")
    models.save_model(trained.model, path, WEATHER, data.numeric, spark, made_of)
    return path, data.test, rows


def test_a_checked_model_must_fit_its_use(spark, saved):
    from dataclasses import replace

    path, test, rows = saved
    models.load_checked(path, spark, WEATHER, test, rows)
    with pytest.raises(ValueError, match="another spec"):
        models.load_checked(path, spark, replace(WEATHER, threshold=2.0))
    retyped = test.withColumn("temp_avg_3d", F.col("temp_avg_3d").cast("string"))
    with pytest.raises(ValueError, match="temp_avg_3d double .found string"):
        models.load_checked(path, spark, WEATHER, retyped)
    with pytest.raises(ValueError, match="month int .found none"):
        models.load_checked(path, spark, WEATHER, test.drop("month"))
    with pytest.raises(ValueError, match="other rows"):
        models.load_checked(path, spark, WEATHER, test, "other")


def test_a_manifest_belongs_to_its_model(spark, saved, features):
    path, _, _ = saved
    with training.training_set(features, WEATHER) as data:
        other = training.fit(data, small(2, 2)).model
    other.write().overwrite().save(f"{path}-swapped/model")
    spark.read.schema(models.INPUTS).json(f"{path}/inputs").write.json(f"{path}-swapped/inputs")
    with pytest.raises(ValueError, match="another model"):
        models.load_model(f"{path}-swapped", spark)
    models.save_model(other, f"{path}-plain", WEATHER, data.numeric, spark)
    with pytest.raises(ValueError, match="no manifest"):
        models.load_checked(f"{path}-plain", spark, WEATHER)
