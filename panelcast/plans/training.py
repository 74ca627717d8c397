"""Train models on a feature table, compare them, keep the leaderboard."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.baselines import always_negative, persistence_flag, persistence_value
from panelcast.operators.features import feature_names
from panelcast.operators.metrics import BINARY, REGRESSION, binary_columns, regression_columns
from panelcast.operators.split import WEIGHT, time_split, with_balanced_weight, with_class_weight
from panelcast.plans.models import (
    FEATURES,
    ModelConfig,
    input_names,
    preparation,
)
from panelcast.sources.writers import RESULTS, write_features
from panelcast.spec import PanelSpec
from panelcast.storage import (
    ensure_checkpoints,
    fresh_path,
    read_marker,
    table_fingerprint,
    write_marker,
)

# Task and baseline names in results files.
VALUE_TASK, FLAG_TASK = "temperature", "rain"
SAME_VALUE = "Baseline (tomorrow = today)"
NEVER = "Baseline (always dry)"
SAME_FLAG = "Baseline (rain today -> rain tomorrow)"

# Partitions of the training rows. Bagging follows partitions and row order, so the number is
# fixed and does not depend on the machine; give more for tables of many gigabytes. Every
# partition sends the statistics of every node it meets, so small tables want few.
PARTITIONS = 8

# What Spark ML reads from a label column as its number of classes.
TWO_CLASSES = {"ml_attr": {"type": "nominal", "vals": ["0", "1"]}}


@dataclass
class Trained:
    config: ModelConfig
    model: PipelineModel
    names: list[str]
    seconds: float


@dataclass
class TrainingSet:
    """Prepared training rows, kept while several estimators are fitted."""

    spec: PanelSpec
    numeric: list[str]
    test: DataFrame
    train: DataFrame
    partitions: int
    prepared: dict[bool, tuple[PipelineModel, list[str], DataFrame]] = field(
        default_factory=dict
    )
    prepared_tests: dict[bool, DataFrame] = field(default_factory=dict)

    def test_rows(self, centred: bool) -> DataFrame:
        """The test rows, prepared once for all models that take them, and kept like the
        training rows."""
        if centred not in self.prepared_tests:
            rows = self.prepared[centred][0].transform(self.test)
            labels = [label_of(self.spec, task) for task in ("value", "flag")]
            kept = rows.select(*self.spec.key, FEATURES, *labels)
            self.prepared_tests[centred] = kept.persist(StorageLevel.MEMORY_AND_DISK)
        return self.prepared_tests[centred]

    @cached_property
    def _fingerprint(self) -> str:
        return table_fingerprint(self.train)

    def rows_fingerprint(self) -> str:
        """Names the training rows by content, whatever their order."""
        return self._fingerprint


def stored_features(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """Write the feature table by year under the shared folder and read it back.

    Training reads its rows many times. From files, a lost executor costs a re-read, not
    another scan of the source and another window; each side of the split reads its years
    only.
    """
    spark = features.sparkSession
    path = fresh_path(spark, "features")
    write_features(features, path, spec)
    return spark.read.schema(features.schema).parquet(path).select(*features.columns)


def label_of(spec: PanelSpec, task: str) -> str:
    return (spec.value_target if task == "value" else spec.flag_target).alias


def _spread(train: DataFrame, spec: PanelSpec, partitions: int) -> DataFrame:
    """Even partitions with sorted rows: the same rows give the same forest anywhere.

    The unique key spreads a hot entity too.
    """
    return train.repartition(partitions, *spec.key).sortWithinPartitions(*spec.key)


@contextmanager
def training_set(
    features: DataFrame,
    spec: PanelSpec,
    centred: Iterable[bool] = (False,),
    partitions: int = PARTITIONS,
):
    """Split by time and prepare the training rows once for all estimators.

    ``features`` should be a written table, see :func:`stored_features`. The prepared rows
    are cached on memory and disk inside the block. The same rows and ``partitions`` give the
    same models on any machine. Entities are one-hot inputs, without a limit on their number.
    """
    ensure_checkpoints(features.sparkSession)
    numeric = feature_names(features.columns, spec)
    train, test = time_split(features, spec)
    data = TrainingSet(spec, numeric, test, train, partitions)
    train = _spread(train, spec, partitions)
    value, flag = label_of(spec, "value"), label_of(spec, "flag")
    try:
        for flavour in sorted(set(centred)):
            prep = preparation(spec, numeric, flavour).fit(train)
            rows = prep.transform(train).withColumn(flag, F.col(flag).cast("double"))
            slim = rows.select(FEATURES, value, flag).persist(StorageLevel.MEMORY_AND_DISK)
            data.prepared[flavour] = (prep, input_names(rows), slim)
            slim.count()  # fills the cache, so that no model's time includes it
        yield data
    finally:
        for rows in [rows for _, _, rows in data.prepared.values()] + list(data.prepared_tests.values()):
            rows.unpersist()


def fitting_rows(data: TrainingSet, config: ModelConfig) -> DataFrame:
    """The prepared rows, with the weights that the configuration asks for.

    Training rows may all be of one class, as where no day reaches the threshold: models then
    forecast that class. Its rows weigh alike; 0, as neg/pos of positive rows, would leave nothing to fit.
    """
    _, _, rows = data.prepared[config.centred]
    label = label_of(data.spec, config.task)
    if config.weights == "ratio":
        rows = with_class_weight(rows, label, one_class=True)
        rows = rows.withColumn(WEIGHT, F.when(F.col(WEIGHT) > 0, F.col(WEIGHT)).otherwise(F.lit(1.0)))
    if config.weights == "balanced":
        rows = with_balanced_weight(rows, label, one_class=True)
    if config.two_classes:
        rows = rows.withColumn(label, F.col(label).alias(label, metadata=TWO_CLASSES))
    return rows


def fit(data: TrainingSet, config: ModelConfig) -> Trained:
    started = time.monotonic()
    prep, names, _ = data.prepared[config.centred]
    rows = fitting_rows(data, config)
    estimator = config.build(FEATURES, label_of(data.spec, config.task))
    fitted = estimator.fit(rows)
    model = PipelineModel([*prep.stages, fitted])
    return Trained(config, model, names, time.monotonic() - started)


def stored_stage(estimator: Estimator, rows: DataFrame, path: str, made_of: str) -> tuple[Model, bool]:
    """The fitted model at ``path`` if it was made of the same rows (``made_of``) and settings, else a new
    one that is stored there; and whether it was fitted now. The marker is written last."""
    spark = rows.sparkSession
    settings = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
    wanted = json.dumps({"kind": type(estimator).__name__, "rows": made_of, "settings": settings}, sort_keys=True)
    if read_marker(spark, f"{path}/marker") == wanted:
        return PipelineModel.load(f"{path}/model").stages[0], False
    fitted = estimator.fit(rows)
    PipelineModel([fitted]).write().overwrite().save(f"{path}/model")
    write_marker(spark, f"{path}/marker", wanted)
    return fitted, True


def fit_stored(data: TrainingSet, config: ModelConfig, folder: str) -> Trained:
    """:func:`fit`, unless ``folder`` has the model already, fitted to the same rows with the same settings."""
    started = time.monotonic()
    prep, names, _ = data.prepared[config.centred]
    estimator = config.build(FEATURES, label_of(data.spec, config.task))
    made_of = f"{data.rows_fingerprint()};{data.partitions};{config.weights};{config.centred}"
    name = f"{config.task}-{config.name}".lower().replace(" ", "-")
    fitted, _ = stored_stage(estimator, fitting_rows(data, config), f"{folder}/{name}", made_of)
    return Trained(config, PipelineModel([*prep.stages, fitted]), names, time.monotonic() - started)


def predict(trained: Trained, rows: DataFrame) -> DataFrame:
    return trained.model.transform(rows)


def predict_prepared(trained: Trained, rows: DataFrame) -> DataFrame:
    """Predictions for rows that are prepared already, see :meth:`TrainingSet.test_rows`."""
    return trained.model.stages[-1].transform(rows)


def _metric_columns(spec: PanelSpec, task: str, prediction: str, digits: int | None):
    if task == "value":
        return regression_columns(label_of(spec, task), prediction, digits)
    return binary_columns(label_of(spec, task), F.col(prediction) == 1, digits)


def evaluate(
    predictions: DataFrame, spec: PanelSpec, task: str, name: str, digits: int | None = 3
) -> DataFrame:
    """One leaderboard row without time; all metrics from one pass."""
    columns = _metric_columns(spec, task, "prediction", digits)
    row = predictions.agg(*[c.alias(n) for n, c in columns.items()])
    return row.select(
        F.lit(VALUE_TASK if task == "value" else FLAG_TASK).alias("task"),
        F.lit(name).alias("model"),
        *[
            (F.col(m) if m in columns else F.lit(None).cast("double")).alias(m)
            for m in REGRESSION + BINARY
        ],
    )


def baseline_rows(test: DataFrame, spec: PanelSpec, digits: int | None = 3) -> DataFrame:
    """Leaderboard rows of the three forecasts without a model, from one pass."""
    plain = persistence_value(test, spec).withColumnRenamed("prediction", "p_value")
    plain = persistence_flag(plain, spec).withColumnRenamed("prediction", "p_flag")
    plain = always_negative(plain).withColumnRenamed("prediction", "p_none")
    return _leaderboard(
        plain,
        spec,
        [
            ("value", SAME_VALUE, "p_value"),
            ("flag", NEVER, "p_none"),
            ("flag", SAME_FLAG, "p_flag"),
        ],
        digits,
    )


def _leaderboard(
    wide: DataFrame,
    spec: PanelSpec,
    entries: Sequence[tuple[str, str, str]],
    digits: int | None,
) -> DataFrame:
    """Metrics of several prediction columns of one table, as one row per model."""
    metrics = [_metric_columns(spec, task, column, digits) for task, _, column in entries]
    row = wide.agg(
        *[c.alias(f"m{i}_{n}") for i, m in enumerate(metrics) for n, c in m.items()]
    )
    lines = [
        F.struct(
            F.lit(VALUE_TASK if task == "value" else FLAG_TASK).alias("task"),
            F.lit(name).alias("model"),
            *[
                (
                    F.col(f"m{i}_{n}") if n in metrics[i] else F.lit(None).cast("double")
                ).alias(n)
                for n in REGRESSION + BINARY
            ],
        )
        for i, (task, name, _) in enumerate(entries)
    ]
    return row.select(F.inline(F.array(*lines)))


def leaderboard(
    features: DataFrame,
    spec: PanelSpec,
    configs: Sequence[ModelConfig],
    baselines: bool = True,
    digits: int | None = 3,
) -> DataFrame:
    """Baselines and models on the test years.

    ``seconds`` covers fit, transform and metrics of one model. The preparation that models share is
    not in it: training and test rows are prepared and kept before the first model.
    """
    rows, spark = [], features.sparkSession
    with training_set(features, spec, [c.centred for c in configs]) as data:
        if baselines:
            rows += [(r, None) for r in baseline_rows(data.test, spec, digits).collect()]
        for flavour in {c.centred for c in configs}:
            data.test_rows(flavour).count()
        for config in configs:
            trained = fit(data, config)
            started = time.monotonic()
            tested = predict_prepared(trained, data.test_rows(config.centred))
            scored = evaluate(tested, spec, config.task, config.name, digits).first()
            rows.append((scored, round(trained.seconds + time.monotonic() - started, 1)))
    names = [f.strip().split(" ")[0] for f in RESULTS.split(",")]
    return spark.createDataFrame(
        [tuple((r.asDict() | {"seconds": s})[n] for n in names) for r, s in rows], RESULTS
    )


def task_results(results: DataFrame, task: str) -> DataFrame:
    """The rows of one task without the task column and without columns that are all NULL."""
    rows = results.where(F.col("task") == task)
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).first()
    return rows.select(*[c for c in rows.columns if filled[c] and c != "task"])
