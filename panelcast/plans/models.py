"""Feature preparation and the four kinds of estimators."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.split import WEIGHT
from panelcast.spec import PanelSpec

RAW, FEATURES = "raw", "features"
# Each row remembers its node in every tree instead of being sent down the trees again at
# each level: four bytes per row and tree, on memory and disk, checkpointed at intervals.
KEEP_NODES = {"cacheNodeIds": True}


@dataclass(frozen=True)
class ModelConfig:
    """``task`` is "value" or "flag"; ``weights`` is None, "ratio" or "balanced". With
    ``two_classes`` the estimator is told that the label has two classes, whichever occur."""

    name: str
    task: str
    build: Callable[[str, str], Estimator]
    weights: str | None = None
    centred: bool = False
    two_classes: bool = False


def linear() -> ModelConfig:
    return ModelConfig(
        "Linear Regression",
        "value",
        lambda features, label: LinearRegression(featuresCol=features, labelCol=label),
    )


def forest_regressor(trees: int = 100, depth: int = 10, seed: int = 42, **params) -> ModelConfig:
    return ModelConfig(
        "Random Forest",
        "value",
        lambda features, label: RandomForestRegressor(
            featuresCol=features,
            labelCol=label,
            numTrees=trees,
            maxDepth=depth,
            seed=seed,
            **KEEP_NODES | params,
        ),
    )


DEEP_TREES = 200


def deep_forest_regressor(trees: int = DEEP_TREES, seed: int = 42, **params) -> ModelConfig:
    """All features at every split, deeper trees, at least 3 rows in a leaf.

    Statistics of its many nodes are collected in passes of ``maxMemoryInMB`` per task; a
    larger value than the default 256 saves passes. Trained in batches of trees by
    :mod:`panelcast.plans.ensembles`.
    """
    settings = {"minInstancesPerNode": 3, "featureSubsetStrategy": "all"} | params
    return forest_regressor(trees, 15, seed, **settings)


def logistic(iterations: int = 100) -> ModelConfig:
    return ModelConfig(
        "Logistic Regression",
        "flag",
        lambda features, label: LogisticRegression(
            featuresCol=features, labelCol=label, weightCol=WEIGHT, maxIter=iterations
        ),
        weights="ratio",
    )


def penalised_logistic(rows: int, c: float = 1.0, iterations: int = 1000) -> ModelConfig:
    """Balanced weights and the penalty |b|^2 / (2 C) on centred inputs.

    The estimator averages the loss over the weights, which sum to the number of rows.
    """
    return ModelConfig(
        "Logistic Regression (penalised)",
        "flag",
        lambda features, label: LogisticRegression(
            featuresCol=features,
            labelCol=label,
            weightCol=WEIGHT,
            maxIter=iterations,
            regParam=1.0 / (c * rows),
            standardization=False,
        ),
        weights="balanced",
        centred=True,
    )


def forest_classifier(
    trees: int = 100, depth: int = 10, seed: int = 42, weights: str = "ratio", **params
) -> ModelConfig:
    return ModelConfig(
        "Random Forest",
        "flag",
        lambda features, label: RandomForestClassifier(
            featuresCol=features,
            labelCol=label,
            weightCol=WEIGHT,
            numTrees=trees,
            maxDepth=depth,
            seed=seed,
            **KEEP_NODES | params,
        ),
        weights=weights,
        # From rows of one class the forest would count one, and have no score of the other.
        two_classes=True,
    )


def deep_forest_classifier(**params) -> ModelConfig:
    return forest_classifier(200, 12, weights="balanced", **{"minInstancesPerNode": 5} | params)


def standard_configs() -> list[ModelConfig]:
    return [linear(), forest_regressor(), logistic(), forest_classifier()]


def preparation(spec: PanelSpec, numeric: Sequence[str], centred: bool = False) -> Pipeline:
    """Category index, one-hot, assembly, scaling.

    An entity not seen in training gets an all-zero one-hot vector. By default everything
    is scaled to unit sample deviation without centring, which keeps one-hots sparse.
    ``centred`` scales the numeric inputs only, around their means.
    """
    index, onehot = f"{spec.entity}_idx", f"{spec.entity}_vec"
    encode = [
        StringIndexer(inputCol=spec.entity, outputCol=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=[index], outputCols=[onehot]),
    ]
    if centred:
        return Pipeline(
            stages=encode
            + [
                VectorAssembler(inputCols=list(numeric), outputCol="numeric"),
                StandardScaler(
                    inputCol="numeric", outputCol="scaled", withMean=True, withStd=True
                ),
                VectorAssembler(inputCols=[*numeric, onehot], outputCol=RAW),
                VectorAssembler(inputCols=["scaled", onehot], outputCol=FEATURES),
            ]
        )
    return Pipeline(
        stages=encode
        + [
            VectorAssembler(inputCols=[*numeric, onehot], outputCol=RAW),
            StandardScaler(inputCol=RAW, outputCol=FEATURES, withMean=False, withStd=True),
        ]
    )


def positive_score(probability: str = "probability"):
    """Score of class 1: the model's share of votes or logistic value, not calibrated."""
    return vector_to_array(F.col(probability))[1]


def input_names(prepared: DataFrame) -> list[str]:
    """Names of the vector slots in order; only the unscaled vector carries them."""
    groups = prepared.schema[RAW].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for g in groups for a in g), key=lambda a: a["idx"])
    return [a["name"] for a in slots]


def importances(model: Transformer, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, importance) of a fitted forest."""
    values = model.featureImportances.toArray()
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances for {len(names)} inputs")
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


INPUTS = "spec string, num_cols array<string>, cat_cols array<string>, manifest string"


@dataclass(frozen=True)
class Manifest:
    """What a stored model was made of: the pipeline's name, the types of its input columns, a
    fingerprint of its training rows, and the settings of its last stage."""

    uid: str
    types: dict[str, str]
    rows: str
    settings: dict[str, str]

    def check_rows(self, rows: DataFrame) -> None:
        """Fails unless `rows` has every input column with the type it was trained on."""
        found = {f.name: f.dataType.simpleString() for f in rows.schema}
        wrong = [f"{c} {t} (found {found.get(c, 'none')})" for c, t in self.types.items() if found.get(c) != t]
        if wrong:
            raise ValueError(f"the model was trained on other columns: {', '.join(wrong)}")


def manifest(model: PipelineModel, train: DataFrame, spec: PanelSpec, numeric: Sequence[str], rows: str) -> Manifest:
    """``rows`` is the fingerprint of the training rows, see :meth:`TrainingSet.rows_fingerprint`."""
    types = {f.name: f.dataType.simpleString() for f in train.schema if f.name in {*numeric, spec.entity}}
    settings = {p.name: str(v) for p, v in model.stages[-1].extractParamMap().items()}
    return Manifest(model.uid, types, rows, settings)


def save_model(
    model: PipelineModel,
    path: str,
    spec: PanelSpec,
    numeric: Sequence[str],
    spark: SparkSession,
    made_of: Manifest | None = None,
) -> None:
    """The fitted pipeline with the spec and input columns it was trained on beside it, and its
    manifest if there is one. What was saved there before is replaced."""
    model.write().overwrite().save(f"{path}/model")
    text = None if made_of is None else json.dumps(asdict(made_of), sort_keys=True)
    spark.createDataFrame(
        [(spec.to_json(), list(numeric), [spec.entity], text)], INPUTS
    ).coalesce(1).write.mode("overwrite").json(f"{path}/inputs")


def load_model(path: str, spark: SparkSession) -> tuple[PipelineModel, PanelSpec, list[str]]:
    """Read a saved pipeline back and check that it takes the recorded inputs."""
    model, spec, numeric, _ = _load(path, spark)
    return model, spec, numeric


def load_checked(
    path: str, spark: SparkSession, spec: PanelSpec, rows: DataFrame | None = None, trained_on: str | None = None
) -> PipelineModel:
    """A saved pipeline that fits its use, else an error: it has a manifest, was trained for ``spec``, takes the
    columns of ``rows`` with their types, and was trained on the rows of that fingerprint."""
    model, saved, _, made_of = _load(path, spark)
    if made_of is None:
        raise ValueError(f"the model at {path} has no manifest")
    if saved != spec:
        raise ValueError(f"the model at {path} was trained for another spec")
    if rows is not None:
        made_of.check_rows(rows)
    if trained_on is not None and made_of.rows != trained_on:
        raise ValueError(f"the model at {path} was trained on other rows")
    return model


def _load(path: str, spark: SparkSession) -> tuple[PipelineModel, PanelSpec, list[str], Manifest | None]:
    model = PipelineModel.load(f"{path}/model")
    inputs = spark.read.schema(INPUTS).json(f"{path}/inputs").first()
    assembled = [
        c
        for stage in model.stages
        if isinstance(stage, VectorAssembler)
        for c in stage.getInputCols()
    ]
    missing = [c for c in inputs["num_cols"] if c not in assembled]
    if missing:
        raise ValueError(f"the model at {path} does not use {missing}")
    made_of = Manifest(**json.loads(inputs["manifest"])) if inputs["manifest"] else None
    if made_of is not None and made_of.uid != model.uid:
        raise ValueError(f"the manifest at {path} is of another model")
    return model, PanelSpec.from_json(inputs["spec"]), list(inputs["num_cols"]), made_of
