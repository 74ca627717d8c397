"""Forests trained in batches of trees.

A large forest is several smaller ones whose seeds differ, so their trees are drawn apart from each
other as those of one forest are. Each batch is stored as soon as it is fitted, with a marker
that names what it was fitted on and how. A run that was broken off starts again at its first
batch without a matching marker, and statistics of a batch's nodes need only its share of
memory. The whole is a pipeline of ordinary stages: every batch adds its own prediction column, and
their mean, weighted by trees, is the prediction.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import RandomForestRegressionModel

from panelcast.plans.models import FEATURES, ModelConfig
from panelcast.plans.training import Trained, TrainingSet, fitting_rows, label_of, stored_stage

BATCH = "forest_batch_"
#: A configuration of so many trees with this seed.
Build = Callable[[int, int], ModelConfig]


def batch_sizes(trees: int, per_batch: int) -> list[int]:
    """Trees of each batch; the last may be smaller."""
    if trees < 1 or per_batch < 1:
        raise ValueError("a forest and its batches need trees")
    full, rest = divmod(trees, per_batch)
    return [per_batch] * full + [rest] * (rest > 0)


def batch_columns(model: PipelineModel) -> list[str]:
    """Prediction columns of the batches, in order."""
    return [s.getPredictionCol() for s in _batches(model)]


def _batches(model: PipelineModel) -> list[RandomForestRegressionModel]:
    found = [s for s in model.stages if isinstance(s, RandomForestRegressionModel)]
    return [s for s in found if s.getPredictionCol().startswith(BATCH)]


def fit_in_batches(
    data: TrainingSet, build: Build, trees: int, per_batch: int, path: str, seed: int = 42
) -> tuple[Trained, int]:
    """The averaged forest of `trees` trees, and how many batches were fitted now.

    `path` is a folder of the caller's in shared storage, which holds the batches; batches found there that
    were made from other rows or settings are replaced. Only forests for values are averaged:
    the mean of batches equals the mean of their trees.
    """
    started = time.monotonic()
    sizes = batch_sizes(trees, per_batch)
    configs = [build(size, seed + i) for i, size in enumerate(sizes)]
    if any(c.task != "value" for c in configs):
        raise ValueError("only forests for values are averaged")
    prep, names, _ = data.prepared[configs[0].centred]
    rows = fitting_rows(data, configs[0])
    made_of, fitted, stages = f"{data.rows_fingerprint()};{data.partitions}", 0, []
    label = label_of(data.spec, "value")
    for i, config in enumerate(configs):
        model, new = stored_stage(config.build(FEATURES, label), rows, f"{path}/batch-{i:04d}", made_of)
        stages.append(model.setPredictionCol(f"{BATCH}{i}"))
        fitted += new
    total = " + ".join(f"{BATCH}{i} * {size}" for i, size in enumerate(sizes))
    mean = SQLTransformer(statement=f"SELECT *, ({total}) / {trees} AS prediction FROM __THIS__")
    whole = PipelineModel([*prep.stages, *stages, mean])
    config = replace(configs[0], name=f"{configs[0].name} ({trees} trees)")
    return Trained(config, whole, names, time.monotonic() - started), fitted


def ensemble_importances(model: PipelineModel) -> list[float]:
    """Importances of the inputs over all trees: the batches' means, weighted by trees."""
    batches = _batches(model)
    trees = sum(b.getNumTrees for b in batches)
    parts = [b.featureImportances.toArray() * b.getNumTrees / trees for b in batches]
    return [float(v) for v in sum(parts)]

