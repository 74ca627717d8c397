"""Certificates of fitted linear and logistic models, from their stored predictions.

At the optimum, the weighted residuals are orthogonal to every input: for each one, the weighted mean of
(fitted - label) * input plus the derivative of the penalty is zero. This holds for squared loss
with its prediction and for logistic loss with its probability, and needs nothing from
the estimator but what it predicts and its coefficients where they are penalised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.split import WEIGHT
from panelcast.plans.models import FEATURES, positive_score
from panelcast.plans.training import Trained, TrainingSet, fitting_rows, label_of
from panelcast.storage import fresh_path

INTERCEPT = "intercept"


def fitted_values(data: TrainingSet, trained: Trained) -> DataFrame:
    """(x, y, w, fitted): the training rows as the estimator saw them, stored with what it
    fits to them."""
    label = label_of(data.spec, trained.config.task)
    rows = fitting_rows(data, trained.config)
    estimator = trained.model.stages[-1]
    made = PipelineModel([estimator]).transform(rows)
    fitted = F.col("prediction") if trained.config.task == "value" else positive_score()
    weight = F.col(WEIGHT) if trained.config.weights else F.lit(1.0)
    table = made.select(
        vector_to_array(FEATURES).alias("x"),
        F.col(label).cast("double").alias("y"),
        weight.alias("w"),
        fitted.alias("fitted"),
    )
    path = fresh_path(rows.sparkSession, "fitted")
    table.write.parquet(path)
    return rows.sparkSession.read.schema(table.schema).parquet(path)


def gradient(
    fitted: DataFrame, names: Sequence[str], coefficients: Sequence[float] | None = None, penalty: float = 0.0
) -> DataFrame:
    """(slot, input, gradient, scale, relative) for every input and the intercept.

    `fitted` has x, y, w and fitted, see :func:`fitted_values`. `gradient` is the weighted mean residual times the
    input, plus `penalty` times its coefficient; `scale` is the mean of the same products without
    their signs, so `relative` (their ratio) is 0 at the optimum and up to 1 far from it. An input
    that is 0 in all rows has relative 0. Each row spreads over its inputs and is summed up
    before the shuffle.
    """
    slots = [*names, INTERCEPT]
    residual = F.col("w") * (F.col("fitted") - F.col("y"))
    widened = fitted.select(residual.alias("r"), "w", F.posexplode(F.concat("x", F.array(F.lit(1.0)))).alias("slot", "v"))
    sums = widened.groupBy("slot").agg(
        (F.sum(F.col("r") * F.col("v")) / F.sum("w")).alias("mean"),
        (F.sum(F.abs(F.col("r") * F.col("v"))) / F.sum("w")).alias("spread"),
    )
    values = [*(coefficients if coefficients is not None else [0.0] * len(names)), 0.0]
    if len(values) != len(slots):
        raise ValueError(f"{len(values) - 1} coefficients for {len(names)} inputs")
    names_of = F.array(*[F.lit(n) for n in slots])
    pull = F.array(*[F.lit(penalty * float(v)) for v in values])
    return sums.select(
        "slot",
        F.get(names_of, F.col("slot")).alias("input"),
        (F.col("mean") + F.get(pull, F.col("slot"))).alias("gradient"),
        (F.col("spread") + F.abs(F.get(pull, F.col("slot")))).alias("scale"),
    ).withColumn("relative", F.coalesce(F.try_divide("gradient", "scale"), F.lit(0.0)))


def certificate(data: TrainingSet, trained: Trained) -> DataFrame:
    """The gradient of a linear or logistic model at its training rows."""
    estimator = trained.model.stages[-1]
    penalty = estimator.getRegParam()
    coefficients = estimator.coefficients.toArray().tolist()
    if penalty and estimator.getElasticNetParam():
        raise ValueError("only squared penalties have a derivative")
    if penalty and estimator.getStandardization():
        raise ValueError("the penalty must be on the coefficients as given")
    return gradient(fitted_values(data, trained), trained.names, coefficients, penalty)
