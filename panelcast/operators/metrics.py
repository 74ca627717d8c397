"""Model metrics as plain aggregates: one pass over the predictions, whatever their number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import slider_values

REGRESSION = ("RMSE", "MAE", "R2")
BINARY = ("Accuracy", "Precision", "Recall", "F1")
THRESHOLDS = tuple(slider_values(0.1, 0.9, 0.05))


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def regression_columns(label: str, prediction: str, digits: int | None = 3) -> dict[str, Column]:
    y, error = F.col(label), F.col(label) - F.col(prediction)
    known = F.when(error.isNotNull(), y)
    squares = F.sum(error * error)
    metrics = {
        "RMSE": F.sqrt(F.avg(error * error)),
        "MAE": F.avg(F.abs(error)),
        # A constant label has no variance to explain: 1 if all predictions are exact, else 0.
        "R2": F.when(F.var_pop(known) == 0, F.when(squares == 0, 1.0).otherwise(0.0)).otherwise(
            1 - F.try_divide(squares, F.count(known) * F.var_pop(known))
        ),
    }
    return {name: _rounded(m, digits) for name, m in metrics.items()}


def _binary_from_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return {
        "Accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "Precision": ratio(tp, tp + fp),
        "Recall": ratio(tp, tp + fn),
        "F1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def binary_columns(label: str, positive: Column, digits: int | None = 3) -> dict[str, Column]:
    """Metrics of class 1; every ratio with an empty denominator is 0."""
    actual = F.col(label) == 1
    metrics = _binary_from_counts(
        F.count_if(actual & positive),
        F.count_if(~actual & positive),
        F.count_if(actual & ~positive),
        F.count_if(~actual & ~positive),
    )
    return {name: _rounded(m, digits) for name, m in metrics.items()}


def _aggregate(df: DataFrame, columns: dict[str, Column], by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in columns.items()])


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = (), digits: int | None = 3
) -> DataFrame:
    return _aggregate(df, regression_columns(label, prediction, digits), by)


def binary_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = (), digits: int | None = 3
) -> DataFrame:
    return _aggregate(df, binary_columns(label, F.col(prediction) == 1, digits), by)


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, names: tuple[str, str] = ("Dry", "Rain")
) -> DataFrame:
    """(actual, <name 0>, <name 1>): rows counted by actual and predicted class.

    Both classes are listed even when one has no rows.
    """
    negative, positive = F.lit(names[0]), F.lit(names[1])
    cells = df.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"c{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    lines = [
        F.struct(
            name.alias("actual"),
            F.col(f"c{a}0").alias(names[0]),
            F.col(f"c{a}1").alias(names[1]),
        )
        for a, name in ((0, negative), (1, positive))
    ]
    return cells.select(F.inline(F.array(*lines)))


def threshold_sweep(
    df: DataFrame,
    label: str,
    score: str,
    thresholds: Sequence[float] = THRESHOLDS,
    digits: int | None = 3,
) -> DataFrame:
    """(threshold, Accuracy, Precision, Recall, F1) for ``score >= threshold``.

    Rows are counted by how many thresholds they reach, in one pass and without copying
    them; only those at most ``len(thresholds) + 1`` counts are spread over thresholds.
    """
    steps = [float(t) for t in sorted(thresholds)]
    reached = sum(((F.col(score) >= t).cast("int") for t in steps), F.lit(0))
    counts = df.groupBy(reached.alias("reached")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    spread = counts.select("*", F.posexplode(F.lit(steps)).alias("step", "threshold"))
    above = F.col("reached") > F.col("step")

    def total(side: str, inside: Column) -> Column:
        return F.sum(F.when(inside, F.col(side)).otherwise(0))

    cells = spread.groupBy("threshold").agg(
        total("pos", above).alias("tp"),
        total("neg", above).alias("fp"),
        total("pos", ~above).alias("fn"),
        total("neg", ~above).alias("tn"),
    )
    metrics = _binary_from_counts(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return cells.select(
        "threshold", *[_rounded(m, digits).alias(n) for n, m in metrics.items()]
    ).orderBy("threshold")
