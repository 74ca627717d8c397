"""Split by time and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.features import feature_names
from panelcast.spec import PanelSpec

WEIGHT = "w"


def time_split(features: DataFrame, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    """Rows up to and after the last training year; never a random split.

    The cut is on the ``year`` column of the feature table, so a table written by year is
    read only where it is needed.
    """
    cut = spec.last_train_year
    return features.where(F.col("year") <= cut), features.where(F.col("year") > cut)


def split_counts(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per side of the split: rows, first and last day."""
    side = F.when(F.col("year") <= spec.last_train_year, "train").otherwise("test")
    return features.groupBy(side.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(spec.day).alias("first_day"),
        F.max(spec.day).alias("last_day"),
    )


def feature_list(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """(position, feature, kind, filled) of the model inputs, found by exclusion."""
    numeric = feature_names(features.columns, spec)
    inputs = [(c, "numeric") for c in numeric] + [(spec.entity, "category")]
    counts = features.agg(*[F.count(c).alias(f"c{i}") for i, (c, _) in enumerate(inputs)])
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(c).alias("feature"),
            F.lit(kind).alias("kind"),
            F.col(f"c{i}").alias("filled"),
        )
        for i, (c, kind) in enumerate(inputs)
    ]
    return counts.select(F.inline(F.array(*lines)))


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """One row (pos, neg, ratio): ratio = neg/pos, NULL when there is no positive row."""
    counts = train.agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        (F.count(F.lit(1)) - F.count_if(F.col(label) == 1)).alias("neg"),
    )
    return counts.withColumn("ratio", F.try_divide(F.col("neg"), F.col("pos")))


def balanced_weights(train: DataFrame, label: str) -> DataFrame:
    """(label, rows, weight) with weight n / (number of classes * rows of the class)."""
    counts = class_weights(train, label)
    present = (F.col("pos") > 0).cast("int") + (F.col("neg") > 0).cast("int")
    lines = [
        F.struct(
            F.lit(value).alias(label),
            F.col(side).alias("rows"),
            F.try_divide(F.col("pos") + F.col("neg"), present * F.col(side)).alias("weight"),
        )
        for value, side in ((0, "neg"), (1, "pos"))
    ]
    return counts.select(F.inline(F.array(*lines))).where("rows > 0")


def _class_counts(train: DataFrame, label: str, one_class: bool):
    counts = class_weights(train, label).first()
    found = (counts["pos"] > 0) + (counts["neg"] > 0)
    if found < (1 if one_class else 2):
        raise ValueError(f"both classes of {label} need rows: {counts.asDict()}")
    return counts


def with_class_weight(train: DataFrame, label: str, one_class: bool = False) -> DataFrame:
    """Add ``w``: neg/pos on positive rows, 1 on the others.

    The two counts are one small job; a class without rows is an error unless ``one_class``.
    Positive rows alone then weigh neg/pos = 0, negative rows alone 1.
    """
    counts = _class_counts(train, label, one_class)
    ratio = counts["neg"] / counts["pos"] if counts["pos"] else None
    return train.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(ratio).cast("double")).otherwise(F.lit(1.0)))


def with_balanced_weight(train: DataFrame, label: str, one_class: bool = False) -> DataFrame:
    """Add ``w`` = n / (classes * rows of the row's class). A class without rows is an error
    unless ``one_class``; rows of the other one then weigh 1."""
    counts = _class_counts(train, label, one_class)
    share = (counts["pos"] + counts["neg"]) / ((counts["pos"] > 0) + (counts["neg"] > 0))
    weight = [share / counts[side] if counts[side] else None for side in ("pos", "neg")]
    return train.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(weight[0]).cast("double")).otherwise(F.lit(weight[1]).cast("double")))
