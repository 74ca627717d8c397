"""Forecasts that need no model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import flag_at_least
from panelcast.spec import PanelSpec


def persistence_value(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """Tomorrow's value is today's."""
    return features.withColumn("prediction", F.col(spec.value_target.column))


def persistence_flag(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """Tomorrow reaches the threshold when today does."""
    target = spec.flag_target
    flag = flag_at_least(F.col(target.column), target.threshold)
    return features.withColumn("prediction", flag.cast("double"))


def always_negative(features: DataFrame) -> DataFrame:
    """Tomorrow never reaches the threshold."""
    return features.withColumn("prediction", F.lit(0.0))
