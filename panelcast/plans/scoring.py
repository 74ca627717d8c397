"""Score a batch of (entity, day[, threshold]) requests for the next day."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import (
    any_missing,
    condition,
    rainy_dry,
    split_tag,
    yes_no,
)
from panelcast.operators.features import (
    ACTUAL_AMOUNT,
    ACTUAL_VALUE,
    feature_names,
    scoring_features,
)
from panelcast.operators.requests import lookup, requested_entities
from panelcast.plans.models import positive_score
from panelcast.spec import PanelSpec

OK, SHORT_HISTORY, NO_DAY, UNKNOWN = "ok", "insufficient_history", "no_such_day", "unknown_entity"


def model_inputs(columns: list[str], spec: PanelSpec) -> list[str]:
    """Numeric inputs among scoring columns, which carry actuals beside them."""
    return [c for c in feature_names(columns, spec) if c not in (ACTUAL_VALUE, ACTUAL_AMOUNT)]


def requested_features(
    requests: DataFrame,
    panel: DataFrame | None,
    spec: PanelSpec,
    chunk_days: int | None = None,
    features: DataFrame | None = None,
) -> DataFrame:
    """One row per requested (entity, day): features, the next day's actuals, ``status``.

    Only the requested entities go through the window. The day is not filtered below it,
    since the rows before and after belong to the frames. A day asked for many times is
    one row here, and the status is settled on these distinct keys. ``features`` can be a
    stored ``scoring_features(panel, spec, actuals=True)``, see :mod:`panelcast.plans.store`;
    then the panel is not read at all, and an entity is known if the table has it.
    """
    asked = requests.select(*spec.key).distinct()
    source = panel if features is None else features
    known = requested_entities(requests, source.select(spec.entity), spec).distinct()
    table = features
    if table is None:
        wanted = requested_entities(requests, panel, spec)
        table = scoring_features(wanted, spec, actuals=True, chunk_days=chunk_days)
    complete = ~any_missing(model_inputs(table.columns, spec))
    rows = asked.join(table.withColumn("complete", complete), spec.key, "left")
    rows = rows.join(known.withColumn("known", F.lit(True)), spec.entity, "left")
    status = (
        F.when(F.col("known").isNull(), UNKNOWN)
        .when(F.col("complete").isNull(), NO_DAY)
        .when(~F.col("complete"), SHORT_HISTORY)
        .otherwise(OK)
    )
    return rows.select(*table.columns, status.alias("status"))


def answer(
    requests: DataFrame, rows: DataFrame, spec: PanelSpec, default_threshold: float = 0.5
) -> DataFrame:
    """Every request with the row of its key; a request without entity or day is unknown."""
    if "threshold" not in requests.columns:
        requests = requests.withColumn("threshold", F.lit(default_threshold))
    return lookup(requests, rows, spec).na.fill(UNKNOWN, ["status"])


def request_rows(
    requests: DataFrame,
    panel: DataFrame | None,
    spec: PanelSpec,
    default_threshold: float = 0.5,
    chunk_days: int | None = None,
    features: DataFrame | None = None,
) -> DataFrame:
    """Requests with the features of their day, the next day's actuals and ``status``."""
    rows = requested_features(requests, panel, spec, chunk_days, features)
    return answer(requests, rows, spec, default_threshold)


def _keeping_incomplete(model: PipelineModel) -> PipelineModel:
    """The same model, but incomplete rows pass through instead of failing the batch."""
    stages = []
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            stage = stage.copy({stage.handleInvalid: "keep"})
        stages.append(stage)
    return PipelineModel(stages)


def apply_models(
    rows: DataFrame, value_model: PipelineModel, flag_model: PipelineModel
) -> DataFrame:
    """Add ``predicted`` and ``score``; NULL where the status is not ok."""
    columns, usable = rows.columns, F.col("status") == OK
    valued = _keeping_incomplete(value_model).transform(rows)
    valued = valued.select(*columns, F.when(usable, F.col("prediction")).alias("predicted"))
    scored = _keeping_incomplete(flag_model).transform(valued)
    return scored.select(
        *columns, "predicted", F.when(usable, positive_score()).alias("score")
    )


def decide(scored: DataFrame, spec: PanelSpec) -> DataFrame:
    """Decision, conditions, split tag and comparison with what happened.

    Tomorrow's condition combines the predicted event with today's cover.
    """
    r = spec.roles
    event = F.col("score") >= F.col("threshold")
    event_today = F.col(r.amount) >= spec.threshold
    usable = F.col("status") == OK

    def when_usable(column):
        return F.when(usable, column)

    return scored.select(
        *scored.columns,
        when_usable(yes_no(event)).alias("decision"),
        when_usable(condition(F.col(r.cover), event_today, spec.cover_bands)).alias("today"),
        when_usable(condition(F.col(r.cover), event, spec.cover_bands)).alias("tomorrow"),
        F.date_add(spec.day, 1).alias("next_day"),
        split_tag(F.col(spec.day), spec.last_train_year).alias("era"),
        F.when(
            F.col(ACTUAL_AMOUNT).isNotNull(), rainy_dry(F.col(ACTUAL_AMOUNT) >= spec.threshold)
        ).alias("actual_event"),
    )


def score(
    requests: DataFrame,
    panel: DataFrame | None,
    spec: PanelSpec,
    value_model: PipelineModel,
    flag_model: PipelineModel,
    default_threshold: float = 0.5,
    chunk_days: int | None = None,
    features: DataFrame | None = None,
) -> DataFrame:
    """One row per request with status, forecast, decision, labels and actuals.

    The models run once per requested (entity, day), however many requests share it.
    """
    rows = requested_features(requests, panel, spec, chunk_days, features)
    forecast = apply_models(rows, value_model, flag_model)
    return decide(answer(requests, forecast, spec, default_threshold), spec)
