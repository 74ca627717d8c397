"""Tables behind the cards, tiles and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import CARD_DAY, CARD_NEXT_DAY, HEADING_DAY, fixed
from panelcast.operators.features import ACTUAL_AMOUNT, ACTUAL_VALUE
from panelcast.operators.requests import all_entities_on_days, trailing_history
from panelcast.operators.sampling import sample_rows, top
from panelcast.spec import PanelSpec

# Tile names with the role they show, decimals and unit.
TILES = (
    ("Humidity", "humidity", 0, "%"),
    ("Wind (max)", "wind", 0, " km/h"),
    ("Pressure", "pressure", 0, " hPa"),
    ("Cloud cover", "cover", 0, "%"),
    ("Rain, 7 days", "amount_total", 0, " mm"),
    ("Pressure change", "pressure_change", 1, " hPa"),
)
# Names of the chart's series, texts of the cards and short lines.
HISTORY, PREDICTED, ACTUAL = "Last 14 days", "Predicted tomorrow", "Actual"
NO_ACTUAL = "No actual data for this day"
OBSERVED, DEGREES, RAIN = "Actual: ", "°C, ", " mm rain"
HIGH, LOW, DEGREE = "High ", "° · Low ", "°"
RAIN_SCORE, SCORE, DOT = "Rain score ", " · score ", " · "


def date_labels(df: DataFrame, day: str) -> DataFrame:
    """The day as the cards and the heading print it; the latter two for the next day."""
    following = F.date_add(day, 1)
    return df.select(
        *df.columns,
        F.date_format(day, CARD_DAY).alias("day_text"),
        F.date_format(following, CARD_NEXT_DAY).alias("next_day_text"),
        F.date_format(following, HEADING_DAY).alias("heading_text"),
    )


def _tile_text(name: Column, digits: int, unit: str, signed: bool) -> Column:
    return F.concat(fixed(name, digits, signed), F.lit(unit))


def tiles(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """(entity, day, tile, text): current conditions, six lines per feature row."""
    lines = [
        F.struct(
            F.lit(name).alias("tile"),
            _tile_text(
                F.col(getattr(spec.roles, role)), digits, unit, role == "pressure_change"
            ).alias("text"),
        )
        for name, role, digits, unit in TILES
    ]
    return rows.select(*spec.key, F.inline(F.array(*lines)))


def cards(scored: DataFrame, spec: PanelSpec) -> DataFrame:
    """The observed and the predicted card of each scored request, as text columns."""
    r = spec.roles
    actual = F.when(
        F.col(ACTUAL_VALUE).isNotNull(),
        F.concat(
            F.lit(OBSERVED),
            fixed(F.col(ACTUAL_VALUE), 1),
            F.lit(DEGREES),
            fixed(F.col(ACTUAL_AMOUNT), 1),
            F.lit(RAIN),
        ),
    ).otherwise(F.lit(NO_ACTUAL))
    return scored.where("status = 'ok'").select(
        *spec.key,
        F.date_format(spec.day, CARD_DAY).alias("observed_day"),
        fixed(F.col(r.level), 0).alias("observed_level"),
        F.col("today.label").alias("observed_condition"),
        F.col("today.style").alias("observed_style"),
        F.concat(
            F.lit(HIGH), fixed(F.col(r.high), 0), F.lit(LOW), fixed(F.col(r.low), 0),
            F.lit(DEGREE),
        ).alias("observed_foot"),
        F.date_format("next_day", CARD_NEXT_DAY).alias("predicted_day"),
        fixed(F.col("predicted"), 0).alias("predicted_level"),
        F.col("tomorrow.label").alias("predicted_condition"),
        F.col("tomorrow.style").alias("predicted_style"),
        F.concat(F.lit(RAIN_SCORE), fixed(F.col("score"), 2), F.lit(DOT), actual).alias(
            "predicted_foot"
        ),
        "era",
    )


def glance(scored: DataFrame, spec: PanelSpec) -> DataFrame:
    """One short line per entity for a scored day."""
    return scored.where("status = 'ok'").select(
        *spec.key,
        fixed(F.col("predicted"), 0).alias("level"),
        F.concat(F.col("tomorrow.label"), F.lit(SCORE), fixed(F.col("score"), 2)).alias(
            "text"
        ),
        F.col("tomorrow.style").alias("style"),
    )


def glance_requests(panel: DataFrame, days: DataFrame, spec: PanelSpec) -> DataFrame:
    """A request for every entity that has a row on the given days."""
    return all_entities_on_days(panel.select(*spec.key), days, spec)


def history_chart(
    requests: DataFrame,
    panel: DataFrame,
    spec: PanelSpec,
    scored: DataFrame | None = None,
    days: int = 14,
) -> DataFrame:
    """(entity, request_day, series, chart_day, value): history, actual and forecast points.

    History and the next day's actual come from one join.
    """
    level = spec.roles.level
    narrow = panel.select(*spec.key, F.col(level).alias("value"))
    points = trailing_history(requests, narrow, spec, days, following=1)
    series = F.when(F.col("history_day") > F.col("request_day"), ACTUAL).otherwise(HISTORY)
    chart = points.select(
        spec.entity,
        "request_day",
        series.alias("series"),
        F.col("history_day").alias("chart_day"),
        "value",
    )
    if scored is None:
        return chart
    forecast = scored.where(F.col("predicted").isNotNull()).select(
        spec.entity,
        F.col(spec.day).alias("request_day"),
        F.lit(PREDICTED).alias("series"),
        F.date_add(spec.day, 1).alias("chart_day"),
        F.col("predicted").alias("value"),
    )
    return chart.unionByName(forecast.distinct())


def actual_vs_predicted(
    predictions: DataFrame, spec: PanelSpec, rows: int = 2000, seed: int = 0, strict: bool = True
) -> DataFrame:
    """Sampled points of the scatter: (entity, day, actual, predicted). The draw depends on the keys
    only, so rows may be sampled before they are predicted."""
    named = predictions.select(
        *spec.key,
        F.col(spec.value_target.alias).alias("actual"),
        F.col("prediction").alias("predicted"),
    )
    return sample_rows(named, spec.key, rows, seed, strict)


def importance_bars(importance: DataFrame, rows: int = 10) -> DataFrame:
    return top(importance, "importance", "feature", rows)
