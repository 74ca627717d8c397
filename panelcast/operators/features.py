"""Lag, lead, rolling and delta features: one definition for training and for scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelcast.functions.scalar import calendar_parts, flag_at_least
from panelcast.operators.windows import along_days
from panelcast.spec import PanelSpec

ACTUAL_VALUE, ACTUAL_AMOUNT = "actual_value", "actual_amount"


def lag_columns(spec: PanelSpec, window: WindowSpec) -> dict[str, Column]:
    return {x.alias: F.lag(x.column, x.rows).over(window) for x in spec.lags}


def rolling_columns(spec: PanelSpec, window: WindowSpec) -> dict[str, Column]:
    """Frames count rows, not calendar days; a short frame at the start is allowed."""
    reduce = {"avg": F.avg, "sum": F.sum}
    return {
        x.alias: reduce[x.fn](x.column).over(window.rowsBetween(1 - x.rows, Window.currentRow))
        for x in spec.rollings
    }


def delta_columns(spec: PanelSpec, window: WindowSpec) -> dict[str, Column]:
    return {x.alias: F.col(x.column) - F.lag(x.column, 1).over(window) for x in spec.deltas}


def target_columns(spec: PanelSpec, window: WindowSpec) -> dict[str, Column]:
    columns = {}
    for x in spec.targets:
        ahead = F.lead(x.column, x.horizon).over(window)
        columns[x.alias] = ahead if x.threshold is None else flag_at_least(ahead, x.threshold)
    return columns


def actual_columns(spec: PanelSpec, window: WindowSpec) -> dict[str, Column]:
    """Level and amount of the next *calendar* day, NULL when that day is missing.

    Days are unique per entity, so the next calendar day, if present, is the next row;
    the lookup needs no join.
    """
    is_next_day = F.lead(spec.day, 1).over(window) == F.date_add(spec.day, 1)
    return {
        name: F.when(is_next_day, F.lead(column, 1).over(window))
        for name, column in (
            (ACTUAL_VALUE, spec.roles.level),
            (ACTUAL_AMOUNT, spec.roles.amount),
        )
    }


def build_features(
    panel: DataFrame,
    spec: PanelSpec,
    targets: bool = True,
    drop_incomplete: bool = True,
    actuals: bool = False,
    chunk_days: int | None = None,
) -> DataFrame:
    """Panel columns plus calendar parts, lags, rolling values, deltas and targets.

    ``drop_incomplete`` removes rows with a NULL or NaN in any column: the first days
    (lags) and the last day (targets) of each entity.
    """

    def build(window: WindowSpec) -> dict[str, Column]:
        columns = calendar_parts(F.col(spec.day))
        columns |= lag_columns(spec, window) | rolling_columns(spec, window)
        columns |= delta_columns(spec, window)
        if targets:
            columns |= target_columns(spec, window)
        if actuals:
            columns |= actual_columns(spec, window)
        return columns

    lookahead = max(spec.horizon if targets else 0, 1 if actuals else 0)
    table = along_days(
        panel, spec.entity, spec.day, build, spec.lookback, lookahead, chunk_days
    )
    return table.na.drop("any") if drop_incomplete else table


def scoring_features(
    panel: DataFrame, spec: PanelSpec, actuals: bool = False, chunk_days: int | None = None
) -> DataFrame:
    """The same features without targets; rows with short history stay, marked by NULLs."""
    return build_features(
        panel, spec, targets=False, drop_incomplete=False, actuals=actuals, chunk_days=chunk_days
    )


def next_day_actual(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """(entity, day) with level and amount of the next calendar day."""
    r = spec.roles
    narrow = panel.select(*spec.key, r.level, r.amount)
    table = along_days(
        narrow, spec.entity, spec.day, lambda w: actual_columns(spec, w), 0, 1
    )
    return table.select(*spec.key, ACTUAL_VALUE, ACTUAL_AMOUNT)


def feature_names(columns: list[str], spec: PanelSpec) -> list[str]:
    """Numeric model inputs: every column of the feature table that is not excluded."""
    return [c for c in columns if c not in spec.exclude]
