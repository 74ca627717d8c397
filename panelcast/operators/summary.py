"""Summaries of a panel by entity, month and year, correlations and extents."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import flag_at_least, round_half_even
from panelcast.spec import PanelSpec

SUMMARY_NAMES = ("avg_level", "avg_humidity", "annual_amount", "event_days_pct")


def counts_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def event_balance(panel: DataFrame, spec: PanelSpec, name: str = "rainy") -> DataFrame:
    """How many days reach the threshold and how many do not."""
    flag = flag_at_least(F.col(spec.roles.amount), spec.threshold)
    return counts_by(panel, flag.alias(name))


def entity_summary_fixed_years(
    panel: DataFrame, spec: PanelSpec, n_years: int, names: Sequence[str] = SUMMARY_NAMES
) -> DataFrame:
    """Averages, yearly amount and event share per entity; ``n_years`` is given."""
    r = spec.roles
    flag = flag_at_least(F.col(r.amount), spec.threshold)
    return panel.groupBy(spec.entity).agg(
        F.round(F.avg(r.level), 1).alias(names[0]),
        F.round(F.avg(r.humidity), 1).alias(names[1]),
        F.round(F.sum(r.amount) / n_years, 0).alias(names[2]),
        F.round(F.avg(flag) * 100, 1).alias(names[3]),
    )


def entity_summary_seen_years(
    panel: DataFrame,
    spec: PanelSpec,
    names: Sequence[str] = SUMMARY_NAMES,
    days: DataFrame | None = None,
) -> DataFrame:
    """The same with the number of years found in the whole panel, all rounded half to even.

    The year count is a scalar subquery that reads the day column only. When the panel is
    itself an aggregate, ``days`` can name the rows it came from (with the same day
    column), so the panel is not built a second time for the count.
    """
    r = spec.roles
    flag = flag_at_least(F.col(r.amount), spec.threshold)
    years = n_years(panel if days is None else days, spec).scalar()
    totals = panel.groupBy(spec.entity).agg(
        F.avg(r.level).alias(names[0]),
        F.avg(r.humidity).alias(names[1]),
        F.sum(r.amount).alias("total"),
        (F.avg(flag) * 100).alias(names[3]),
    )
    return totals.select(
        spec.entity,
        round_half_even(F.col(names[0]), 1).alias(names[0]),
        round_half_even(F.col(names[1]), 1).alias(names[1]),
        round_half_even(F.col("total") / years, 1).alias(names[2]),
        round_half_even(F.col(names[3]), 1).alias(names[3]),
    )


def monthly_climatology(
    panel: DataFrame, spec: PanelSpec, names: tuple[str, str] = ("temp", "rain")
) -> DataFrame:
    r = spec.roles
    return (
        panel.groupBy(spec.entity, F.month(spec.day).alias("month"))
        .agg(F.avg(r.level).alias(names[0]), F.avg(r.amount).alias(names[1]))
        .orderBy(spec.entity, "month")
    )


def yearly_trend(panel: DataFrame, spec: PanelSpec, name: str = "temp") -> DataFrame:
    return (
        panel.groupBy(F.year(spec.day).alias("year"))
        .agg(F.avg(spec.roles.level).alias(name))
        .orderBy("year")
    )


def _pearson(a: str, b: str, complete: bool) -> Column:
    """Correlation over the rows where both values exist (neither NULL nor NaN); NULL for a
    constant column.

    The built-in ``corr`` divides by zero on constant columns in ANSI mode.
    """
    x, y = F.col(a), F.col(b)
    if not complete:
        both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
        x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(df: DataFrame, columns: Sequence[str], complete: bool = False) -> DataFrame:
    """(a, b, corr) for each unordered pair of columns, from a single aggregate row.

    ``complete`` states that no value is NULL or NaN: each column's deviation is then computed
    once instead of once per pair.
    """
    pairs = list(combinations(columns, 2))
    row = df.agg(*[_pearson(a, b, complete).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], complete: bool = False
) -> DataFrame:
    """One row per column with its correlation to every column.

    The diagonal is 1, or NULL for a column without variation.
    """
    order = list(columns)
    pairs = {frozenset(p): (f"p{i}", p) for i, p in enumerate(combinations(order, 2))}
    row = df.agg(
        *[_pearson(a, b, complete).alias(name) for name, (a, b) in pairs.values()],
        *[F.when(F.stddev_pop(c) > 0, 1.0).alias(f"d{i}") for i, c in enumerate(order)],
    )

    def cell(i: int, a: str, b: str) -> Column:
        return F.col(f"d{i}" if a == b else pairs[frozenset((a, b))][0]).alias(b)

    lines = [
        F.struct(F.lit(a).alias("column"), *[cell(i, a, b) for b in order])
        for i, a in enumerate(order)
    ]
    return row.select(F.inline(F.array(*lines)))


def extent(df: DataFrame, column: str) -> DataFrame:
    """One row (low, high)."""
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def valid_request_range(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """First and last day a forecast can be asked for; lags need the days before."""
    history = max((lag.rows for lag in spec.lags), default=0)
    return panel.agg(
        F.date_add(F.min(spec.day), history).alias("first_day"),
        F.max(spec.day).alias("last_day"),
    )


def n_years(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: the number of different calendar years."""
    return panel.agg(F.count_distinct(F.year(spec.day)).alias("years"))


def entity_list(panel: DataFrame, entity: str) -> DataFrame:
    return panel.select(entity).distinct().orderBy(entity)
