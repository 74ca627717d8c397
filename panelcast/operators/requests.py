"""Lookups of (entity, day) requests in a panel, all as equi-joins.

Panel-sized sides are never broadcast by hint: adaptive execution broadcasts a side it has
measured to be small. Requests may share a day without limit; they are reduced to distinct
keys, counted, or joined by :func:`~panelcast.operators.skew.lookup_unique`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.skew import lookup_unique
from panelcast.spec import PanelSpec


def lookup(requests: DataFrame, table: DataFrame, spec: PanelSpec) -> DataFrame:
    """Requests with the columns of their (entity, day) row, NULL where there is none."""
    return lookup_unique(requests, table, spec.key)


def requested_entities(requests: DataFrame, table: DataFrame, spec: PanelSpec) -> DataFrame:
    """The rows of ``table`` whose entity is requested; safe below a window by entity."""
    wanted = requests.select(spec.entity).distinct()
    return table.join(wanted, spec.entity, "left_semi").select(*table.columns)


def unknown_entities(requests: DataFrame, panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """(entity, requests) for requested entities that the panel does not have.

    Requests are counted per entity before the join, so a much requested entity is one row.
    """
    asked = requests.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("requests"))
    return asked.join(panel.select(spec.entity).distinct(), spec.entity, "left_anti")


def all_entities_on_days(table: DataFrame, days: DataFrame, spec: PanelSpec) -> DataFrame:
    """Every entity's row on each requested day; entities without that day are skipped."""
    wanted = days.select(spec.day).distinct()
    return table.join(wanted, spec.day, "left_semi").select(*table.columns)


def trailing_history(
    requests: DataFrame,
    panel: DataFrame,
    spec: PanelSpec,
    days: int = 14,
    following: int = 0,
) -> DataFrame:
    """Panel rows of the ``days`` calendar days that end on each request's day.

    ``following`` adds that many days after it. Each request is spread over its days and
    joined on equality, so the work is bounded by requests x days and a hot entity is
    divided by day; a range join would pair all requests of an entity with its history.
    """
    asked = requests.select(spec.entity, F.col(spec.day).alias("request_day")).distinct()
    first, last = F.date_sub("request_day", days - 1), F.date_add("request_day", following)
    spread = asked.withColumn("history_day", F.explode(F.sequence(first, last)))
    history = panel.withColumnRenamed(spec.day, "history_day")
    return spread.join(history, [spec.entity, "history_day"], "inner")
