"""Lookups of requested days, histories and actuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.scalar import yes_no
from panelcast.operators import requests as ops
from panelcast.operators.features import next_day_actual as next_day_actual_rows
from panelcast.operators.features import scoring_features
from panelcast.plans.reports import cards, glance, glance_requests
from panelcast.plans.reports import history_chart as history_chart_rows
from panelcast.plans.scoring import answer, decide, request_rows, requested_features
from panelcast.plans.store import panel_rows, scoring_rows
from workload import sql
from workload.comparable import comparable
from workload.panels import SPEC, month_starts, order_requests, status_panel, status_store
from workload.registry import query

_MONTHS = (
    "months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS day "
    "FROM orders)"
)
_ACTUAL = (
    "actual AS (SELECT a.entity, a.day, b.price_mean AS actual_value, "
    "b.qty_mean AS actual_amount FROM panel a LEFT JOIN panel b "
    "ON a.entity = b.entity AND b.day = a.day + 1)"
)


@query(
    sql.on_panel("entity:s day:t actual_value:d actual_amount:d", "actual", _ACTUAL)
)
def next_day_actual(spark, sf_dir):
    return comparable(next_day_actual_rows(status_panel(spark, sf_dir), SPEC))


@query(
    sql.on_panel(
        f"request_id:i entity:s day:t threshold:d {sql.MEASURES}",
        "(SELECT r.*, p.* EXCLUDE (entity, day) FROM requests r LEFT JOIN panel p "
        "ON r.entity = p.entity AND r.day = p.day)",
        sql.REQUESTS,
    )
)
def request_lookup(spark, sf_dir):
    requests = order_requests(spark, sf_dir)
    return comparable(ops.lookup(requests, status_panel(spark, sf_dir), SPEC))


@query(
    sql.on_panel(
        "entity:s requests:i",
        "(SELECT entity, count(*) AS requests FROM requests WHERE entity NOT IN "
        "(SELECT entity FROM panel) GROUP BY 1)",
        sql.REQUESTS,
    )
)
def unknown_entities(spark, sf_dir):
    requests = order_requests(spark, sf_dir)
    return comparable(ops.unknown_entities(requests, status_panel(spark, sf_dir), SPEC))


@query(
    sql.on_windowed(
        f"{sql.SCORING}",
        "(SELECT w.* FROM windowed w WHERE day IN (SELECT day FROM months) "
        "AND price_mean_lag2 IS NOT NULL)",
        _MONTHS,
    )
)
def all_entities_on_days(spark, sf_dir):
    """Complete feature rows of every entity on the first of each month."""
    table = scoring_features(status_panel(spark, sf_dir), SPEC)
    rows = ops.all_entities_on_days(table, month_starts(spark, sf_dir), SPEC)
    return comparable(rows.na.drop("any"))


@query(
    sql.on_panel(
        f"entity:s request_day:t history_day:t {sql.MEASURES}",
        "(SELECT r.day AS request_day, p.day AS history_day, p.* EXCLUDE (day) FROM "
        "(SELECT DISTINCT entity, day FROM requests) r JOIN panel p ON p.entity = r.entity "
        "AND p.day <= r.day AND p.day > r.day - 14)",
        sql.REQUESTS,
    )
)
def trailing_14_days(spark, sf_dir):
    requests = order_requests(spark, sf_dir)
    return comparable(ops.trailing_history(requests, status_panel(spark, sf_dir), SPEC))


@query(
    sql.on_panel(
        "entity:s request_day:t series:s chart_day:t value:d",
        "(SELECT r.entity, r.day AS request_day, CASE WHEN p.day > r.day THEN 'Actual' "
        "ELSE 'Last 14 days' END AS series, p.day AS chart_day, p.price_mean AS value FROM "
        "(SELECT DISTINCT entity, day FROM requests) r JOIN panel p ON p.entity = r.entity "
        "AND p.day <= r.day + 1 AND p.day > r.day - 14)",
        sql.REQUESTS,
    )
)
def history_chart(spark, sf_dir):
    requests = order_requests(spark, sf_dir)
    return comparable(history_chart_rows(requests, status_panel(spark, sf_dir), SPEC))


def _stored(spark, sf_dir):
    return scoring_rows(status_store(spark, sf_dir), SPEC)


_ROWS = (
    "rows AS (SELECT r.*, w.price_mean, w.qty_sum_7d, w.price_mean_lag2, w.entity AS found, "
    "a.actual_value, a.actual_amount, "
    "CASE WHEN r.entity NOT IN (SELECT entity FROM panel) THEN 'unknown_entity' "
    "WHEN w.entity IS NULL THEN 'no_such_day' "
    "WHEN w.price_mean_lag2 IS NULL THEN 'insufficient_history' ELSE 'ok' END AS status "
    "FROM requests r LEFT JOIN windowed w ON r.entity = w.entity AND r.day = w.day "
    "LEFT JOIN actual a ON r.entity = a.entity AND r.day = a.day)"
)


@query(
    sql.on_windowed(
        "request_id:i entity:s day:t price_mean:d price_mean_lag2:d qty_sum_7d:d "
        "actual_value:d actual_amount:d status:s",
        "rows",
        _ACTUAL,
        sql.REQUESTS,
        _ROWS,
    )
)
def request_status(spark, sf_dir):
    requests = order_requests(spark, sf_dir)
    rows = request_rows(requests, None, SPEC, features=_stored(spark, sf_dir))
    return comparable(
        rows.select(
            "request_id", *SPEC.key, "price_mean", "price_mean_lag2", "qty_sum_7d",
            "actual_value", "actual_amount", "status",
        )
    )


@query(
    sql.on_windowed(
        "threshold:d decision:s requests:i",
        "(SELECT threshold, CASE WHEN qty_sum_7d / 350 >= threshold THEN 'YES' ELSE 'NO' END "
        "AS decision, count(*) AS requests FROM rows WHERE status = 'ok' GROUP BY 1, 2)",
        _ACTUAL,
        sql.REQUESTS,
        _ROWS,
    )
)
def threshold_decisions(spark, sf_dir):
    """Decisions per threshold, with the scaled 7-day sum as the score."""
    requests = order_requests(spark, sf_dir)
    rows = request_rows(requests, None, SPEC, features=_stored(spark, sf_dir)).where("status = 'ok'")
    decision = yes_no(F.col("qty_sum_7d") / 350 >= F.col("threshold"))
    return comparable(
        rows.groupBy("threshold", decision.alias("decision")).agg(
            F.count(F.lit(1)).alias("requests")
        )
    )


_DECIDED = (
    "decided AS (SELECT r.*, w.* EXCLUDE (entity, day), a.actual_value, a.actual_amount, "
    "CASE WHEN w.price_mean_lag2 IS NOT NULL THEN w.price_mean END AS predicted, "
    "CASE WHEN w.price_mean_lag2 IS NOT NULL THEN w.qty_mean / 50 END AS score, "
    "w.price_mean_lag2 IS NOT NULL AS usable "
    "FROM requests r LEFT JOIN windowed w ON r.entity = w.entity AND r.day = w.day "
    "LEFT JOIN actual a ON r.entity = a.entity AND r.day = a.day)"
)
_LABEL = (
    "CASE WHEN NOT usable THEN NULL WHEN {event} THEN 'Rain' WHEN line_mean >= 4.25 THEN "
    "'Cloudy' WHEN line_mean >= 3.5 THEN 'Partly cloudy' ELSE 'Clear sky' END"
)


def persistence_forecast(spark, sf_dir, requests=None):
    """Requests answered with today's level as forecast and the scaled amount as score."""
    requests = order_requests(spark, sf_dir) if requests is None else requests
    rows = requested_features(requests, None, SPEC, features=_stored(spark, sf_dir))
    usable = F.col("status") == "ok"
    forecast = rows.withColumns(
        {
            "predicted": F.when(usable, F.col(SPEC.roles.level)),
            "score": F.when(usable, F.col(SPEC.roles.amount) / 50),
        }
    )
    return decide(answer(requests, forecast, SPEC), SPEC)


@query(
    sql.on_windowed(
        "request_id:i entity:s day:t predicted:d score:d threshold:d decision:s today:s "
        "tomorrow:s era:s next_day:t actual_event:s",
        "(SELECT *, CASE WHEN usable THEN CASE WHEN score >= threshold THEN 'YES' ELSE 'NO' END "
        f"END AS decision, {_LABEL.format(event='qty_mean >= 27')} AS today, "
        f"{_LABEL.format(event='score >= threshold')} AS tomorrow, "
        "CASE WHEN day >= DATE '2000-01-01' THEN 'Unseen test date' ELSE 'Training date' END "
        "AS era, day + 1 AS next_day, CASE WHEN actual_amount >= 27 THEN 'rainy' "
        "WHEN actual_amount < 27 THEN 'dry' END AS actual_event FROM decided)",
        _ACTUAL,
        sql.REQUESTS,
        _DECIDED,
    )
)
def baseline_forecast(spark, sf_dir):
    decided = persistence_forecast(spark, sf_dir)
    return comparable(
        decided.select(
            "request_id", *SPEC.key, "predicted", "score", "threshold", "decision",
            F.col("today.label").alias("today"), F.col("tomorrow.label").alias("tomorrow"),
            "era", "next_day", "actual_event",
        )
    )


@query(
    sql.on_windowed(
        "entity:s day:t observed_day:s observed_level:s observed_condition:s observed_foot:s "
        "predicted_day:s predicted_level:s predicted_condition:s predicted_foot:s",
        "(SELECT entity, day, strftime(day, '%a, %d %b %Y') AS observed_day, "
        "printf('%.0f', price_mean) AS observed_level, "
        f"{_LABEL.format(event='qty_mean >= 27')} AS observed_condition, "
        "printf('High %.0f° · Low %.0f°', price_max, price_min) "
        "AS observed_foot, strftime(day + 1, '%a, %d %b') AS predicted_day, "
        "printf('%.0f', predicted) AS predicted_level, "
        f"{_LABEL.format(event='score >= threshold')} AS predicted_condition, "
        "printf('Rain score %.2f · ', score) || CASE WHEN actual_value IS NULL "
        "THEN 'No actual data for this day' ELSE printf('Actual: %.1f°C, %.1f mm rain', "
        "actual_value, actual_amount) END AS predicted_foot "
        "FROM decided WHERE usable)",
        _ACTUAL,
        sql.REQUESTS,
        _DECIDED,
    )
)
def baseline_cards(spark, sf_dir):
    table = cards(persistence_forecast(spark, sf_dir), SPEC)
    return comparable(table.drop("observed_style", "predicted_style", "era"))


@query(
    sql.on_windowed(
        "entity:s day:t level:s text:s",
        "(SELECT entity, day, printf('%.0f', predicted) AS level, "
        f"{_LABEL.format(event='score >= threshold')} || printf(' · score %.2f', score) AS text FROM decided WHERE usable)",
        _ACTUAL,
        _MONTHS,
        "requests AS (SELECT entity, day, 0.5 AS threshold FROM panel WHERE day IN (SELECT day FROM months))",
        _DECIDED,
    )
)
def baseline_glance(spark, sf_dir):
    """The short line of every entity on the first of each month."""
    store = status_store(spark, sf_dir)
    requests = glance_requests(store, month_starts(spark, sf_dir), SPEC)
    return comparable(glance(persistence_forecast(spark, sf_dir, requests), SPEC).drop("style"))


@query(
    sql.on_windowed(
        "entity:s request_day:t series:s chart_day:t value:d",
        "(SELECT r.entity, r.day AS request_day, CASE WHEN p.day > r.day THEN 'Actual' "
        "ELSE 'Last 14 days' END AS series, p.day AS chart_day, p.price_mean AS value FROM "
        "(SELECT DISTINCT entity, day FROM requests) r JOIN panel p ON p.entity = r.entity "
        "AND p.day <= r.day + 1 AND p.day > r.day - 14 UNION ALL "
        "SELECT DISTINCT entity, day, 'Predicted tomorrow', day + 1, predicted FROM decided WHERE predicted IS NOT NULL)",
        _ACTUAL,
        sql.REQUESTS,
        _DECIDED,
    )
)
def baseline_chart(spark, sf_dir):
    """History, actual and forecast points of all requests."""
    panel = panel_rows(status_store(spark, sf_dir), SPEC)
    requests = order_requests(spark, sf_dir).select(*SPEC.key).distinct()
    return comparable(history_chart_rows(requests, panel, SPEC, persistence_forecast(spark, sf_dir)))
