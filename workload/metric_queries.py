"""Baselines and metrics on the test years."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import baselines, metrics
from panelcast.operators.split import time_split
from panelcast.plans.training import baseline_rows, task_results
from workload import sql
from workload.comparable import comparable
from workload.feature_queries import training_features
from workload.panels import SPEC
from workload.registry import query

VALUE, FLAG = SPEC.value_target.alias, SPEC.flag_target.alias

_TEST = (
    "test AS (SELECT *, price_mean AS p, price_tomorrow AS t, high_qty_tomorrow AS y, "
    "CASE WHEN qty_mean >= 27 THEN 1 ELSE 0 END AS f, qty_mean / 50 AS score "
    "FROM features WHERE year > 1999)"
)
_REGRESSION = (
    "sqrt(avg((t - p) * (t - p))) AS \"RMSE\", avg(abs(t - p)) AS \"MAE\", "
    "1 - sum((t - p) * (t - p)) / (count(*) * var_pop(t)) AS \"R2\""
)


def _binary(positive: str) -> str:
    tp = f"count(*) FILTER (y = 1 AND {positive})"
    fp = f"count(*) FILTER (y = 0 AND {positive})"
    fn = f"count(*) FILTER (y = 1 AND NOT ({positive}))"
    tn = f"count(*) FILTER (y = 0 AND NOT ({positive}))"
    return (
        f"({tp} + {tn}) / CAST(count(*) AS DOUBLE) AS \"Accuracy\", "
        f"coalesce({tp} / CAST(nullif({tp} + {fp}, 0) AS DOUBLE), 0) AS \"Precision\", "
        f"coalesce({tp} / CAST(nullif({tp} + {fn}, 0) AS DOUBLE), 0) AS \"Recall\", "
        f"coalesce(2 * {tp} / CAST(nullif(2 * {tp} + {fp} + {fn}, 0) AS DOUBLE), 0) AS \"F1\""
    )


_BINARY_COLUMNS = "Accuracy:d Precision:d Recall:d F1:d"


def unseen_rows(spark, sf_dir):
    return time_split(training_features(spark, sf_dir), SPEC)[1]


@query(sql.on_features("RMSE:d MAE:d R2:d", f"(SELECT {_REGRESSION} FROM test)", _TEST))
def baseline_regression_metrics(spark, sf_dir):
    predicted = baselines.persistence_value(unseen_rows(spark, sf_dir), SPEC)
    return comparable(metrics.regression_metrics(predicted, VALUE, "prediction", digits=None))


@query(
    sql.on_features(
        "entity:s RMSE:d MAE:d R2:d",
        f"(SELECT entity, {_REGRESSION} FROM test GROUP BY entity)",
        _TEST,
    )
)
def regression_metrics_by_entity(spark, sf_dir):
    predicted = baselines.persistence_value(unseen_rows(spark, sf_dir), SPEC)
    return comparable(
        metrics.regression_metrics(predicted, VALUE, "prediction", by=["entity"], digits=None)
    )


@query(sql.on_features(_BINARY_COLUMNS, f"(SELECT {_binary('false')} FROM test)", _TEST))
def baseline_negative_metrics(spark, sf_dir):
    predicted = baselines.always_negative(unseen_rows(spark, sf_dir))
    return comparable(metrics.binary_metrics(predicted, FLAG, "prediction", digits=None))


@query(sql.on_features(_BINARY_COLUMNS, f"(SELECT {_binary('f = 1')} FROM test)", _TEST))
def baseline_persistence_metrics(spark, sf_dir):
    predicted = baselines.persistence_flag(unseen_rows(spark, sf_dir), SPEC)
    return comparable(metrics.binary_metrics(predicted, FLAG, "prediction", digits=None))


_NO_REGRESSION = (
    'CAST(NULL AS DOUBLE) AS "RMSE", CAST(NULL AS DOUBLE) AS "MAE", CAST(NULL AS DOUBLE) AS "R2"'
)
_NO_BINARY = ", ".join(
    f'CAST(NULL AS DOUBLE) AS "{m}"' for m in ("Accuracy", "Precision", "Recall", "F1")
)
_BASELINES = (
    f"(SELECT 'temperature' AS task, 'Baseline (tomorrow = today)' AS model, {_REGRESSION}, "
    f"{_NO_BINARY} FROM test UNION ALL "
    f"SELECT 'rain', 'Baseline (always dry)', {_NO_REGRESSION}, {_binary('false')} FROM test "
    f"UNION ALL SELECT 'rain', 'Baseline (rain today -> rain tomorrow)', {_NO_REGRESSION}, "
    f"{_binary('f = 1')} FROM test)"
)


ORACLE_BASELINES = sql.on_features(
    f"task:s model:s RMSE:d MAE:d R2:d {_BINARY_COLUMNS}", _BASELINES, _TEST
)


@query(ORACLE_BASELINES)
def baseline_leaderboard(spark, sf_dir):
    return comparable(baseline_rows(unseen_rows(spark, sf_dir), SPEC, digits=None))


@query(
    sql.on_features(f"model:s {_BINARY_COLUMNS}", f"{_BASELINES} WHERE task = 'rain'", _TEST)
)
def task_leaderboard(spark, sf_dir):
    rows = baseline_rows(unseen_rows(spark, sf_dir), SPEC, digits=None)
    return comparable(task_results(rows, "rain"))


@query(
    sql.on_features(
        "actual:s Dry:i Rain:i",
        "(SELECT 'Dry' AS actual, count(*) FILTER (y = 0 AND f = 0) AS \"Dry\", "
        "count(*) FILTER (y = 0 AND f = 1) AS \"Rain\" FROM test UNION ALL "
        "SELECT 'Rain', count(*) FILTER (y = 1 AND f = 0), count(*) FILTER (y = 1 AND f = 1) "
        "FROM test)",
        _TEST,
    )
)
def confusion_matrix(spark, sf_dir):
    predicted = baselines.persistence_flag(unseen_rows(spark, sf_dir), SPEC)
    return comparable(metrics.confusion_matrix(predicted, FLAG, "prediction"))


@query(
    sql.on_features(
        f"threshold:d {_BINARY_COLUMNS}",
        "("
        + " UNION ALL ".join(
            f"SELECT {t} AS threshold, {_binary(f'score >= CAST({t} AS DOUBLE)')} FROM test"
            for t in metrics.THRESHOLDS
        )
        + ")",
        _TEST,
    )
)
def threshold_sweep(spark, sf_dir):
    scored = unseen_rows(spark, sf_dir).withColumn("score", F.col("qty_mean") / 50)
    return comparable(metrics.threshold_sweep(scored, FLAG, "score", digits=None))
