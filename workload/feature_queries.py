"""Panel, lag, rolling, delta and target columns, splits and class weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.scalar import any_missing, split_tag
from panelcast.operators import features as feats
from panelcast.operators import split
from panelcast.operators.features import build_features, scoring_features
from panelcast.operators.summary import counts_by
from panelcast.operators.windows import along_days
from panelcast.plans.scoring import model_inputs
from workload import sql
from workload.comparable import comparable, sql_select
from workload.panels import SPEC, nation_panel, status_panel
from workload.registry import query


def _along(panel, build):
    made = along_days(panel, SPEC.entity, SPEC.day, build, SPEC.lookback, SPEC.horizon)
    added = [c for c in made.columns if c not in SPEC.measures]
    return comparable(made.select(*added))


def training_features(spark, sf_dir):
    return build_features(status_panel(spark, sf_dir), SPEC)


@query(sql.on_panel(f"entity:s day:t {sql.MEASURES}", "panel"))
def panel_daily(spark, sf_dir):
    return comparable(status_panel(spark, sf_dir))


@query(
    f"WITH {sql.NATION_PANEL} " + sql_select(f"entity:s day:t {sql.MEASURES}", "panel")
)
def nation_panel_daily(spark, sf_dir):
    return comparable(nation_panel(spark, sf_dir))


@query(
    f"WITH {sql.NATION_PANEL}, {sql.WINDOWED}, {sql.FEATURES} "
    + sql_select(sql.TRAINING, "features")
)
def nation_feature_table(spark, sf_dir):
    return comparable(build_features(nation_panel(spark, sf_dir), SPEC))


@query(sql.on_features(sql.TRAINING))
def feature_table(spark, sf_dir):
    return comparable(training_features(spark, sf_dir))


@query(sql.on_features(sql.TRAINING))
def feature_table_chunked(spark, sf_dir):
    return comparable(build_features(status_panel(spark, sf_dir), SPEC, chunk_days=64))


@query(
    sql.on_windowed(
        sql.SCORING + " complete:i",
        "(SELECT *, CASE WHEN price_mean_lag2 IS NULL THEN 0 ELSE 1 END AS complete "
        "FROM windowed)",
    )
)
def feature_table_scoring(spark, sf_dir):
    table = scoring_features(status_panel(spark, sf_dir), SPEC)
    missing = any_missing(model_inputs(table.columns, SPEC))
    return comparable(table.withColumn("complete", F.when(missing, 0).otherwise(1)))


@query(sql.on_windowed(f"entity:s day:t {sql.LAGS}"))
def lag_features(spark, sf_dir):
    return _along(status_panel(spark, sf_dir), lambda w: feats.lag_columns(SPEC, w))


@query(sql.on_windowed(f"entity:s day:t {sql.ROLLINGS}"))
def rolling_features(spark, sf_dir):
    return _along(status_panel(spark, sf_dir), lambda w: feats.rolling_columns(SPEC, w))


@query(sql.on_windowed("entity:s day:t tax_change:d"))
def day_delta(spark, sf_dir):
    return _along(status_panel(spark, sf_dir), lambda w: feats.delta_columns(SPEC, w))


@query(
    sql.on_windowed(
        f"entity:s day:t {sql.TARGETS}",
        "(SELECT entity, day, price_tomorrow, COALESCE(high_qty_tomorrow, -1) "
        "AS high_qty_tomorrow FROM windowed)",
    )
)
def lead_targets(spark, sf_dir):
    made = _along(status_panel(spark, sf_dir), lambda w: feats.target_columns(SPEC, w))
    return made.na.fill(-1, ["high_qty_tomorrow"])


@query(
    sql.on_features(
        "year:i count:i", "(SELECT year, count(*) AS count FROM features GROUP BY 1)"
    )
)
def rows_per_year(spark, sf_dir):
    return comparable(counts_by(training_features(spark, sf_dir), "year").orderBy("year"))


@query(
    sql.on_features(
        "high_qty_tomorrow:i count:i",
        "(SELECT high_qty_tomorrow, count(*) AS count FROM features GROUP BY 1)",
    )
)
def class_balance(spark, sf_dir):
    return comparable(counts_by(training_features(spark, sf_dir), "high_qty_tomorrow"))


@query(
    sql.on_features(
        "part:s rows:i first_day:t last_day:t",
        "(SELECT CASE WHEN year <= 1999 THEN 'train' ELSE 'test' END AS part, "
        "count(*) AS rows, min(day) AS first_day, max(day) AS last_day "
        "FROM features GROUP BY 1)",
    )
)
def time_split_counts(spark, sf_dir):
    return comparable(split.split_counts(training_features(spark, sf_dir), SPEC))


@query(
    sql.on_panel(
        "entity:s day:t era:s",
        "(SELECT entity, day, CASE WHEN day >= DATE '2000-01-01' THEN 'Unseen test date' "
        "ELSE 'Training date' END AS era FROM panel)",
    )
)
def split_tags(spark, sf_dir):
    panel = status_panel(spark, sf_dir)
    tag = split_tag(F.col(SPEC.day), SPEC.last_train_year)
    return comparable(panel.select(*SPEC.key, tag.alias("era")))


_FEATURE_LIST = " UNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS feature, '{kind}' AS kind, "
    f"(SELECT count({name}) FROM features) AS filled"
    for i, (name, kind) in enumerate(
        [
            (c.split(":")[0], "numeric")
            for c in sql.SCORING.split()
            if c.split(":")[0] not in ("entity", "day", "year", "qty_sum")
        ]
        + [("entity", "category")],
        start=1,
    )
)


@query(sql.on_features("position:i feature:s kind:s filled:i", f"({_FEATURE_LIST})"))
def feature_list(spark, sf_dir):
    return comparable(split.feature_list(training_features(spark, sf_dir), SPEC))


_TRAIN = "train AS (SELECT *, high_qty_tomorrow AS y FROM features WHERE year <= 1999)"


def _train(spark, sf_dir):
    return split.time_split(training_features(spark, sf_dir), SPEC)[0]


@query(
    sql.on_features(
        "pos:i neg:i ratio:d",
        "(SELECT sum(y) AS pos, sum(1 - y) AS neg, sum(1 - y) / CAST(sum(y) AS DOUBLE) "
        "AS ratio FROM train)",
        _TRAIN,
    )
)
def class_weights(spark, sf_dir):
    return comparable(split.class_weights(_train(spark, sf_dir), "high_qty_tomorrow"))


@query(
    sql.on_features(
        "high_qty_tomorrow:i rows:i weight:d",
        "(SELECT y AS high_qty_tomorrow, count(*) AS rows, "
        "(SELECT count(*) FROM train) / (2.0 * count(*)) AS weight FROM train GROUP BY 1)",
        _TRAIN,
    )
)
def balanced_weights(spark, sf_dir):
    return comparable(split.balanced_weights(_train(spark, sf_dir), "high_qty_tomorrow"))


@query(
    sql.on_features(
        "high_qty_tomorrow:i rows:i weight:d",
        "(SELECT y AS high_qty_tomorrow, count(*) AS rows, sum(CASE WHEN y = 1 THEN "
        "(SELECT sum(1 - y) / CAST(sum(y) AS DOUBLE) FROM train) ELSE 1.0 END) AS weight "
        "FROM train GROUP BY 1)",
        _TRAIN,
    )
)
def class_weight_totals(spark, sf_dir):
    weighted = split.with_class_weight(_train(spark, sf_dir), "high_qty_tomorrow", one_class=True)
    return comparable(
        weighted.groupBy("high_qty_tomorrow").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(split.WEIGHT).alias("weight")
        )
    )
