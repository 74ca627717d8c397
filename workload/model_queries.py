"""Preparation, training, importances and batch forecasts."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelcast.operators.features import feature_names
from panelcast.operators.baselines import persistence_value
from panelcast.operators.metrics import confusion_matrix
from panelcast.operators.sampling import sample_rows, sample_rows_by
from panelcast.operators.split import WEIGHT, time_split, with_class_weight
from panelcast.operators.splits import best_split, equal_width_bins
from panelcast.plans import ensembles, models, reports, scoring, training
from panelcast.plans.certificates import certificate
from panelcast.plans.store import panel_rows, scoring_rows, training_rows
from panelcast.storage import fresh_path
from workload import sql
from workload.comparable import comparable
from workload.feature_queries import training_features
from workload.panels import (
    SPEC,
    catalogue,
    month_starts,
    nation_store,
    order_requests,
    status_store,
)
from workload.registry import query


def status_features(spark, sf_dir):
    """Training and test rows of the stored feature table."""
    return training_rows(status_store(spark, sf_dir), SPEC)


_TRAIN = "train AS (SELECT * FROM features WHERE year <= 1999)"
_INDEX = (
    "(SELECT entity, row_number() OVER (ORDER BY count(*) DESC, entity) - 1 AS slot, "
    "count(*) AS rows, (SELECT count(DISTINCT entity) FROM train) AS size "
    "FROM train GROUP BY 1)"
)


@query(sql.on_features("entity:s slot:i size:i rows:i", _INDEX, _TRAIN))
def category_encoding(spark, sf_dir):
    """Frequency-ordered category index and the one-hot vector it becomes."""
    train, _ = time_split(training_features(spark, sf_dir), SPEC)
    stages = models.preparation(SPEC, []).getStages()[:2]
    index = stages[0].fit(train)
    onehot = stages[1].fit(index.transform(train))
    encoded = onehot.transform(index.transform(train))
    parts = vector_to_array("entity_vec")
    return comparable(
        encoded.select(
            "entity",
            F.array_position(parts, 1.0).alias("hot"),
            F.size(parts).alias("size"),
        )
        .groupBy("entity", (F.col("hot") - 1).alias("slot"), "size")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    sql.on_features(
        "entity:s day:t price_mean:d tax_change:d month:d hot:d",
        "(SELECT entity, day, price_mean / (SELECT stddev_samp(price_mean) FROM train) "
        "AS price_mean, tax_change / (SELECT stddev_samp(tax_change) FROM train) "
        "AS tax_change, month / (SELECT stddev_samp(month) FROM train) AS month, "
        "CASE WHEN entity = 'AF' THEN 1 ELSE 0 END / "
        "(SELECT stddev_samp(CASE WHEN entity = 'AF' THEN 1 ELSE 0 END) FROM train) AS hot "
        "FROM features WHERE year > 1999)",
        _TRAIN,
    )
)
def scaled_inputs(spark, sf_dir):
    """Assembled inputs scaled by their training deviation, for the test years."""
    features = training_features(spark, sf_dir)
    train, test = time_split(features, SPEC)
    prepared = models.preparation(SPEC, feature_names(features.columns, SPEC)).fit(train)
    rows = prepared.transform(test)
    slots = {n: i for i, n in enumerate(models.input_names(rows))}
    values = vector_to_array(models.FEATURES)
    named = {"price_mean": "price_mean", "tax_change": "tax_change", "month": "month",
             "entity_vec_AF": "hot"}
    return comparable(
        rows.select(*SPEC.key, *[values[slots[n]].alias(a) for n, a in named.items()])
    )


@query(
    sql.on_features(
        "slope:d intercept:d r2:d",
        "(SELECT regr_slope(price_tomorrow, price_mean) AS slope, "
        "regr_intercept(price_tomorrow, price_mean) AS intercept, "
        "regr_r2(price_tomorrow, price_mean) AS r2 FROM train)",
        _TRAIN,
    )
)
def linear_fit_one_input(spark, sf_dir):
    """The linear estimator on today's value alone, where SQL has a closed form."""
    train, _ = time_split(training_features(spark, sf_dir), SPEC)
    level, label = SPEC.value_target.column, SPEC.value_target.alias
    rows = VectorAssembler(inputCols=[level], outputCol="x").transform(train)
    fitted = LinearRegression(featuresCol="x", labelCol=label, solver="normal").fit(
        rows.select("x", label)
    )
    summary = fitted.summary
    return comparable(
        spark.createDataFrame(
            [(float(fitted.coefficients[0]), float(fitted.intercept), float(summary.r2))],
            "slope double, intercept double, r2 double",
        )
    )


@query()
def model_leaderboard(spark, sf_dir):
    """Baselines and four models side by side, from one prepared training set."""
    features = status_features(spark, sf_dir)
    configs = [
        models.linear(),
        models.forest_regressor(),
        models.logistic(),
        models.forest_classifier(),
    ]
    return training.leaderboard(features, SPEC, configs).drop("seconds")


def _model_folder(spark, sf_dir):
    return f"{catalogue(spark).root}/models-{sf_dir.strip('/').replace('/', '-')}"


def _stored(spark, sf_dir, *configs):
    """Fitted once per application: several queries look at the same models."""
    with training.training_set(status_features(spark, sf_dir), SPEC) as data:
        folder = _model_folder(spark, sf_dir)
        return data.test, [training.fit_stored(data, c, folder) for c in configs]


def _forests(spark, sf_dir):
    return _stored(spark, sf_dir, models.forest_regressor(), models.forest_classifier())


@query()
def feature_importance_top10(spark, sf_dir):
    """The ten most important inputs of both forests."""
    _, fitted = _forests(spark, sf_dir)
    tables = [
        reports.importance_bars(models.importances(t.model.stages[-1], t.names, spark)).withColumn(
            "task", F.lit(t.config.task)
        )
        for t in fitted
    ]
    return tables[0].unionByName(tables[1])


POINTS = 2000


@query()
def actual_vs_predicted_sample(spark, sf_dir):
    """The points are drawn before they are predicted."""
    test, (regressor,) = _stored(spark, sf_dir, models.forest_regressor())
    drawn = sample_rows(test, SPEC.key, POINTS, strict=False)
    predicted = training.predict(regressor, drawn)
    return comparable(reports.actual_vs_predicted(predicted, SPEC, rows=POINTS, strict=False))


_DRAWN = "md5(entity || '|' || strftime(day, '%Y-%m-%d') || '|0')"


@query(
    sql.on_features(
        "entity:s day:t actual:d predicted:d",
        "(SELECT entity, day, price_tomorrow AS actual, price_mean AS predicted FROM features "
        f"WHERE year > 1999 ORDER BY {_DRAWN}, entity, day LIMIT {POINTS})",
    )
)
def baseline_vs_actual_sample(spark, sf_dir):
    """The same draw with today's level as the prediction."""
    _, test = time_split(status_features(spark, sf_dir), SPEC)
    return comparable(
        reports.actual_vs_predicted(persistence_value(test, SPEC), SPEC, rows=POINTS, strict=False)
    )


@query(
    sql.on_features(
        "entity:s day:t price_mean:d",
        "(SELECT * FROM features WHERE year > 1999 QUALIFY row_number() OVER "
        f"(PARTITION BY entity ORDER BY {_DRAWN}, day) <= 50)",
    )
)
def sample_per_entity(spark, sf_dir):
    """Fifty test rows of every entity."""
    _, test = time_split(status_features(spark, sf_dir), SPEC)
    drawn = sample_rows_by(test, [SPEC.entity], SPEC.key, 50)
    return comparable(drawn.select(*SPEC.key, SPEC.roles.level))


@query()
def model_confusion_matrix(spark, sf_dir):
    test, (classifier,) = _stored(spark, sf_dir, models.forest_classifier())
    return confusion_matrix(
        training.predict(classifier, test), SPEC.flag_target.alias, "prediction"
    )


def _scored(spark, sf_dir, requests):
    _, (value, flag) = _forests(spark, sf_dir)
    features = scoring_rows(status_store(spark, sf_dir), SPEC)
    return scoring.score(requests, None, SPEC, value.model, flag.model, features=features)


@query()
def batch_forecast(spark, sf_dir):
    """Every order's request scored in one batch."""
    scored = _scored(spark, sf_dir, order_requests(spark, sf_dir))
    return comparable(
        scored.select(
            "request_id", *SPEC.key, "status", "predicted", "score", "threshold", "decision",
            F.col("today.label").alias("today"), F.col("tomorrow.label").alias("tomorrow"),
            "era", "next_day", "actual_value", "actual_amount", "actual_event",
        )
    )


@query()
def forecast_cards(spark, sf_dir):
    return comparable(
        reports.cards(_scored(spark, sf_dir, order_requests(spark, sf_dir)), SPEC)
    )


@query()
def all_entities_glance(spark, sf_dir):
    """Forecast of every entity on the first of each month."""
    panel = status_store(spark, sf_dir)
    requests = reports.glance_requests(panel, month_starts(spark, sf_dir), SPEC)
    return comparable(reports.glance(_scored(spark, sf_dir, requests), SPEC))


@query()
def forecast_chart(spark, sf_dir):
    """History, forecast and actual points of all requests."""
    requests = order_requests(spark, sf_dir).select(*SPEC.key).distinct()
    scored = _scored(spark, sf_dir, requests)
    return comparable(
        reports.history_chart(requests, panel_rows(status_store(spark, sf_dir), SPEC), SPEC, scored)
    )


@query(
    sql.on_features(
        "rows:i differing:i", "(SELECT count(*) AS rows, 0 AS differing FROM features WHERE year > 1999)"
    )
)
def model_roundtrip(spark, sf_dir):
    """Forecasts of a model that was saved and loaded with its manifest checked, against those of
    the original."""
    config = models.forest_regressor()
    with training.training_set(status_features(spark, sf_dir), SPEC) as data:
        regressor, test, made_from = training.fit(data, config), data.test, data.rows_fingerprint()
        made_of = models.manifest(regressor.model, data.train, SPEC, data.numeric, made_from)
    path = fresh_path(spark, "model")
    models.save_model(regressor.model, path, SPEC, feature_names(test.columns, SPEC), spark, made_of)
    loaded = models.load_checked(path, spark, SPEC, test, made_from)
    before = training.predict(regressor, test).select(*SPEC.key, F.col("prediction").alias("before"))
    after = loaded.transform(test).select(*SPEC.key, F.col("prediction").alias("after"))
    joined = before.join(after, SPEC.key)
    return joined.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differing"),
    )


def _train_eval(spark, sf_dir, config):
    features = training_rows(nation_store(spark, sf_dir), SPEC)
    return training.leaderboard(features, SPEC, [config], baselines=False).drop("seconds")


@query()
def train_eval_linear(spark, sf_dir):
    return _train_eval(spark, sf_dir, models.linear())


@query()
def train_eval_forest_regressor(spark, sf_dir):
    return _train_eval(spark, sf_dir, models.forest_regressor())


@query()
def train_eval_logistic(spark, sf_dir):
    return _train_eval(spark, sf_dir, models.logistic())


@query()
def train_eval_logistic_penalised(spark, sf_dir):
    features = training_rows(nation_store(spark, sf_dir), SPEC)
    rows = time_split(features, SPEC)[0].count()
    return training.leaderboard(
        features, SPEC, [models.penalised_logistic(rows)], baselines=False
    ).drop("seconds")


@query()
def train_eval_forest_classifier(spark, sf_dir):
    return _train_eval(spark, sf_dir, models.forest_classifier())


@query()
def train_eval_deep_forest_classifier(spark, sf_dir):
    features = status_features(spark, sf_dir)
    config = models.deep_forest_classifier()
    return training.leaderboard(features, SPEC, [config], baselines=False).drop("seconds")


@query("SELECT * FROM (VALUES ('Linear Regression', true), ('Logistic Regression', true)) AS t(model, timed)")
def model_seconds(spark, sf_dir):
    """Whether the leaderboard measured a time for each model."""
    features = status_features(spark, sf_dir)
    board = training.leaderboard(features, SPEC, [models.linear(), models.logistic()], baselines=False)
    return board.select("model", (F.col("seconds") > 0).alias("timed"))


TREES_PER_BATCH = 20
#: The statistics of a deep forest's many nodes are sent once per partition of the rows.
DEEP_PARTITIONS = 4


def _deep_build(trees, seed):
    return models.deep_forest_regressor(trees, seed, maxMemoryInMB=1024)


def _deep_forest(spark, sf_dir):
    """The deep forest and the test rows. Batches are kept with the stored tables, by what they
    were trained on, so only the first query of an application trains them."""
    features = status_features(spark, sf_dir)
    folder = f"{_model_folder(spark, sf_dir)}/deep-forest"
    with training.training_set(features, SPEC, partitions=DEEP_PARTITIONS) as data:
        forest, _ = ensembles.fit_in_batches(data, _deep_build, models.DEEP_TREES, TREES_PER_BATCH, folder)
        return data.test, forest


@query()
def train_eval_deep_forest_regressor(spark, sf_dir):
    """200 trees of depth 15 on all features, in batches."""
    test, forest = _deep_forest(spark, sf_dir)
    return training.evaluate(training.predict(forest, test), SPEC, "value", forest.config.name)


@query(
    sql.on_features(
        "batches:i trees:i rows:i unequal:i",
        "(SELECT 10 AS batches, 200 AS trees, count(*) AS rows, 0 AS unequal FROM features WHERE year > 1999)",
    )
)
def deep_forest_mean(spark, sf_dir):
    """Test rows whose prediction is not the mean over the stored batches."""
    test, forest = _deep_forest(spark, sf_dir)
    columns = ensembles.batch_columns(forest.model)
    mean = sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns)
    unequal = F.abs(F.col("prediction") - mean) > 1e-9 * F.abs(mean)
    trees = sum(s.getNumTrees for s in forest.model.stages if hasattr(s, "getNumTrees"))
    rows = training.predict(forest, test)
    return rows.agg(
        F.lit(len(columns)).cast("long").alias("batches"),
        F.lit(trees).cast("long").alias("trees"),
        F.count("*").alias("rows"),
        F.count_if(unequal | F.col("prediction").isNull()).alias("unequal"),
    )


BINS = 31
_NUMERIC = [c.split(":")[0] for c in sql.TRAINING.split() if c.split(":")[0] not in SPEC.exclude]
#: Weight of a positive row, as the classifiers are trained with.
_RATIO = "(SELECT (count(*) - sum(high_qty_tomorrow)) / sum(high_qty_tomorrow) FROM train)"


def _stump_sql() -> str:
    binned = ", ".join(
        f"greatest(0, least({BINS - 1}, floor(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) * {BINS}))) AS {c}"
        for c in _NUMERIC
    )
    cells = " UNION ALL ".join(
        f"SELECT task, {i} AS slot, '{c}' AS feature, {c} AS value, y, w FROM labelled" for i, c in enumerate(_NUMERIC)
    )
    return sql.on_features(
        "task:s feature:s below:d above:d left_rows:i right_rows:i left_mean:d right_mean:d gain:d",
        "best",
        "train AS (SELECT * FROM features WHERE year <= 1999)",
        f"binned AS (SELECT {binned}, price_tomorrow, high_qty_tomorrow FROM train)",
        "labelled AS (SELECT *, 'value' AS task, price_tomorrow AS y, 1.0::DOUBLE AS w FROM binned UNION ALL "
        "SELECT *, 'flag', high_qty_tomorrow, CASE WHEN high_qty_tomorrow = 1 "
        f"THEN {_RATIO} ELSE 1.0 END FROM binned)",
        f"cells AS ({cells})",
        "counted AS (SELECT task, slot, feature, value, count(*) AS n, sum(w) AS w, sum(w * y) AS wy, "
        "sum(w * y * y) AS wyy FROM cells GROUP BY ALL)",
        "running AS (SELECT task, slot, feature, value AS below, lead(value) OVER o AS above, "
        + ", ".join(f"sum({c}) OVER o AS {c}_l, sum({c}) OVER (PARTITION BY task, slot) AS {c}_a" for c in ("n", "w", "wy", "wyy"))
        + " FROM counted WINDOW o AS (PARTITION BY task, slot ORDER BY value))",
        "gains AS (SELECT task, slot, feature, below, above, n_l AS left_rows, n_a - n_l AS right_rows, "
        "wy_l / w_l AS left_mean, (wy_a - wy_l) / (w_a - w_l) AS right_mean, "
        "1 - ((wyy_l - wy_l * wy_l / w_l) + (wyy_a - wyy_l - (wy_a - wy_l) * (wy_a - wy_l) / (w_a - w_l))) "
        "/ (wyy_a - wy_a * wy_a / w_a) AS gain FROM running WHERE above IS NOT NULL)",
        "best AS (SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY task ORDER BY gain DESC, slot, below) = 1)",
    )


def stump_table(features):
    """Training rows with binned inputs, and the names of these."""
    train, _ = time_split(features, SPEC)
    numeric = feature_names(train.columns, SPEC)
    return equal_width_bins(train, numeric, BINS), numeric


@query(_stump_sql())
def stump_split(spark, sf_dir):
    """The best first split of both tasks over binned inputs."""
    binned, numeric = stump_table(status_features(spark, sf_dir))
    value, flag = SPEC.value_target.alias, SPEC.flag_target.alias
    found = [
        best_split(binned, numeric, value).withColumn("task", F.lit("value")),
        best_split(with_class_weight(binned, flag, one_class=True), numeric, flag, WEIGHT).withColumn("task", F.lit("flag")),
    ]
    columns = ("task", "feature", "below", "above", "left_rows", "right_rows", "left_mean", "right_mean", "gain")
    return comparable(found[0].unionByName(found[1]).select(*columns))


def _inputs_sql(scaled: str) -> str:
    listed = ", ".join(f"('{c}')" for c in [*_NUMERIC, "intercept"])
    return sql.on_features(
        "input:s gradient:d",
        f"(SELECT input, 0.0 AS gradient FROM ((SELECT * FROM (VALUES {listed}) AS t(input)) "
        f"UNION ALL SELECT DISTINCT '{scaled}' || entity FROM features WHERE year <= 1999))",
    )


def _gradient(spark, sf_dir, config, digits):
    features = status_features(spark, sf_dir)
    with training.training_set(features, SPEC, [config.centred]) as data:
        table = certificate(data, training.fit(data, config))
    # Adding zero turns a negative zero into zero.
    return table.select("input", (F.round("relative", digits) + 0.0).alias("gradient"))


@query(_inputs_sql("entity_vec_"))
def linear_gradient(spark, sf_dir):
    """Orthogonality of the linear model's residuals to every input."""
    return _gradient(spark, sf_dir, models.linear(), 3)


@query(_inputs_sql("entity_vec_"))
def logistic_gradient(spark, sf_dir):
    return _gradient(spark, sf_dir, models.logistic(), 3)


@query(_inputs_sql("entity_vec_"))
def penalised_logistic_gradient(spark, sf_dir):
    """With the derivative of the penalty."""
    rows = time_split(status_features(spark, sf_dir), SPEC)[0].count()
    return _gradient(spark, sf_dir, models.penalised_logistic(rows), 3)


@query(
    sql.on_features(
        "task:s inputs:i total:d",
        f"(SELECT task, {len(_NUMERIC)} + (SELECT count(DISTINCT entity) FROM train) AS inputs, 1.0 AS total "
        "FROM (VALUES ('value'), ('flag')) AS t(task))",
        "train AS (SELECT * FROM features WHERE year <= 1999)",
    )
)
def importance_totals(spark, sf_dir):
    """Whether the importances of both forests name every input once and sum to one."""
    _, fitted = _forests(spark, sf_dir)
    tables = [
        models.importances(t.model.stages[-1], t.names, spark).withColumn("task", F.lit(t.config.task))
        for t in fitted
    ]
    both = tables[0].unionByName(tables[1])
    return comparable(
        both.groupBy("task").agg(
            F.count_distinct("feature").alias("inputs"), F.sum("importance").alias("total")
        )
    )


@query(
    sql.on_features(
        "entity:s day:t price_mean:d tax_change:d month:d hot:d",
        "(SELECT entity, day, "
        + ", ".join(
            f"({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_samp({c}) FROM train) AS {c}"
            for c in ("price_mean", "tax_change", "month")
        )
        + ", CASE WHEN entity = 'AF' THEN 1 ELSE 0 END AS hot FROM features WHERE year > 1999)",
        _TRAIN,
    )
)
def centred_inputs(spark, sf_dir):
    """The inputs of the penalised model, for the test years: numbers around their training
    means, categories as they are."""
    features = status_features(spark, sf_dir)
    train, test = time_split(features, SPEC)
    prepared = models.preparation(SPEC, feature_names(features.columns, SPEC), centred=True).fit(train)
    rows = prepared.transform(test)
    slots = {n: i for i, n in enumerate(models.input_names(rows))}
    values = vector_to_array(models.FEATURES)
    named = {"price_mean": "price_mean", "tax_change": "tax_change", "month": "month", "entity_vec_AF": "hot"}
    return comparable(rows.select(*SPEC.key, *[values[slots[n]].alias(a) for n, a in named.items()]))
