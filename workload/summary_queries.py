"""Entity, month and year summaries, correlations, extents, labels."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from panelcast.functions.scalar import condition, flag_at_least, parse_day, yes_no
from panelcast.operators import summary
from panelcast.operators.features import scoring_features
from panelcast.operators.split import time_split
from panelcast.plans import reports
from workload import sql
from workload.comparable import comparable, sql_select
from workload.feature_queries import training_features
from workload.panels import CORRELATED, SPEC, YEARS, ship_day, status_panel, table
from workload.registry import query


def _dec(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(22,8)), {digits}) AS DOUBLE)"


@query(
    sql.on_panel(
        "entity:s avg_level:d avg_humidity:d annual_amount:d event_days_pct:d",
        f"(SELECT entity, {_dec('avg(price_mean)', 1)} AS avg_level, "
        f"{_dec('avg(disc_mean)', 1)} AS avg_humidity, "
        f"{_dec('sum(qty_mean) / 7', 0)} AS annual_amount, "
        f"{_dec('avg(CASE WHEN qty_mean >= 27 THEN 1.0 ELSE 0.0 END) * 100', 1)} "
        "AS event_days_pct FROM panel GROUP BY 1)",
    )
)
def entity_summary_fixed_years(spark, sf_dir):
    panel = status_panel(spark, sf_dir)
    return comparable(summary.entity_summary_fixed_years(panel, SPEC, YEARS).orderBy("entity"))


@query(
    sql.on_panel(
        "entity:s avg_level:d avg_humidity:d annual_amount:d event_days_pct:d",
        f"(SELECT entity, {_dec('avg(price_mean)', 1)} AS avg_level, "
        f"{_dec('avg(disc_mean)', 1)} AS avg_humidity, "
        f"{_dec('sum(qty_mean) / (SELECT count(DISTINCT year(day)) FROM panel)', 1)} "
        "AS annual_amount, "
        f"{_dec('avg(CASE WHEN qty_mean >= 27 THEN 1.0 ELSE 0.0 END) * 100', 1)} "
        "AS event_days_pct FROM panel GROUP BY 1)",
    )
)
def entity_summary_seen_years(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").select(ship_day().alias(SPEC.day))
    panel = status_panel(spark, sf_dir)
    return comparable(summary.entity_summary_seen_years(panel, SPEC, days=days))


@query(
    sql.on_panel(
        "high:i count:i",
        "(SELECT CASE WHEN qty_mean >= 27 THEN 1 ELSE 0 END AS high, count(*) AS count "
        "FROM panel GROUP BY 1)",
    )
)
def event_balance(spark, sf_dir):
    return comparable(summary.event_balance(status_panel(spark, sf_dir), SPEC, "high"))


@query(
    sql.on_panel(
        "entity:s month:i temp:d rain:d",
        "(SELECT entity, month(day) AS month, avg(price_mean) AS temp, avg(qty_mean) AS rain "
        "FROM panel GROUP BY 1, 2)",
    )
)
def monthly_climatology(spark, sf_dir):
    return comparable(summary.monthly_climatology(status_panel(spark, sf_dir), SPEC))


@query(
    sql.on_panel(
        "year:i temp:d",
        "(SELECT year(day) AS year, avg(price_mean) AS temp FROM panel GROUP BY 1)",
    )
)
def yearly_trend(spark, sf_dir):
    return comparable(summary.yearly_trend(status_panel(spark, sf_dir), SPEC))


@query(
    sql.on_panel(
        "a:s b:s corr:d",
        "("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM panel"
            for a, b in combinations(CORRELATED, 2)
        )
        + ")",
    )
)
def correlations(spark, sf_dir):
    return comparable(summary.correlations(status_panel(spark, sf_dir), CORRELATED, complete=True))


#: Scoring features have NULLs where history is short; one more column gets NaN on some days.
MASKED = ("price_mean_lag1", "price_mean_lag2", "tax_change", "price_avg_7d", "qty_gaps")


@query(
    sql.on_windowed(
        "a:s b:s corr:d",
        "("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) FILTER (NOT isnan({a}) AND NOT isnan({b})) AS corr FROM gapped"
            for a, b in combinations(MASKED, 2)
        )
        + ")",
        "gapped AS (SELECT *, CASE WHEN day_of_year % 5 = 0 THEN 'NaN'::DOUBLE WHEN day_of_year % 5 = 1 THEN NULL "
        "ELSE qty_mean END AS qty_gaps FROM windowed)",
    )
)
def correlations_with_gaps(spark, sf_dir):
    """Each pair over the rows where both values exist."""
    place = F.col("day_of_year") % 5
    gaps = F.when(place == 0, float("nan")).when(place > 1, F.col("qty_mean"))
    rows = scoring_features(status_panel(spark, sf_dir), SPEC).withColumn("qty_gaps", gaps)
    return comparable(summary.correlations(rows, MASKED))


@query(
    sql.on_panel(
        "column:s " + " ".join(f"{c}:d" for c in CORRELATED),
        "("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS \"column\", "
            + ", ".join("1.0 AS " + b if a == b else f"corr({a}, {b}) AS {b}" for b in CORRELATED)
            + " FROM panel"
            for a in CORRELATED
        )
        + ")",
    )
)
def correlation_matrix(spark, sf_dir):
    return comparable(summary.correlation_matrix(status_panel(spark, sf_dir), CORRELATED))


@query(
    sql_select(
        "first_day:t last_day:t",
        "(SELECT CAST(min(l_shipdate) AS DATE) + 2 AS first_day, "
        "CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem)",
    )
)
def valid_request_range(spark, sf_dir):
    """Extents need no aggregation to days first; they come from the rows themselves."""
    days = table(spark, sf_dir, "lineitem").select(ship_day().alias(SPEC.day))
    return comparable(summary.valid_request_range(days, SPEC))


@query(
    sql.on_features(
        "low:d high:d",
        "(SELECT min(price_tomorrow) AS low, max(price_tomorrow) AS high FROM features "
        "WHERE year > 1999)",
    )
)
def target_extent(spark, sf_dir):
    _, test = time_split(training_features(spark, sf_dir), SPEC)
    return comparable(summary.extent(test, SPEC.value_target.alias))


@query("SELECT DISTINCT l_returnflag || l_linestatus AS entity FROM lineitem")
def entity_list(spark, sf_dir):
    entities = table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias(SPEC.entity)
    )
    return comparable(summary.entity_list(entities, SPEC.entity))


@query("SELECT count(DISTINCT year(l_shipdate)) AS years FROM lineitem")
def n_years(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").select(ship_day().alias(SPEC.day))
    return comparable(summary.n_years(days, SPEC))


_CONDITION = (
    "CASE WHEN qty_mean >= 27 THEN {0} WHEN line_mean >= 4.25 THEN {1} "
    "WHEN line_mean >= 3.5 THEN {2} ELSE {3} END"
)


@query(
    sql.on_panel(
        "entity:s day:t flag:i label:s style:s",
        "(SELECT entity, day, CASE WHEN qty_mean >= 27 THEN 1 ELSE 0 END AS flag, "
        + _CONDITION.format("'Rain'", "'Cloudy'", "'Partly cloudy'", "'Clear sky'")
        + " AS label, "
        + _CONDITION.format("'rain'", "'cloudy'", "'cloudy'", "'sunny'")
        + " AS style FROM panel)",
    )
)
def condition_labels(spark, sf_dir):
    r = SPEC.roles
    raining = F.col(r.amount) >= SPEC.threshold
    label = condition(F.col(r.cover), raining, SPEC.cover_bands)
    return comparable(
        status_panel(spark, sf_dir)
        .select(*SPEC.key, flag_at_least(F.col(r.amount), SPEC.threshold).alias("flag"),
                label.alias("condition"))
        .select(*SPEC.key, "flag", "condition.label", "condition.style")
    )


@query(
    sql.on_panel(
        "entity:s day:t day_text:s next_day_text:s heading_text:s",
        "(SELECT entity, day, strftime(day, '%a, %d %b %Y') AS day_text, "
        "strftime(day + 1, '%a, %d %b') AS next_day_text, "
        "strftime(day + 1, '%A, %d %b %Y') AS heading_text FROM panel)",
    )
)
def date_labels(spark, sf_dir):
    panel = status_panel(spark, sf_dir).select(*SPEC.key)
    return comparable(reports.date_labels(panel, SPEC.day))


_TILES = (
    ("Humidity", "disc_mean", "%.0f%%"),
    ("Wind (max)", "qty_max", "%.0f km/h"),
    ("Pressure", "tax_mean", "%.0f hPa"),
    ("Cloud cover", "line_mean", "%.0f%%"),
    ("Rain, 7 days", "qty_sum_7d", "%.0f mm"),
)


@query(
    sql.on_features(
        "entity:s day:t tile:s text:s",
        "("
        + " UNION ALL ".join(
            f"SELECT entity, day, '{name}' AS tile, printf('{text}', {c}) AS text "
            "FROM windowed"
            for name, c, text in _TILES
        )
        + " UNION ALL SELECT entity, day, 'Pressure change', "
        "CASE WHEN tax_change IS NOT NULL THEN "
        "printf('%+.1f hPa', tax_change) END FROM windowed)",
    )
)
def metric_tiles(spark, sf_dir):
    return comparable(reports.tiles(scoring_features(status_panel(spark, sf_dir), SPEC), SPEC))


@query(
    sql_select(
        "event_id:i day:t known:s",
        "(SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' "
        "ELSE strftime(ts, '%Y-%m-%d') END AS DATE) AS day, "
        "CASE WHEN event_type = 'error' THEN 'NO' ELSE 'YES' END AS known FROM events)",
    )
)
def parsed_days(spark, sf_dir):
    """Day texts, some of them unreadable."""
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    days = table(spark, sf_dir, "events").select("event_id", parse_day(text).alias("day"))
    return comparable(days.withColumn("known", yes_no(F.col("day").isNotNull())))
