"""Sinks and sources: what was written must read back the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators.features import build_features
from panelcast.operators.split import time_split
from panelcast.plans.training import baseline_rows
from panelcast.sources import quarantine, readers, writers
from panelcast.storage import fresh_path
from workload import sql
from workload.comparable import comparable
from workload.metric_queries import ORACLE_BASELINES, unseen_rows
from workload.panels import SPEC, status_panel
from workload.registry import query

_PANEL = sql.on_panel(f"entity:s day:t {sql.MEASURES}", "panel")


@query(_PANEL)
def csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "panel-csv")
    writers.write_sorted_csv(status_panel(spark, sf_dir), path, SPEC)
    return comparable(readers.read_panel_csv(spark, path, SPEC))


@query(_PANEL)
def csv_roundtrip_inferred(spark, sf_dir):
    path = fresh_path(spark, "panel-csv")
    writers.write_csv(status_panel(spark, sf_dir), path)
    return comparable(readers.read_panel_csv(spark, path, SPEC, infer=True))


@query(
    sql.on_panel(
        f"entity:s entity_folder:s day:t {sql.MEASURES}",
        "(SELECT *, lower(entity) AS entity_folder FROM panel)",
    )
)
def csv_per_entity(spark, sf_dir):
    path = fresh_path(spark, "panel-by-entity")
    writers.write_per_entity(status_panel(spark, sf_dir), path, SPEC)
    schema = SPEC.schema().add("entity_folder", "string")
    return comparable(spark.read.schema(schema).option("header", True).csv(path))


@query(sql.on_features(sql.TRAINING, "(SELECT * FROM features WHERE year > 1999)"))
def parquet_roundtrip(spark, sf_dir):
    """Test years of the feature table written by year; the other years are not read."""
    features = build_features(status_panel(spark, sf_dir), SPEC)
    path = fresh_path(spark, "features")
    writers.write_features(features, path, SPEC)
    back = readers.read_panel_parquet(spark, path).select(*features.columns)
    return comparable(time_split(back, SPEC)[1])


@query(sql.on_features(sql.TRAINING))
def bucketed_feature_table(spark, sf_dir):
    """The panel stored in buckets by entity; the window then reads without a shuffle."""
    path = fresh_path(spark, "bucketed")
    name = "panel_" + path.rsplit("-", 1)[1]
    writers.write_bucketed(status_panel(spark, sf_dir), name, path, SPEC, buckets=8)
    return comparable(build_features(spark.table(name), SPEC))


@query(_PANEL)
def payload_explode(spark, sf_dir):
    """Payloads with parallel arrays, one per entity and year, written as JSON and read back.

    An array has at most 366 items.
    """
    items = F.array_sort(F.collect_list(F.struct("day", *SPEC.measures)))
    per_year = (
        status_panel(spark, sf_dir).groupBy("entity", F.year("day")).agg(items.alias("items"))
    )
    daily = F.struct(
        F.transform("items", lambda i: F.date_format(i["day"], "yyyy-MM-dd")).alias("time"),
        *[F.col(f"items.{m}").alias(m) for m in SPEC.measures],
    )
    path = fresh_path(spark, "payloads")
    per_year.select("entity", daily.alias("daily")).write.json(path)
    payloads = readers.read_payloads(spark, path, SPEC.measures, "entity", multi_line=False)
    return comparable(readers.payload_rows(payloads, SPEC.measures, SPEC))


@query(ORACLE_BASELINES)
def results_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "results")
    writers.write_results(baseline_rows(unseen_rows(spark, sf_dir), SPEC, digits=None), path)
    return comparable(writers.read_results(spark, path).drop("seconds"))


def _faulty_lines(spark, sf_dir):
    """The panel as CSV, with faults planted by day of year: a word for a number, an impossible day, a
    missing entity, and a line that is cut short."""
    kind = F.dayofyear("day") % 20
    cells = [F.col(c).cast("string").alias(c) for c in (*SPEC.key, *SPEC.measures)]
    texts = status_panel(spark, sf_dir).select(kind.alias("kind"), *cells)
    texts = texts.withColumns(
        {
            "qty_max": F.when(F.col("kind") == 1, "many").otherwise(F.col("qty_max")),
            "price_min": F.when(F.col("kind") == 1, "12..5").otherwise(F.col("price_min")),
            "day": F.when(F.col("kind") == 2, F.concat(F.substring("day", 1, 5), F.lit("13-40"))).otherwise(F.col("day")),
            "entity": F.when(F.col("kind") != 3, F.col("entity")),
        }
    )
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in (*SPEC.key, *SPEC.measures)])
    short = F.concat_ws(",", "entity", "day", F.lit("7"))
    header = ",".join((*SPEC.key, *SPEC.measures))
    path = fresh_path(spark, "faulty-csv")
    # Every part file begins with the header.
    parts = texts.select(F.substring("day", 1, 4).alias("part"), F.when(F.col("kind") == 4, short).otherwise(line).alias("line"))
    heads = parts.select("part", F.lit(header).alias("line")).distinct()
    rows = heads.withColumn("head", F.lit(0)).unionByName(parts.withColumn("head", F.lit(1)))
    rows = rows.repartition("part").sortWithinPartitions("part", "head")
    rows.select("line", "part").write.partitionBy("part").text(path)
    return f"{path}/*"


_CSV_FAULTS = (
    "faulty AS (SELECT *, dayofyear(day) % 20 AS kind, strftime(day, '%Y-%m-%d') AS text FROM panel), "
    "rejected AS (SELECT text AS day, 'qty_max' AS fault_in, 'not a number' AS reason, 'many' AS value FROM faulty WHERE kind = 1 "
    "UNION ALL SELECT text, 'price_min', 'not a number', '12..5' FROM faulty WHERE kind = 1 "
    "UNION ALL SELECT text[1:5] || '13-40', 'day', 'not a day', text[1:5] || '13-40' FROM faulty WHERE kind = 2 "
    "UNION ALL SELECT text, 'entity', 'missing', NULL FROM faulty WHERE kind = 3 "
    "UNION ALL SELECT text, NULL, 'malformed record', entity || ',' || text || ',7' FROM faulty WHERE kind = 4)"
)


@query(sql.on_panel("day:s fault_in:s reason:s value:s", "rejected", _CSV_FAULTS))
def rejected_rows(spark, sf_dir):
    """Every fault of a CSV panel with planted faults."""
    found = quarantine.read_panel_csv(spark, _faulty_lines(spark, sf_dir), SPEC).faults
    day = F.split_part("record", F.lit(","), F.lit(2))
    return found.select(day.alias("day"), F.col("column").alias("fault_in"), "reason", "value")


@query(
    sql.on_panel(
        f"entity:s day:t {sql.MEASURES}", "(SELECT * FROM panel WHERE dayofyear(day) % 20 NOT IN (1, 2, 3, 4))"
    )
)
def accepted_rows(spark, sf_dir):
    """The rows without faults."""
    return comparable(quarantine.read_panel_csv(spark, _faulty_lines(spark, sf_dir), SPEC).good)


def _faulty_payloads(spark, sf_dir):
    """One payload per entity and month, some broken by month."""
    items = F.array_sort(F.collect_list(F.struct("day", *SPEC.measures)))
    month = F.date_format("day", "yyyy-MM")
    grouped = status_panel(spark, sf_dir).groupBy("entity", month.alias("month")).agg(items.alias("items"))
    kind = F.substring("month", 6, 2).cast("int")
    days = F.transform("items", lambda i: F.date_format(i["day"], "yyyy-MM-dd"))
    days = F.when(kind == 2, F.transform(days, lambda d: F.concat(F.lit("on "), d))).otherwise(days)
    arrays = [F.col(f"items.{m}").alias(m) for m in SPEC.measures[1:]]
    first = F.when(kind == 4, F.concat(F.col("items.price_max"), F.array(F.lit(0.0)))).otherwise(F.col("items.price_max"))
    daily = F.struct(F.when(kind != 3, days).alias("time"), first.alias(SPEC.measures[0]), *arrays)
    text = F.to_json(F.struct(F.concat("entity", F.lit(" "), "month").alias("entity"), daily.alias("daily")))
    cut = F.when(kind == 5, F.concat(F.substring(text, 1, 20), F.lit("!"))).otherwise(text)
    path = fresh_path(spark, "faulty-payloads")
    grouped.select(cut.alias("value")).write.text(path)
    return path


_PAYLOAD_FAULTS = (
    "monthly AS (SELECT entity || ' ' || strftime(day, '%Y-%m') AS record, month(day) AS kind, "
    "strftime(day, '%Y-%m-%d') AS text FROM panel), "
    "per_month AS (SELECT record, kind, count(*) AS n FROM monthly GROUP BY ALL), "
    "rejected AS (SELECT record, 'time' AS fault_in, 'not a day' AS reason, 'on ' || text AS value FROM monthly WHERE kind = 2 "
    "UNION ALL SELECT record, 'time', 'no days', NULL FROM per_month WHERE kind = 3 "
    "UNION ALL SELECT record, 'price_max', 'length differs from time', CAST(n + 1 AS VARCHAR) FROM per_month WHERE kind = 4 "
    "UNION ALL SELECT NULL, NULL, 'malformed record', substring('{\"entity\":\"' || record, 1, 20) || '!' FROM per_month WHERE kind = 5)"
)


@query(sql.on_panel("record:s fault_in:s reason:s value:s", "rejected", _PAYLOAD_FAULTS))
def rejected_payloads(spark, sf_dir):
    """Every fault of JSON payloads with planted faults."""
    path = _faulty_payloads(spark, sf_dir)
    found = quarantine.read_payloads(spark, path, SPEC.measures, SPEC, "entity", multi_line=False).faults
    return found.select("record", F.col("column").alias("fault_in"), "reason", "value")
