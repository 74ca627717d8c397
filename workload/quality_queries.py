"""Counts, missing values, duplicate keys, statistics, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import quality
from panelcast.operators.features import scoring_features
from panelcast.operators.summary import counts_by
from panelcast.sources.readers import attach_dimension, entity_dimension, union_panels, with_entity
from workload import sql
from workload.comparable import comparable, sql_select
from workload.panels import DESCRIBED, SPEC, nation_panel, status_panel, table
from workload.registry import query

ITEM_KEY = ["l_orderkey", "l_linenumber"]


@query(
    sql.on_panel(
        "entity:s count:i", "(SELECT entity, count(*) AS count FROM panel GROUP BY 1)"
    )
)
def rows_per_entity(spark, sf_dir):
    return comparable(counts_by(status_panel(spark, sf_dir), SPEC.entity).orderBy(SPEC.entity))


_SCORING_COLUMNS = [c.split(":")[0] for c in sql.SCORING.split()]


@query(
    sql.on_windowed(
        "column:s nulls:i nans:i",
        "("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, 0 AS nans "
            "FROM windowed"
            for c in _SCORING_COLUMNS
        )
        + ")",
    )
)
def null_counts(spark, sf_dir):
    return comparable(quality.null_counts(scoring_features(status_panel(spark, sf_dir), SPEC)))


_ITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{t}' AS type, "
        f"count(*) AS rows, count({c}) AS filled FROM lineitem"
        for i, (c, t) in enumerate(_ITEM_TYPES.items(), start=1)
    )
    + ")"
)
def schema_profile(spark, sf_dir):
    return comparable(quality.schema_profile(table(spark, sf_dir, "lineitem")))


@query(sql.on_panel("rows:i columns:i", "(SELECT count(*) AS rows, 11 AS columns FROM panel)"))
def panel_shape(spark, sf_dir):
    return comparable(quality.shape(status_panel(spark, sf_dir)))


@query(
    sql.on_panel(
        f"entity:s day:t {sql.MEASURES}", "(SELECT * FROM panel ORDER BY entity, day LIMIT 5)"
    )
)
def panel_preview(spark, sf_dir):
    return comparable(quality.preview(status_panel(spark, sf_dir), SPEC.key))


@query(
    sql_select(
        "rows:i distinct_keys:i duplicates:i",
        "(SELECT sum(n) AS rows, count(*) AS distinct_keys, sum(n - 1) AS duplicates FROM "
        "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber))",
    )
)
def duplicate_keys(spark, sf_dir):
    return comparable(quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ITEM_KEY))


@query(
    sql_select(
        "l_orderkey:i l_linenumber:i copies:i",
        "(SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
        "GROUP BY 1, 2 HAVING count(*) > 1)",
    )
)
def repeated_keys(spark, sf_dir):
    return comparable(quality.repeated_keys(table(spark, sf_dir, "lineitem"), ITEM_KEY))


@query(
    sql_select(
        "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_quantity:d",
        "(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY l_partkey, l_suppkey, l_quantity) AS copy FROM lineitem) WHERE copy = 1",
    )
)
def distinct_keys(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        *ITEM_KEY, "l_partkey", "l_suppkey", "l_quantity"
    )
    return comparable(quality.distinct_by_key(items, ITEM_KEY))


@query(
    sql.on_panel(
        "column:s count:i mean:d stddev:d min:d max:d",
        "("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, "
            f"stddev_samp({c}) AS stddev, min({c}) AS min, max({c}) AS max FROM panel"
            for c in DESCRIBED
        )
        + ")",
    )
)
def basic_statistics(spark, sf_dir):
    return comparable(quality.basic_statistics(status_panel(spark, sf_dir), DESCRIBED))


@query(
    sql.on_panel(
        "entity:s rows:i first_day:t last_day:t missing_days:i",
        "(SELECT entity, count(*) AS rows, min(day) AS first_day, max(day) AS last_day, "
        "date_diff('day', min(day), max(day)) + 1 - count(*) AS missing_days "
        "FROM panel GROUP BY 1)",
    )
)
def completeness(spark, sf_dir):
    return comparable(quality.completeness(status_panel(spark, sf_dir), SPEC.entity, SPEC.day))


@query(
    sql.on_panel(
        "entity:s day:t price_mean:d qty_mean:d source:s",
        "(SELECT entity, day, price_mean, qty_mean, NULL AS source FROM panel UNION ALL "
        "SELECT 'events', CAST(ts AS DATE), avg(value), NULL, 'events' FROM events "
        "GROUP BY 2)",
    )
)
def union_entities(spark, sf_dir):
    """Panels of different files: one lacks a column, the other lacks an entity."""
    items = status_panel(spark, sf_dir).select("entity", "day", "price_mean", "qty_mean")
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("day"))
        .agg(F.avg("value").alias("price_mean"))
        .withColumn("source", F.lit("events"))
    )
    return comparable(union_panels([items, with_entity(daily, "events", SPEC)]))


@query(
    f"WITH {sql.NATION_PANEL} "
    + sql_select(
        "entity:s lat:d lon:d days:i",
        "(SELECT entity, min(CAST(n_regionkey AS DOUBLE)) AS lat, min(-CAST(n_nationkey AS DOUBLE)) AS lon, "
        "count(*) AS days FROM panel JOIN nation ON entity = n_name WHERE n_nationkey % 5 <> 0 GROUP BY 1 "
        "UNION ALL SELECT entity, NULL, NULL, count(*) FROM panel JOIN nation ON entity = n_name "
        "WHERE n_nationkey % 5 = 0 GROUP BY 1)",
    )
)
def entity_places(spark, sf_dir):
    """Days per nation with its place, from a list of places that lacks some nations."""
    nations = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0")
    places = [(r.n_name, float(r.n_regionkey), -float(r.n_nationkey)) for r in nations.collect()]
    panel = nation_panel(spark, sf_dir)
    days = panel.groupBy(SPEC.entity).agg(F.count(F.lit(1)).alias("days"))
    return comparable(attach_dimension(days, entity_dimension(spark, places, SPEC), SPEC).select("entity", "lat", "lon", "days"))


@query(
    sql_select(
        "entity:s day:t orders:i total:d region:s",
        "(SELECT n_name AS entity, CAST(o_orderdate AS DATE) AS day, count(*) AS orders, "
        "sum(o_totalprice) AS total, r_name AS region FROM orders "
        "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 5)",
    )
)
def dimension_join(spark, sf_dir):
    """Orders per customer nation and day, with the region as the entity's attribute.

    Orders are counted per customer and day before the customer join, so a customer with
    very many orders reaches the join as at most one row per day.
    """
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total"))
    )
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_name", "entity")
    daily = (
        per_customer.join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("entity", "day")
        .agg(F.sum("orders").alias("orders"), F.sum("total").alias("total"))
    )
    regions = nations.join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("entity", F.col("r_name").alias("region"))
    return comparable(attach_dimension(daily, regions, SPEC))


