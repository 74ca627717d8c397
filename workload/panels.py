"""Panels made from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast import Delta, Lag, PanelSpec, Roles, Rolling, Target
from panelcast.catalogue import Catalogue
from panelcast.plans.store import feature_store
from panelcast.sources.readers import daily_panel

LEVEL_EVENT = 27.0
YEARS = 7

SPEC = PanelSpec(
    entity="entity",
    day="day",
    measures=(
        "price_max", "price_min", "price_mean", "qty_mean", "qty_sum", "qty_max",
        "disc_mean", "tax_mean", "line_mean",
    ),
    lags=tuple(
        Lag(c, 1, f"{c}_lag1")
        for c in ("price_mean", "disc_mean", "tax_mean", "qty_mean", "qty_max", "line_mean")
    )
    + (Lag("price_mean", 2, "price_mean_lag2"),),
    rollings=(
        Rolling("price_mean", "avg", 3, "price_avg_3d"),
        Rolling("price_mean", "avg", 7, "price_avg_7d"),
        Rolling("disc_mean", "avg", 3, "disc_avg_3d"),
        Rolling("tax_mean", "avg", 3, "tax_avg_3d"),
        Rolling("qty_mean", "sum", 7, "qty_sum_7d"),
    ),
    deltas=(Delta("tax_mean", "tax_change"),),
    targets=(
        Target("price_mean", 1, "price_tomorrow"),
        Target("qty_mean", 1, "high_qty_tomorrow", threshold=LEVEL_EVENT),
    ),
    exclude=("entity", "day", "year", "qty_sum", "price_tomorrow", "high_qty_tomorrow"),
    roles=Roles(
        level="price_mean",
        high="price_max",
        low="price_min",
        amount="qty_mean",
        humidity="disc_mean",
        wind="qty_max",
        pressure="tax_mean",
        cover="line_mean",
        amount_total="qty_sum_7d",
        pressure_change="tax_change",
    ),
    threshold=LEVEL_EVENT,
    last_train_year=1999,
    cover_bands=(4.25, 3.5),
)
CORRELATED = (
    "price_max", "price_min", "price_mean", "qty_mean", "qty_max", "disc_mean", "tax_mean",
    "line_mean",
)
DESCRIBED = ("price_mean", "qty_mean", "disc_mean", "qty_max")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _measures() -> dict[str, Column]:
    return {
        "price_max": F.max("l_extendedprice"),
        "price_min": F.min("l_extendedprice"),
        "price_mean": F.avg("l_extendedprice"),
        "qty_mean": F.avg("l_quantity"),
        "qty_sum": F.sum("l_quantity"),
        "qty_max": F.max("l_quantity"),
        "disc_mean": F.avg("l_discount") * 100,
        "tax_mean": F.avg("l_tax") * 100,
        "line_mean": F.avg("l_linenumber"),
    }


def ship_day() -> Column:
    return F.col("l_shipdate").cast("date")


def status_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem by return flag and line status, per ship day."""
    items = table(spark, sf_dir, "lineitem")
    entity = F.concat("l_returnflag", "l_linestatus")
    return daily_panel(items, entity, ship_day(), _measures(), SPEC)


def nation_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem by the supplier's nation, per ship day: about 62,000 rows when dense.

    The join is left to the optimizer: it broadcasts the supplier side while that is
    small, else sorts and splits hot suppliers.
    """
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    items = table(spark, sf_dir, "lineitem").join(
        suppliers.select("s_suppkey", "n_name"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return daily_panel(items, F.col("n_name"), ship_day(), _measures(), SPEC)


def catalogue(spark: SparkSession) -> Catalogue:
    """The stored tables of this application; whoever started it deletes them at its end."""
    return Catalogue(spark)


def status_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feature table of :func:`status_panel`."""
    return feature_store(catalogue(spark), status_panel(spark, sf_dir), SPEC)


def nation_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_store(catalogue(spark), nation_panel(spark, sf_dir), SPEC)


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order asks for a forecast; its priority picks the entity, one of them unknown."""
    priority = F.substring("o_orderpriority", 1, 1)
    entity = (
        F.when(priority == "1", "AF")
        .when(priority == "2", "AO")
        .when(priority == "3", "NF")
        .when(priority == "4", "RO")
        .otherwise("ZZ")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        entity.alias("entity"),
        F.col("o_orderdate").cast("date").alias("day"),
        (F.col("o_orderkey") % 9 / 10).alias("threshold"),
    )


def month_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day of every month in which something was ordered."""
    day = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return table(spark, sf_dir, "orders").select(day.alias("day")).distinct()
