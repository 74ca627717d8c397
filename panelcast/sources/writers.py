"""Sinks. Nothing is collected on the driver; every sink writes from the tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.spec import PanelSpec

# Fixed value: columns of a results file, in file order.
RESULTS = (
    "task string, model string, RMSE double, MAE double, R2 double, seconds double, "
    "Accuracy double, Precision double, Recall double, F1 double"
)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_sorted_csv(
    df: DataFrame, path: str, spec: PanelSpec, mode: str = "errorifexists"
) -> None:
    """CSV part files in (entity, day) order.

    A range sort on both columns: an entity with very many rows is cut by day.
    """
    write_csv(df.orderBy(*spec.key), path, mode)


def write_features(df: DataFrame, path: str, spec: PanelSpec, mode: str = "errorifexists") -> None:
    """Parquet by year, sorted by (entity, day) inside each file.

    Rows are spread by (year, entity): a group has at most 366 rows, so no task is hot,
    and each file serves one year, which the time split prunes.
    """
    (
        df.repartition("year", spec.entity)
        .sortWithinPartitions("year", *spec.key)
        .write.mode(mode)
        .partitionBy("year")
        .parquet(path)
    )


def write_bucketed(
    df: DataFrame, table: str, path: str, spec: PanelSpec, buckets: int
) -> None:
    """A Parquet table bucketed by entity: windows over it need no shuffle.

    Worth it for a panel that features are built from again and again.
    """
    (
        df.repartition(buckets, spec.entity)
        .sortWithinPartitions(*spec.key)
        .write.option("path", path)
        .bucketBy(buckets, spec.entity)
        .sortBy(*spec.key)
        .saveAsTable(table)
    )


def write_per_entity(
    df: DataFrame, path: str, spec: PanelSpec, mode: str = "errorifexists"
) -> None:
    """One CSV folder per entity, named by the lower-cased entity.

    The entity column itself stays in the files. Rows are spread by (entity, year), so one
    large entity is written by several tasks.
    """
    folder = f"{spec.entity}_folder"
    (
        df.withColumn(folder, F.lower(spec.entity))
        .repartition(folder, F.year(spec.day))
        .sortWithinPartitions(folder, spec.day)
        .write.mode(mode)
        .option("header", True)
        .partitionBy(folder)
        .csv(path)
    )


def write_results(leaderboard: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_csv(leaderboard, path, mode)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """A results file; columns are matched by name, those a file lacks are NULL."""
    present = spark.read.option("header", True).csv(path)
    fields = [f.strip().split(" ") for f in RESULTS.split(",")]
    return present.select(
        *[
            (F.col(n) if n in present.columns else F.lit(None)).cast(t).alias(n)
            for n, t in fields
        ]
    )
