"""Readers for panels, payloads and the entity dimension."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.spec import PanelSpec

DIMENSION = "{entity} string, lat double, lon double"


def read_panel_csv(
    spark: SparkSession, paths: str | Sequence[str], spec: PanelSpec, infer: bool = False
) -> DataFrame:
    """CSV with a header row. The explicit schema saves the extra pass that inference costs.

    The header must name the measures of the spec in their order, else the read fails;
    files with other columns can be read with ``infer``. A cell that is not of its column's
    type fails the read too, instead of becoming NULL.
    """
    reader = spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd")
    reader = reader.option("mode", "FAILFAST")
    if infer:
        return reader.option("inferSchema", True).csv(paths)
    return reader.option("enforceSchema", False).schema(spec.schema()).csv(paths)


def read_panel_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))


def payload_schema(variables: Sequence[str], entity: str | None = None) -> T.StructType:
    """``daily`` is a struct of parallel arrays; other members of the payload are ignored."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))] + [
        T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables
    ]
    fields = [T.StructField("daily", T.StructType(arrays))]
    if entity is not None:
        fields.insert(0, T.StructField(entity, T.StringType()))
    return T.StructType(fields)


def read_payloads(
    spark: SparkSession,
    paths: str | Sequence[str],
    variables: Sequence[str],
    entity: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """JSON payloads, one document per file, or one per line with ``multi_line=False``. A document
    that is no valid JSON fails the read."""
    reader = spark.read.schema(payload_schema(variables, entity)).option("mode", "FAILFAST")
    return reader.option("multiLine", multi_line).json(paths)


def payload_rows(payloads: DataFrame, variables: Sequence[str], spec: PanelSpec) -> DataFrame:
    """One row per array position; columns of the payload besides ``daily`` are kept.

    Arrays of unequal length would be padded silently, and a payload without days would vanish,
    so both are errors.
    """
    arrays = ["time", *variables]
    length = F.size("daily.time")
    ragged = F.lit(False)
    for v in variables:
        ragged = ragged | ~F.size(f"daily.{v}").eqNullSafe(length)
    zipped = (
        F.when(F.col("daily.time").isNull(), F.raise_error(F.lit("payload without daily.time")))
        .when(ragged, F.raise_error(F.lit("payload arrays differ in length")))
        .otherwise(F.arrays_zip(*[F.col(f"daily.{a}") for a in arrays]))
    )
    kept = [c for c in payloads.columns if c != "daily"]
    rows = payloads.select(*kept, F.inline(zipped))
    return rows.select(
        *kept, F.to_date("time", "yyyy-MM-dd").alias(spec.day), *variables
    )


def with_entity(rows: DataFrame, name: str, spec: PanelSpec) -> DataFrame:
    """Constant entity as the first column, for files that hold a single entity."""
    return rows.select(F.lit(name).alias(spec.entity), "*")


def union_panels(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all panels, matched by column name; columns a panel lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def entity_dimension(
    spark: SparkSession, rows: Sequence[tuple[str, float, float]], spec: PanelSpec
) -> DataFrame:
    return spark.createDataFrame(list(rows), DIMENSION.format(entity=spec.entity))


def attach_dimension(panel: DataFrame, dimension: DataFrame, spec: PanelSpec) -> DataFrame:
    """Panel rows with the attributes of their entity; unlisted entities keep NULLs."""
    return panel.join(dimension, spec.entity, "left")


def daily_panel(
    rows: DataFrame, entity: Column, day: Column, measures: dict[str, Column], spec: PanelSpec
) -> DataFrame:
    """Aggregate finer rows to one row per (entity, day); copies combine before the shuffle."""
    return rows.groupBy(entity.alias(spec.entity), day.alias(spec.day)).agg(
        *[c.alias(n) for n, c in measures.items()]
    )
