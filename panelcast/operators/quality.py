"""Checks on a panel: schema, counts, missing values, duplicate keys, basic statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _rows(records: list[dict[str, Column]]) -> Column:
    """Turn one aggregate row into one row per record."""
    return F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in r.items()]) for r in records]))


def _is_nan(df: DataFrame, column: str) -> Column:
    floating = isinstance(df.schema[column].dataType, (DoubleType, FloatType))
    return F.isnan(column) if floating else F.lit(False)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, nans) for all columns from one pass; an empty table gives zeros."""
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
        *[F.count_if(_is_nan(df, c)).alias(f"x{i}") for i, c in enumerate(df.columns)],
    )
    return counts.select(
        _rows(
            [
                {"column": F.lit(c), "nulls": F.col(f"n{i}"), "nans": F.col(f"x{i}")}
                for i, c in enumerate(df.columns)
            ]
        )
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column, type, rows, filled) per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    return counts.select(
        _rows(
            [
                {
                    "position": F.lit(i + 1),
                    "column": F.lit(f.name),
                    "type": F.lit(f.dataType.simpleString()),
                    "rows": F.col("rows"),
                    "filled": F.col(f"c{i}"),
                }
                for i, f in enumerate(df.schema.fields)
            ]
        )
    )


def shape(df: DataFrame) -> DataFrame:
    """One row (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def preview(df: DataFrame, keys: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*keys).limit(rows)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row (rows, distinct_keys, duplicates); pre-aggregated, one shuffle on the key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return per_key.agg(
        total.alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (total - F.count(F.lit(1))).alias("duplicates"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def distinct_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest remaining column values, taken together.

    An aggregate rather than ``row_number``: copies collapse before the shuffle, so a key
    with very many copies does not land in one task, and the survivor is well defined.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"kept.{c}").alias(c) for c in df.columns]
    )


def basic_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max), typed; stddev is the sample deviation."""
    moments = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    fields = ("count", "mean", "stddev", "min", "max")
    return moments.select(
        _rows([{"column": F.lit(c)} | {f: F.col(f"`{c}`.{f}") for f in fields} for c in columns])
    )


def completeness(panel: DataFrame, entity: str, day: str) -> DataFrame:
    """Per entity: rows, first and last day, and how many days in between are missing."""
    return panel.groupBy(entity).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        (F.datediff(F.max(day), F.min(day)) + 1 - F.count(F.lit(1))).alias("missing_days"),
    )
