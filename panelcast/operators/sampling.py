"""Exact-size samples and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.storage import fresh_path

RANK = "__rank"


def sample_rank(keys: Sequence[str], seed: int) -> Column:
    """The place of a row in the draw: the MD5 of its keys' texts and the seed, joined by bars.
    Any engine with MD5 draws the same rows. Nulls are empty texts."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *texts, F.lit(str(seed))))


def sample_rows(
    df: DataFrame, keys: Sequence[str], rows: int, seed: int = 0, strict: bool = True
) -> DataFrame:
    """``rows`` rows without replacement, the same ones for any partitioning and engine.

    Each task keeps its own smallest ranks, so only ``rows`` rows per task move. With ``strict``,
    the sample is written once and counted; fewer rows than asked for is an error. Else
    a smaller table is returned whole.
    """
    sample = df.withColumn(RANK, sample_rank(keys, seed)).orderBy(RANK, *keys).limit(rows).drop(RANK)
    if not strict:
        return sample
    path = fresh_path(df.sparkSession, "sample")
    sample.write.parquet(path)
    stored = df.sparkSession.read.schema(sample.schema).parquet(path)
    available = stored.count()
    if available < rows:
        raise ValueError(f"cannot take {rows} of {available} rows without replacement")
    return stored


def sample_rows_by(
    df: DataFrame, group: Sequence[str], keys: Sequence[str], rows: int, seed: int = 0
) -> DataFrame:
    """Up to ``rows`` rows of each group, drawn as :func:`sample_rows` does. Each task drops what
    cannot be among a group's first before the shuffle, so a hot group moves ``rows`` rows per task."""
    order = Window.partitionBy(*group).orderBy(RANK, *keys)
    ranked = df.withColumn(RANK, sample_rank(keys, seed))
    return ranked.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= rows).drop(RANK, "__place")


def top(df: DataFrame, value: str, tie_break: str, rows: int = 10) -> DataFrame:
    """The ``rows`` largest values, ties in order of ``tie_break``."""
    return df.orderBy(F.desc(value), F.asc(tie_break)).limit(rows)
