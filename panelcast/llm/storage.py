"""Intermediate tables of the operators, in the shared folder of the cluster."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame

from panelcast.storage import fresh_path


def scratch_path(spark, name: str) -> str:
    """A new path in this application's own folder, which its owner may delete afterwards."""
    folder = f"llm-{spark.sparkContext.applicationId}/{name}"
    return fresh_path(spark, folder)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet and read it again. This cuts the lineage as a checkpoint does,
    in one job instead of two. Python functions on the way get small batches."""
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that the reader of Parquet files holds at a time.
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


@contextmanager
def small_batches(spark, rows: int = 1000, read_rows: int = 512):
    """What runs inside the block gets its rows in Python at most `rows` at a time, and reads files by
    `read_rows`, so that JVM and Python hold fewer whole texts at once. The session's own settings are put back."""
    limits = {BATCH_ROWS: rows, READ_ROWS: read_rows}
    before = {name: spark.conf.get(name) for name in limits}
    for name, limit in limits.items():
        if not 0 < int(before[name]) <= limit:
            spark.conf.set(name, limit)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
