"""Shared scratch folder for written intermediate tables, markers and fingerprints."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: on a cluster a machine-local
    path would be invisible to the other executors.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
    return _local_fallback(spark.sparkContext.applicationId)


@functools.cache
def _local_fallback(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"panelcast-{application_id}-")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give forests a place to checkpoint; one that the session has is kept."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def read_marker(spark: SparkSession, path: str) -> str | None:
    """The text that :func:`write_marker` left at `path`, None where there is none."""
    try:
        rows = spark.read.schema("value string").parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows[0].value if len(rows) == 1 else None


def write_marker(spark: SparkSession, path: str, value: str) -> None:
    """A one-row table that says what lies beside it; written last, so what it names is whole."""
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").parquet(path)


def table_fingerprint(df: DataFrame) -> str:
    """Names the rows and columns of a table, whatever the rows' order: their number and the
    sum of their hashes, in one pass that combines before the shuffle."""
    columns = sorted(df.columns)
    hashed = F.xxhash64(*(F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns))
    row = df.agg(F.count("*").alias("n"), F.sum(hashed.cast("decimal(38,0)")).alias("s")).first()
    return f"{','.join(f'{c}:{df.schema[c].dataType.simpleString()}' for c in columns)};{row.n};{row.s}"
