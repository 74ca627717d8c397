"""Stored tables that are found again by what they were made from.

An entry is named by a fingerprint: of the input files (path, size, time of change), the plan over them and
whatever settings the caller adds. The data is written first, then a marker that points to it, so an
entry is either whole or absent, and of two writers at once the later marker wins while both
tables stay readable. A catalogue owns the folder it is given and deletes it when told to.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.storage import fresh_path, read_marker, shared_dir, table_fingerprint, write_marker


def source_fingerprint(df: DataFrame) -> str:
    """Names the rows of `df` without reading them: by its input files and its plan. A table that reads
    no files is named by its content.

    The listing is summed up in Spark; contents of files are not opened. The plan's hash is only
    comparable within one Spark version, so another one computes anew.
    """
    files = [unquote(f) for f in df.inputFiles()]
    if not files:
        return table_fingerprint(df)
    listed = df.sparkSession.read.format("binaryFile").load(files)
    row = listed.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")).alias("s"),
        F.sum("length").alias("bytes"),
    ).first()
    return f"{row.n} files;{row.bytes} bytes;{row.s};plan {df.semanticHash()};{df.schema.simpleString()}"


class Catalogue:
    """Tables under one folder, by default one per application in the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/catalogue-{spark.sparkContext.applicationId}"

    def _entry(self, name: str, made_of: str) -> str:
        return f"{self.root}/{name}-{hashlib.sha256(made_of.encode()).hexdigest()[:32]}"

    def find(self, name: str, made_of: str) -> DataFrame | None:
        """The stored table, None where there is none."""
        marker = read_marker(self.spark, f"{self._entry(name, made_of)}/marker")
        if marker is None:
            return None
        entry = json.loads(marker)
        if entry["made_of"] != made_of:
            return None
        return self.spark.read.schema(entry["schema"]).parquet(entry["data"]).select(*entry["columns"])

    def table(
        self,
        name: str,
        made_of: str,
        build: Callable[[], DataFrame],
        write: Callable[[DataFrame, str], None] | None = None,
    ) -> DataFrame:
        """The stored table of this name and origin; built and written where there is none."""
        found = self.find(name, made_of)
        if found is not None:
            return found
        entry = self._entry(name, made_of)
        table = build()
        data = f"{entry}/{fresh_path(self.spark, 'data').rsplit('/', 1)[1]}"
        if write is None:
            table.write.parquet(data)
        else:
            write(table, data)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        marker = {"made_of": made_of, "data": data, "schema": schema, "columns": table.columns}
        write_marker(self.spark, f"{entry}/marker", json.dumps(marker, sort_keys=True))
        return self.find(name, made_of)

    def delete(self) -> None:
        """Remove the folder with all its tables; DataFrames read from them fail afterwards."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Catalogue:
        return self

    def __exit__(self, *_) -> None:
        self.delete()
