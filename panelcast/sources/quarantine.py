"""Reads that set faulty input apart instead of failing on it.

One pass reads everything and notes each fault beside its row; the result is stored once, and good rows
and the list of faults are two views of it. The readers of :mod:`panelcast.sources.readers` stay
strict; these are for feeds whose faults somebody is going to look at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.sources.readers import payload_rows, payload_schema
from panelcast.spec import PanelSpec
from panelcast.storage import fresh_path

FILE, RECORD, FAULTS, CORRUPT = "file", "record", "faults", "_corrupt"
#: A fault: the column it is in (null for the whole record), the reason, and the value found.
FAULT = "struct<column: string, reason: string, value: string>"
# Reasons.
MALFORMED, MISSING, NOT_A_DAY, NOT_A_NUMBER = "malformed record", "missing", "not a day", "not a number"
NO_DAYS, UNEQUAL = "no days", "length differs from time"
DAY = r"^\d{4}-\d{2}-\d{2}$"


@dataclass(frozen=True)
class Quarantined:
    """Good rows, and one row per fault: file, record, column, reason, value."""

    good: DataFrame
    faults: DataFrame


def _fault(found: Column, column: str | None, reason: str, value: Column) -> Column:
    described = F.struct(F.lit(column).alias("column"), F.lit(reason).alias("reason"), value.alias("value"))
    return F.when(found, described.cast(FAULT))


def _faults(checks: Sequence[Column]) -> Column:
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def _stored(table: DataFrame, name: str) -> DataFrame:
    path = fresh_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _listed(stored: DataFrame) -> DataFrame:
    return stored.where(F.size(FAULTS) > 0).select(FILE, RECORD, F.inline(FAULTS))


def read_panel_csv(spark: SparkSession, paths: str | Sequence[str], spec: PanelSpec) -> Quarantined:
    """CSV with a header row that names the spec's columns in their order; a file with another
    header still fails as a whole.

    Faults of a line: not as many cells as the header has (nothing else is then said about it), a key cell
    that is empty, a day or a number that is none. `record` is the line's cells joined by commas. An
    empty measure is a NULL, not a fault. An empty folder gives no rows.
    """
    schema = spec.schema()
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]).add(CORRUPT, "string")
    reader = spark.read.option("header", True).option("enforceSchema", False).schema(texts)
    lines = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
    whole = F.col(CORRUPT).isNull()
    typed, checks = [], [_fault(~whole, None, MALFORMED, F.col(CORRUPT))]
    for f in schema:
        cell = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            value, reason = F.when(cell.rlike(DAY), cell.try_cast("date")), NOT_A_DAY
        elif isinstance(f.dataType, T.DoubleType):
            value, reason = cell.try_cast("double"), NOT_A_NUMBER
        else:
            value, reason = cell, MALFORMED
        if f.name in spec.key:
            checks.append(_fault(whole & cell.isNull(), f.name, MISSING, cell))
        checks.append(_fault(whole & cell.isNotNull() & value.isNull(), f.name, reason, cell))
        typed.append(F.when(whole, value).alias(f.name))
    joined = F.concat_ws(",", *[F.coalesce(F.col(f"`{f.name}`"), F.lit("")) for f in schema])
    table = lines.select(
        *typed,
        F.col("_metadata.file_path").alias(FILE),
        F.coalesce(CORRUPT, joined).alias(RECORD),
        _faults(checks).alias(FAULTS),
    )
    stored = _stored(table, "checked-csv")
    return Quarantined(stored.where(F.size(FAULTS) == 0).select(*schema.names), _listed(stored))


def read_payloads(
    spark: SparkSession,
    paths: str | Sequence[str],
    variables: Sequence[str],
    spec: PanelSpec,
    entity: str | None = None,
    multi_line: bool = True,
) -> Quarantined:
    """JSON payloads with parallel arrays, exploded to rows.

    Faults of a document: no valid JSON or a value of another type (nothing else is then said about it), no
    days, a variable whose array is missing or of another length, and every day that is none. A document with
    a fault gives no rows. `record` is its entity, or null where the payload has none.
    """
    schema = payload_schema(variables, entity).add(CORRUPT, "string")
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line)
    documents = reader.json(paths)
    whole, days = F.col(CORRUPT).isNull(), F.col("daily.time")
    none = whole & (F.coalesce(F.size(days), F.lit(0)) <= 0)
    checks = [
        _fault(~whole, None, MALFORMED, F.col(CORRUPT)),
        _fault(none, "time", NO_DAYS, F.lit(None).cast("string")),
    ]
    for v in variables:
        size = F.size(F.col(f"daily.`{v}`"))
        unequal = whole & ~none & ~size.eqNullSafe(F.size(days))
        checks.append(_fault(unequal, v, UNEQUAL, F.greatest(size, F.lit(0)).cast("string")))
    wrong = F.filter(days, lambda d: d.isNull() | ~d.rlike(DAY) | d.try_cast("date").isNull())
    bad_days = F.transform(
        F.when(whole & ~none, wrong),
        lambda d: F.struct(F.lit("time").alias("column"), F.lit(NOT_A_DAY).alias("reason"), d.alias("value")).cast(FAULT),
    )
    name = F.lit(None).cast("string") if entity is None else F.col(entity)
    table = documents.select(
        *[c for c in documents.columns if c != CORRUPT],
        F.col("_metadata.file_path").alias(FILE),
        name.alias(RECORD),
        F.concat(_faults(checks), F.coalesce(bad_days, F.array().cast(f"array<{FAULT}>"))).alias(FAULTS),
    )
    stored = _stored(table, "checked-payloads")
    good = stored.where(F.size(FAULTS) == 0).drop(FILE, RECORD, FAULTS)
    return Quarantined(payload_rows(good, variables, spec), _listed(stored))
