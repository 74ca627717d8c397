"""Run a registered query and its SQL on the same files and compare all values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(value + 0)
    return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, connection, query, sql, sf_dir) -> list[str]:
    df = query(spark, sf_dir)
    got_names, got = normalised(df.columns, [tuple(r) for r in df.collect()])
    relation = connection.execute(sql)
    want_names, want = normalised([d[0] for d in relation.description], relation.fetchall())
    found = []
    if got_names != want_names:
        found.append(f"columns {got_names} != {want_names}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        found.append(f"{len(bad)} different rows, first {bad[0]}")
    return found
