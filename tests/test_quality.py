import datetime as dt
import math

import pytest
from panels import from_rows, rows_of

from panelcast.operators import quality
from panelcast.operators.summary import counts_by


def test_null_and_nan_are_counted_apart(spark):
    df = spark.createDataFrame(
        [("a", 1.0), (None, float("nan")), ("b", None)], "k string, v double"
    )
    rows = {r["column"]: (r["nulls"], r["nans"]) for r in quality.null_counts(df).collect()}
    assert rows == {"k": (1, 0), "v": (1, 1)}
    empty = {r["column"]: r["nulls"] for r in quality.null_counts(df.limit(0)).collect()}
    assert empty == {"k": 0, "v": 0}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (1, 1)], "a int, b int")
    assert tuple(quality.duplicate_keys(df, ["a", "b"]).first()) == (5, 3, 2)
    assert [tuple(r) for r in quality.repeated_keys(df, ["a", "b"]).collect()] == [(1, 1, 3)]
    assert tuple(quality.duplicate_keys(df.limit(0), ["a", "b"]).first()) == (0, 0, 0)


def test_survivor_of_a_key_is_the_smallest_row_and_whole(spark):
    df = spark.createDataFrame([("k", 2, 1), ("k", 1, 9), ("j", 5, 5)], "k string, x int, y int")
    rows = sorted(tuple(r) for r in quality.distinct_by_key(df, ["k"]).collect())
    assert rows == [("j", 5, 5), ("k", 1, 9)]
    assert quality.distinct_by_key(df.select("k"), ["k"]).count() == 2


def test_basic_statistics_use_the_sample_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    row = quality.basic_statistics(df, ["v"]).first()
    assert row["count"] == 3 and row["min"] == 1.0 and row["max"] == 4.0
    assert row["mean"] == pytest.approx(7 / 3)
    assert row["stddev"] == pytest.approx(math.sqrt(7 / 3))


def test_completeness_and_shape(spark):
    panel = from_rows(
        spark, rows_of("A", ["2024-01-01", "2024-01-04"]) + rows_of("B", ["2024-01-01"])
    )
    rows = {r["city"]: r for r in quality.completeness(panel, "city", "date").collect()}
    assert rows["A"]["missing_days"] == 2 and rows["B"]["missing_days"] == 0
    assert rows["A"]["last_day"] == dt.date(2024, 1, 4)
    assert tuple(quality.shape(panel).first()) == (3, 11)
    assert {r["city"]: r["count"] for r in counts_by(panel, "city").collect()} == {"A": 2, "B": 1}


def test_profile_and_preview(spark):
    df = spark.createDataFrame([(2, None), (1, "x")], "a int, b string")
    rows = quality.schema_profile(df).collect()
    assert [(r["column"], r["type"], r["rows"], r["filled"]) for r in rows] == [
        ("a", "int", 2, 2),
        ("b", "string", 2, 1),
    ]
    assert [r["a"] for r in quality.preview(df, ["a"], 1).collect()] == [1]
