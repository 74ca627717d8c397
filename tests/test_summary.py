import datetime as dt

import numpy as np
import pytest
from panels import from_rows, rows_of, to_spark, weather_frame

from panelcast.operators import summary
from panelcast.weather import (
    CORRELATED,
    SUMMARY_BY_ARCHIVE_YEARS,
    SUMMARY_BY_SEEN_YEARS,
    WEATHER,
    YEARS_IN_ARCHIVE,
)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert summary.correlations(df, ["a", "b"]).first()["corr"] is None
    rows = {r["column"]: r for r in summary.correlation_matrix(df, ["a", "b"]).collect()}
    assert rows["a"]["a"] is None and rows["b"]["b"] == 1.0 and rows["a"]["b"] is None


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (2.0, None, 5.0), (3.0, 5.0, 2.0), (4.0, 4.0, 2.5)],
        "a double, b double, c double",
    )
    rows = {(r["a"], r["b"]): r["corr"] for r in summary.correlations(df, "abc").collect()}
    assert rows["a", "b"] == pytest.approx(0.7857142857)
    assert rows["a", "c"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [1, 5, 2, 2.5])[0, 1])


def test_matrix_equals_data_frame_correlation(spark):
    frame = weather_frame(days=50)
    want = frame[list(CORRELATED)].corr()
    panel = to_spark(spark, frame)
    for complete in (False, True):
        got = summary.correlation_matrix(panel, CORRELATED, complete).toPandas()
        got = got.set_index("column")[list(CORRELATED)]
        np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float), atol=1e-9)


def test_two_summaries_differ_in_rounding_and_years(spark):
    panel = from_rows(
        spark,
        rows_of("A", ["2023-12-31", "2024-01-01"], [0.25, 0.25])
        + rows_of("B", ["2024-01-02", "2024-01-03"], [1.0, None]),
    )
    fixed = summary.entity_summary_fixed_years(
        panel, WEATHER, YEARS_IN_ARCHIVE, SUMMARY_BY_ARCHIVE_YEARS
    )
    seen = summary.entity_summary_seen_years(panel, WEATHER, SUMMARY_BY_SEEN_YEARS)
    a_fixed, b_fixed = [tuple(r) for r in fixed.orderBy("city").collect()]
    a_seen, b_seen = [tuple(r) for r in seen.orderBy("city").collect()]
    assert a_fixed == ("A", 0.3, 0.3, 0.0, 0.0)  # ties away from zero
    assert a_seen == ("A", 0.2, 0.2, 0.2, 0.0)  # ties to even, two years seen
    assert b_fixed == ("B", 1.0, 1.0, 0.0, 100.0)  # the NULL day is left out
    assert b_seen == ("B", 1.0, 1.0, 0.5, 100.0)


def test_summary_by_seen_years_equals_numpy(spark):
    frame = weather_frame(days=400, seed=2)
    got = summary.entity_summary_seen_years(
        to_spark(spark, frame), WEATHER, SUMMARY_BY_SEEN_YEARS
    ).collect()
    years = len({d.year for d in frame["date"]})
    assert len(got) == 3
    for row in got:
        mine = frame[frame["city"] == row["city"]]
        wet = mine["precipitation_sum"].to_numpy()
        want = [
            np.mean(mine["temperature_2m_mean"]),
            np.mean(mine["relative_humidity_2m_mean"]),
            wet.sum() / years,
            100 * np.count_nonzero(wet >= 1) / wet.size,
        ]
        np.testing.assert_allclose(tuple(row)[1:], np.round(want, 1), atol=1e-9)


def test_climatology_trend_balance(spark):
    frame = weather_frame(days=400, seed=4)
    panel = to_spark(spark, frame)
    month = [d.month for d in frame["date"]]
    year = [d.year for d in frame["date"]]
    monthly = summary.monthly_climatology(panel, WEATHER).toPandas()
    want = frame.groupby(["city", month])[["temperature_2m_mean", "precipitation_sum"]].mean()
    np.testing.assert_allclose(monthly[["temp", "rain"]].to_numpy(), want.to_numpy())
    yearly = summary.yearly_trend(panel, WEATHER).toPandas()
    np.testing.assert_allclose(
        yearly["temp"], frame.groupby(year)["temperature_2m_mean"].mean().to_numpy()
    )
    balance = {r["rainy"]: r["count"] for r in summary.event_balance(panel, WEATHER).collect()}
    assert balance[1] == (frame.precipitation_sum >= 1).sum()


def test_extents(spark):
    b, a = rows_of("B", ["2023-12-31", "2024-01-05"]), rows_of("A", ["2024-01-01"])
    panel = from_rows(spark, b + a)
    first, last = summary.valid_request_range(panel, WEATHER).first()
    assert (first, last) == (dt.date(2024, 1, 2), dt.date(2024, 1, 5))
    assert summary.n_years(panel, WEATHER).first()["years"] == 2
    assert [r["city"] for r in summary.entity_list(panel, "city").collect()] == ["A", "B"]
