"""Small panels for tests."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

from panelcast.weather import DAILY_VARIABLES, WEATHER


def weather_frame(cities=("A", "B", "C"), days=40, seed=0, start="2023-11-20", keep=1.0):
    """Seasonal sine plus AR(1) noise per city; ``keep`` < 1 leaves out random days."""
    rng = np.random.default_rng(seed)
    frames = []
    for i, city in enumerate(cities):
        t = np.arange(days)
        noise = np.zeros(days)
        for k in range(1, days):
            noise[k] = 0.3 * noise[k - 1] + rng.normal()
        mean = 20 + 5 * i + 8 * np.sin(2 * np.pi * t / 365) + 2 * noise
        rain = np.maximum(0, rng.normal(0.5, 2, days) - 0.5 * noise)
        frame = pd.DataFrame(
            {
                "city": city,
                "date": pd.date_range(start, periods=days).date,
                "temperature_2m_max": mean + 5,
                "temperature_2m_min": mean - 5,
                "temperature_2m_mean": mean,
                "precipitation_sum": rain,
                "rain_sum": rain,
                "wind_speed_10m_max": rng.uniform(0, 40, days),
                "relative_humidity_2m_mean": rng.uniform(20, 100, days),
                "pressure_msl_mean": rng.normal(1010, 5, days),
                "cloud_cover_mean": rng.uniform(0, 100, days),
            }
        )
        frames.append(frame[rng.random(days) < keep])
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, frame):
    return spark.createDataFrame(frame, WEATHER.schema())


def rows_of(city, days, value=1.0):
    """Weather rows on the given days (``yyyy-mm-dd``), every measure equal to ``value``."""
    values = value if isinstance(value, list) else [value] * len(days)
    return [
        (city, dt.date.fromisoformat(d), *([v] * len(DAILY_VARIABLES)))
        for d, v in zip(days, values)
    ]


def from_rows(spark, rows):
    return spark.createDataFrame(rows, WEATHER.schema())


def features_in_pandas(frame):
    """The feature table by loops over rows, as a second opinion."""
    s = WEATHER
    out = []
    for _, group in frame.sort_values(["city", "date"]).groupby("city"):
        records = group.to_dict("records")
        for i, r in enumerate(records):
            row = dict(r)
            day = r["date"]
            row |= {"year": day.year, "month": day.month, "day_of_year": day.timetuple().tm_yday}
            for lag in s.lags:
                row[lag.alias] = records[i - lag.rows][lag.column] if i >= lag.rows else None
            for x in s.rollings:
                part = [p[x.column] for p in records[max(0, i - x.rows + 1) : i + 1]]
                row[x.alias] = sum(part) / (len(part) if x.fn == "avg" else 1)
            for d in s.deltas:
                row[d.alias] = r[d.column] - records[i - 1][d.column] if i else None
            for t in s.targets:
                ahead = records[i + t.horizon][t.column] if i + t.horizon < len(records) else None
                if t.threshold is not None and ahead is not None:
                    ahead = int(ahead >= t.threshold)
                row[t.alias] = ahead
            out.append(row)
    return pd.DataFrame(out)


def assert_same(spark_df, frame, keys=("city", "date")):
    got = spark_df.toPandas().sort_values(list(keys)).reset_index(drop=True)
    want = frame.sort_values(list(keys)).reset_index(drop=True)
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    for c in got.columns:
        if c in keys:
            assert list(got[c]) == list(want[c])
        else:
            np.testing.assert_allclose(
                got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9
            )
