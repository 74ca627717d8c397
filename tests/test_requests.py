import datetime as dt

from panels import from_rows, rows_of

from panelcast.operators import requests as ops
from panelcast.plans.reports import tiles
from panelcast.operators.features import scoring_features
from panelcast.weather import WEATHER


def asked(spark, *rows):
    return spark.createDataFrame(
        [(c, dt.date.fromisoformat(d)) for c, d in rows], "city string, date date"
    )


def test_lookup_keeps_requests_without_a_row(spark):
    panel = from_rows(spark, rows_of("A", ["2024-01-01"], 3.0))
    requests = asked(spark, ("A", "2024-01-01"), ("A", "2024-01-02"), ("B", "2024-01-01"))
    rows = ops.lookup(requests, panel, WEATHER).orderBy("city", "date").collect()
    assert [r["rain_sum"] for r in rows] == [3.0, None, None]


def test_unknown_entities_are_counted(spark):
    panel = from_rows(spark, rows_of("A", ["2024-01-01"]))
    requests = asked(spark, ("Z", "2024-01-01"), ("Z", "2024-01-02"), ("A", "2030-01-01"))
    unknown = ops.unknown_entities(requests, panel, WEATHER)
    assert [tuple(r) for r in unknown.collect()] == [("Z", 2)]


def test_history_is_calendar_days_inclusive(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-14", "2024-01-15", "2024-01-16"]
    panel = from_rows(spark, rows_of("A", days))
    requests = asked(spark, ("A", "2024-01-15"), ("A", "2024-01-15"), ("A", "2024-03-01"))
    rows = ops.trailing_history(requests, panel, WEATHER).orderBy("history_day").collect()
    assert [str(r["history_day"]) for r in rows] == days[1:4]
    more = ops.trailing_history(requests, panel, WEATHER, days=2, following=1)
    assert more.count() == 3


def test_tiles(spark):
    panel = from_rows(spark, rows_of("A", ["2024-01-01", "2024-01-02"], [10.0, 12.5]))
    table = scoring_features(panel, WEATHER).where("date = DATE'2024-01-02'")
    text = {r["tile"]: r["text"] for r in tiles(table, WEATHER).collect()}
    assert text == {
        "Humidity": "12%",
        "Wind (max)": "12 km/h",
        "Pressure": "12 hPa",
        "Cloud cover": "12%",
        "Rain, 7 days": "22 mm",
        "Pressure change": "+2.5 hPa",
    }
