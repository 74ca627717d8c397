import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.functions import scalar


@pytest.mark.parametrize(
    "cover,rain,label,style",
    [
        (70.0, False, "Cloudy", "cloudy"),
        (69.9, False, "Partly cloudy", "cloudy"),
        (35.0, False, "Partly cloudy", "cloudy"),
        (34.9, False, "Clear sky", "sunny"),
        (10.0, True, "Rain", "rain"),
    ],
)
def test_condition(spark, cover, rain, label, style):
    row = spark.range(1).select(scalar.condition(F.lit(cover), F.lit(rain), (70.0, 35.0)))
    assert tuple(row.first()[0]) == (label, style)


@pytest.mark.parametrize("value", [0.25, 0.75, 2.5, -1.25, 1.0, -0.04, 1234.5678, 26.5, 27.5,
                                   0.35, 8.35, 0.355, 2.675, -0.35, 1.005, 0.125, 99999.95])
@pytest.mark.parametrize("digits", [0, 1, 2])
def test_fixed_text_equals_python_format(spark, value, digits):
    row = spark.range(1).select(
        scalar.fixed(F.lit(value), digits), scalar.fixed(F.lit(value), digits, signed=True)
    ).first()
    assert tuple(row) == (f"{value:.{digits}f}", f"{value:+.{digits}f}")


def test_fixed_text_of_nothing_is_nothing(spark):
    row = spark.range(1).select(scalar.fixed(F.lit(None).cast("double"), 1)).first()
    assert row[0] is None


def test_rounding_ties(spark):
    row = spark.range(1).select(
        F.round(F.lit(0.25), 1), scalar.round_half_even(F.lit(0.25), 1),
        F.round(F.lit(2.5), 0), scalar.round_half_even(F.lit(2.5), 0),
    ).first()
    assert tuple(row) == (0.3, 0.2, 3.0, 2.0)


def test_flag_keeps_null(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,), (0.9,)], "p double")
    flags = [r[0] for r in df.select(scalar.flag_at_least(F.col("p"), 1.0)).collect()]
    assert flags == [0, 1, None, 0]


def test_days(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("n/a",)], "t string")
    parsed = [r[0] for r in df.select(scalar.parse_day(F.col("t"))).collect()]
    assert parsed == [dt.date(2024, 2, 29), None, None]
    day = F.to_date(F.lit("2025-07-15"))
    row = spark.range(1).select(
        F.date_format(day, scalar.CARD_DAY),
        F.date_format(day, scalar.CARD_NEXT_DAY),
        F.date_format(day, scalar.HEADING_DAY),
        scalar.split_tag(day, 2023),
        scalar.split_tag(F.to_date(F.lit("2023-12-31")), 2023),
    ).first()
    want = dt.date(2025, 7, 15)
    assert tuple(row)[:3] == (
        f"{want:%a, %d %b %Y}", f"{want:%a, %d %b}", f"{want:%A, %d %b %Y}"
    )
    assert tuple(row)[3:] == ("Unseen test date", "Training date")


def test_words_and_slider(spark):
    row = spark.range(1).select(
        scalar.yes_no(F.lit(0.5) >= 0.5), scalar.rainy_dry(F.lit(0.9) >= 1.0)
    ).first()
    assert tuple(row) == ("YES", "dry")
    values = scalar.slider_values(0.1, 0.9, 0.05)
    assert len(values) == 17 and values[0] == 0.1 and values[-1] == 0.9 and 0.5 in values
