"""Column expressions. All of them stay in the JVM; there is no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day formats of the cards and the report headings, condition names and styles.
CARD_DAY = "EEE, dd MMM yyyy"
CARD_NEXT_DAY = "EEE, dd MMM"
HEADING_DAY = "EEEE, dd MMM yyyy"
RAIN = ("Rain", "rain")
CLOUDY = ("Cloudy", "cloudy")
PARTLY_CLOUDY = ("Partly cloudy", "cloudy")
CLEAR_SKY = ("Clear sky", "sunny")
# Words of decisions, outcomes and split tags.
YES, NO = "YES", "NO"
RAINY, DRY = "rainy", "dry"
UNSEEN, SEEN = "Unseen test date", "Training date"


def calendar_parts(day: Column) -> dict[str, Column]:
    return {"year": F.year(day), "month": F.month(day), "day_of_year": F.dayofyear(day)}


def flag_at_least(value: Column, threshold: float | Column) -> Column:
    """1 when ``value >= threshold``, 0 when below, NULL when the value is NULL."""
    return (value >= threshold).cast("int")


def parse_day(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Day from text; unreadable text gives NULL instead of failing the whole batch."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def condition(cover: Column, raining: Column, bands: tuple[float, float]) -> Column:
    """Struct (label, style): rain first, then cloud cover against the two bands."""

    def pair(names: tuple[str, str]) -> Column:
        return F.struct(F.lit(names[0]).alias("label"), F.lit(names[1]).alias("style"))

    cloudy, partly = bands
    return (
        F.when(raining, pair(RAIN))
        .when(cover >= cloudy, pair(CLOUDY))
        .when(cover >= partly, pair(PARTLY_CLOUDY))
        .otherwise(pair(CLEAR_SKY))
    )


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back: the rounding data frames use."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def fixed(value: Column, digits: int, signed: bool = False) -> Column:
    """Text with a fixed number of decimals; ``signed`` always shows the sign.

    Rounds the exact binary value, as C's printf does: 0.35 is a little less than its text
    and gives 0.3. Only values exactly between two texts go to the even one.
    """
    scale, size = float(10**digits), F.abs(value)
    # size = high + low; both times the scale are exact, so the sign of the distance is, too.
    high = size.cast("float").cast("double")
    low = size - high
    below = F.floor(size * scale).cast("double")
    distance = (high * scale - (below + 0.5)) + low * scale
    up = (distance > 0) | ((distance == 0) & (below % 2 == 1))
    rounded = F.when(up, below + 1).otherwise(below) / scale
    # Beyond these sizes a double has no decimals to round.
    exact = F.when(size < 1e12, F.when(value < 0, -rounded).otherwise(rounded)).otherwise(value)
    pattern = f"%{'+' if signed else ''}.{digits}f"
    return F.when(value.isNotNull(), F.format_string(pattern, exact))


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit(YES)).otherwise(F.lit(NO))


def rainy_dry(flag: Column) -> Column:
    return F.when(flag, F.lit(RAINY)).otherwise(F.lit(DRY))


def split_tag(day: Column, last_train_year: int) -> Column:
    """Whether a day lies in the training years or in the unseen test years."""
    return F.when(F.year(day) > last_train_year, F.lit(UNSEEN)).otherwise(F.lit(SEEN))


def any_missing(columns: Sequence[str]) -> Column:
    """True when any of the columns is NULL or NaN."""
    found = F.lit(False)
    for name in columns:
        found = found | F.col(name).isNull() | F.isnan(F.col(name).cast("double"))
    return found


def slider_values(low: float, high: float, step: float) -> list[float]:
    """The values a slider from ``low`` to ``high`` offers, both ends included."""
    count = round((high - low) / step)
    return [round(low + i * step, 10) for i in range(count + 1)]
