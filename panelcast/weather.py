"""The daily weather panel as one instance of :class:`PanelSpec`."""

from __future__ import annotations

from panelcast.spec import Delta, Lag, PanelSpec, Roles, Rolling, Target

# Daily variables in file order, station coordinates, thresholds and years.
DAILY_VARIABLES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "rain_sum",
    "wind_speed_10m_max",
    "relative_humidity_2m_mean",
    "pressure_msl_mean",
    "cloud_cover_mean",
)
CITIES = (
    ("Delhi", 28.61, 77.21),
    ("Mumbai", 19.08, 72.88),
    ("Bengaluru", 12.97, 77.59),
    ("Chennai", 13.08, 80.27),
    ("Kolkata", 22.57, 88.36),
    ("Hyderabad", 17.39, 78.49),
    ("Pune", 18.52, 73.86),
    ("Ahmedabad", 23.02, 72.57),
    ("Jaipur", 26.91, 75.79),
    ("Lucknow", 26.85, 80.95),
)
RAIN_MM = 1.0
CLOUDY_PCT, PARTLY_CLOUDY_PCT = 70.0, 35.0
LAST_TRAIN_YEAR = 2023
YEARS_IN_ARCHIVE = 16

# Columns of the statistics and the correlation report, names of the summaries,
# lagged columns. The feature names in the spec below are fixed as well.
BASIC_STATISTICS = (
    "temperature_2m_mean",
    "precipitation_sum",
    "relative_humidity_2m_mean",
    "wind_speed_10m_max",
)
CORRELATED = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "wind_speed_10m_max",
    "relative_humidity_2m_mean",
    "pressure_msl_mean",
    "cloud_cover_mean",
)
SUMMARY_BY_ARCHIVE_YEARS = ("avg_temp_C", "avg_humidity", "avg_annual_rain_mm", "rainy_days_pct")
SUMMARY_BY_SEEN_YEARS = ("avg_temp_C", "avg_humidity", "annual_rain_mm", "rainy_days_pct")

LAGGED = (
    "temperature_2m_mean",
    "relative_humidity_2m_mean",
    "pressure_msl_mean",
    "precipitation_sum",
    "wind_speed_10m_max",
    "cloud_cover_mean",
)

WEATHER = PanelSpec(
    entity="city",
    day="date",
    measures=DAILY_VARIABLES,
    lags=tuple(Lag(c, 1, f"{c}_lag1") for c in LAGGED)
    + (Lag("temperature_2m_mean", 2, "temperature_2m_mean_lag2"),),
    rollings=(
        Rolling("temperature_2m_mean", "avg", 3, "temp_avg_3d"),
        Rolling("temperature_2m_mean", "avg", 7, "temp_avg_7d"),
        Rolling("relative_humidity_2m_mean", "avg", 3, "humidity_avg_3d"),
        Rolling("pressure_msl_mean", "avg", 3, "pressure_avg_3d"),
        Rolling("precipitation_sum", "sum", 7, "rain_sum_7d"),
    ),
    deltas=(Delta("pressure_msl_mean", "pressure_change"),),
    targets=(
        Target("temperature_2m_mean", 1, "temp_tomorrow"),
        Target("precipitation_sum", 1, "rain_tomorrow", threshold=RAIN_MM),
    ),
    exclude=("city", "date", "year", "rain_sum", "temp_tomorrow", "rain_tomorrow"),
    roles=Roles(
        level="temperature_2m_mean",
        high="temperature_2m_max",
        low="temperature_2m_min",
        amount="precipitation_sum",
        humidity="relative_humidity_2m_mean",
        wind="wind_speed_10m_max",
        pressure="pressure_msl_mean",
        cover="cloud_cover_mean",
        amount_total="rain_sum_7d",
        pressure_change="pressure_change",
    ),
    threshold=RAIN_MM,
    last_train_year=LAST_TRAIN_YEAR,
    cover_bands=(CLOUDY_PCT, PARTLY_CLOUDY_PCT),
)
