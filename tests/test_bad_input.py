"""Input that cannot be read fails, and special values have defined results."""

import pytest
from pyspark.sql import functions as F

from panelcast.operators.metrics import regression_columns
from panelcast.operators.summary import correlations
from panelcast.sources.readers import payload_rows, read_panel_csv, read_payloads
from panelcast.weather import WEATHER

GOOD = '{"daily": {"time": ["2024-01-01"], "t": [1.5]}}'


@pytest.mark.parametrize("bad", ['{"error": true}', '{"daily": {"time": ["2024-01', '{"daily": {"t": [1.0]}}'])
def test_bad_payloads_fail(spark, tmp_path, bad):
    (tmp_path / "a.json").write_text(GOOD)
    assert payload_rows(read_payloads(spark, str(tmp_path), ["t"]), ["t"], WEATHER).count() == 1
    (tmp_path / "b.json").write_text(bad)
    with pytest.raises(Exception, match="daily.time|MALFORMED|Malformed|FAILED_READ"):
        payload_rows(read_payloads(spark, str(tmp_path), ["t"]), ["t"], WEATHER).collect()


@pytest.mark.parametrize("column, cell", [("date", "2024-13-45"), ("last", "oops")])
def test_unreadable_cells_fail(spark, tmp_path, column, cell):
    names = WEATHER.schema().names
    row = ["A", "2024-01-01", *["1.0"] * (len(names) - 2)]
    row[1 if column == "date" else -1] = cell
    (tmp_path / "x.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ"):
        read_panel_csv(spark, str(tmp_path / "x.csv"), WEATHER).collect()


def test_correlation_skips_nan_and_null(spark):
    rows = [(1.0, 2.0), (2.0, float("nan")), (3.0, 5.0), (4.0, 4.0), (None, 9.0)]
    found = correlations(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).first()
    assert found["corr"] == pytest.approx(0.7857142857)


def test_r2_of_a_constant_label(spark):
    for predictions, want in (([1.0, 1.0], 1.0), ([1.0, 2.0], 0.0)):
        rows = spark.createDataFrame([(1.0, p) for p in predictions], "y double, p double")
        assert rows.agg(regression_columns("y", "p")["R2"].alias("r")).select(F.col("r")).first()[0] == want
