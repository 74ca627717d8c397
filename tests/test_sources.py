import datetime as dt
import json
from pathlib import Path

import pytest
from panels import assert_same, from_rows, rows_of, to_spark, weather_frame
from pyspark.sql import functions as F

from panelcast import storage
from panelcast.operators.features import build_features
from panelcast.operators.split import time_split
from panelcast.plans.training import baseline_rows
from panelcast.sources import readers, writers
from panelcast.storage import fresh_path
from panelcast.weather import CITIES, DAILY_VARIABLES, WEATHER


@pytest.mark.parametrize("infer", [False, True])
def test_csv_roundtrip(spark, infer):
    frame = weather_frame(days=10)
    path = fresh_path(spark, "csv")
    writers.write_csv(to_spark(spark, frame), path)
    back = readers.read_panel_csv(spark, path, WEATHER, infer=infer)
    assert dict(back.dtypes)["date"] == "date"
    assert_same(back, frame)


def test_csv_with_other_columns_is_refused(spark):
    path = fresh_path(spark, "csv")
    panel = to_spark(spark, weather_frame(days=3)).withColumnRenamed("rain_sum", "snow_sum")
    writers.write_csv(panel, path)
    with pytest.raises(Exception, match="snow_sum"):
        readers.read_panel_csv(spark, path, WEATHER).collect()


def test_sorted_csv_is_in_key_order_over_all_files(spark):
    frame = weather_frame(days=50).sample(frac=1, random_state=0)
    path = fresh_path(spark, "sorted")
    writers.write_sorted_csv(to_spark(spark, frame).repartition(5), path, WEATHER)
    keys = []
    for part in sorted(Path(path).glob("part-*.csv")):
        keys += [tuple(line.split(",")[:2]) for line in part.read_text().splitlines()[1:]]
    assert len(keys) == len(frame) and keys == sorted(keys)


def test_features_by_year_prune_the_split(spark):
    features = build_features(to_spark(spark, weather_frame(days=100)), WEATHER)
    path = fresh_path(spark, "features")
    writers.write_features(features, path, WEATHER)
    assert {p.name for p in Path(path).glob("year=*")} == {"year=2023", "year=2024"}
    back = spark.read.parquet(path).select(*features.columns)
    assert_same(back, features.toPandas())
    _, test = time_split(back, WEATHER)
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_one_folder_per_entity_in_lower_case(spark):
    frame = weather_frame(cities=("Delhi", "PUNE"), days=5)
    path = fresh_path(spark, "entities")
    writers.write_per_entity(to_spark(spark, frame), path, WEATHER)
    assert {p.name for p in Path(path).glob("city_folder=*")} == {
        "city_folder=delhi", "city_folder=pune"
    }
    one = readers.read_panel_csv(spark, f"{path}/city_folder=pune", WEATHER)
    assert_same(one, frame[frame.city == "PUNE"])


def payload(path, name, daily):
    file = Path(path)
    file.mkdir(parents=True, exist_ok=True)
    (file / f"{name}.json").write_text(json.dumps({"latitude": 1.0, "daily": daily}, indent=1))
    return str(file / f"{name}.json")


def test_payload_rows(spark):
    daily = {"time": ["2024-01-01", "2024-01-02"]}
    daily |= {v: [1.5, None] for v in DAILY_VARIABLES}
    path = payload(fresh_path(spark, "payload"), "x", daily)
    raw = readers.read_payloads(spark, path, DAILY_VARIABLES)
    rows = readers.with_entity(
        readers.payload_rows(raw, DAILY_VARIABLES, WEATHER), "Delhi", WEATHER
    )
    assert rows.columns == ["city", "date", *DAILY_VARIABLES]
    got = [tuple(r)[:3] for r in rows.orderBy("date").collect()]
    assert got == [("Delhi", dt.date(2024, 1, 1), 1.5), ("Delhi", dt.date(2024, 1, 2), None)]


def test_ragged_payload_is_refused(spark):
    daily = {"time": ["2024-01-01", "2024-01-02"]} | {v: [1.0, 2.0] for v in DAILY_VARIABLES}
    daily["rain_sum"] = [1.0]
    path = payload(fresh_path(spark, "payload"), "x", daily)
    raw = readers.read_payloads(spark, path, DAILY_VARIABLES)
    with pytest.raises(Exception, match="differ in length"):
        readers.payload_rows(raw, DAILY_VARIABLES, WEATHER).collect()


def test_union_and_dimension(spark):
    a = from_rows(spark, rows_of("Delhi", ["2024-01-01"]))
    b = from_rows(spark, rows_of("Nowhere", ["2024-01-01"])).drop("rain_sum")
    both = readers.union_panels([a, b])
    assert both.where("rain_sum IS NULL").select("city").first()["city"] == "Nowhere"
    dimension = readers.entity_dimension(spark, CITIES, WEATHER)
    assert dimension.count() == 10
    placed = readers.attach_dimension(both, dimension, WEATHER)
    rows = {r["city"]: r["lat"] for r in placed.collect()}
    assert rows == {"Delhi": 28.61, "Nowhere": None}


def test_results_file(spark):
    features = build_features(to_spark(spark, weather_frame(days=100)), WEATHER)
    rows = baseline_rows(time_split(features, WEATHER)[1], WEATHER)
    path = fresh_path(spark, "results")
    writers.write_results(rows, path)
    back = writers.read_results(spark, path)
    assert back.columns[5] == "seconds" and back.where("seconds IS NOT NULL").count() == 0
    want = sorted(map(str, rows.collect()))
    assert sorted(map(str, back.drop("seconds").collect())) == want


def test_inner_panel_from_finer_rows(spark):
    rows = spark.createDataFrame(
        [("A", "2024-01-01 10:00:00", 1.0), ("A", "2024-01-01 20:00:00", 3.0)],
        "k string, t string, v double",
    )
    panel = readers.daily_panel(
        rows, F.col("k"), F.to_date("t"), {"temperature_2m_mean": F.avg("v")}, WEATHER
    )
    assert [tuple(r) for r in panel.collect()] == [("A", dt.date(2024, 1, 1), 2.0)]


class _Remote:
    """A session whose master is a cluster and which names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master, applicationId = "yarn", "x"


def test_shared_folder_is_the_named_one(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(ValueError, match="shared folder"):
        storage.shared_dir(_Remote)
