import pytest

from panelcast.sources import quarantine
from panelcast.sources.readers import read_panel_csv
from panelcast.weather import WEATHER

NAMES = WEATHER.schema().names


def line(city="A", day="2024-01-01", **cells):
    values = {n: "1.5" for n in NAMES} | {"city": city, "date": day} | cells
    return ",".join(values[n] for n in NAMES)


def write(path, *lines):
    path.write_text("\n".join([",".join(NAMES), *lines]) + "\n")


def faults_of(found):
    return sorted((r["column"] or "", r["reason"], r["value"] or "") for r in found.faults.collect())


def test_good_rows_and_faults_from_one_read(spark, tmp_path):
    write(tmp_path / "a.csv", line(), line(day="2024-02-30"), line(rain_sum="wet", cloud_cover_mean=""), line(city=""))
    write(tmp_path / "b.csv", line(day="2024-01-02"), "A,2024-01-03,1", line() + ",9", line(day="today"), line(rain_sum="", day="2024-01-04"))
    found = quarantine.read_panel_csv(spark, str(tmp_path), WEATHER)
    good = found.good.orderBy("date").collect()
    assert [str(r.date) for r in good] == ["2024-01-01", "2024-01-02", "2024-01-04"] and good[2].rain_sum is None
    assert found.good.schema == WEATHER.schema()
    assert faults_of(found) == sorted(
        [
            ("date", "not a day", "2024-02-30"),
            ("date", "not a day", "today"),
            ("rain_sum", "not a number", "wet"),
            ("city", "missing", ""),
            ("", "malformed record", "A,2024-01-03,1"),
            ("", "malformed record", line() + ",9"),
        ]
    )
    files = {r["file"].rsplit("/", 1)[1]: r["record"] for r in found.faults.where("value = 'wet'").collect()}
    assert files == {"a.csv": line(rain_sum="wet", cloud_cover_mean="")}


def test_clean_files_read_as_the_strict_reader_does(spark, tmp_path):
    write(tmp_path / "a.csv", line(), line(city="B", rain_sum="-0.5"), line(city="C", rain_sum="NaN"))
    found = quarantine.read_panel_csv(spark, str(tmp_path), WEATHER)
    strict = read_panel_csv(spark, str(tmp_path), WEATHER)
    assert found.faults.count() == 0
    assert sorted(map(str, found.good.collect())) == sorted(map(str, strict.collect()))


def test_another_header_fails_as_a_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(Exception, match="header|Header|CSV"):
        quarantine.read_panel_csv(spark, str(tmp_path), WEATHER)


@pytest.mark.parametrize("multi_line", [True, False])
def test_payloads(spark, tmp_path, multi_line):
    documents = {
        "good": '{"city": "good", "daily": {"time": ["2024-01-01", "2024-01-02"], "t": [1.5, null]}}',
        "cut": '{"city": "cut", "daily": {"time": ["2024-01',
        "typed": '{"city": "typed", "daily": {"time": ["2024-01-01"], "t": "x"}}',
        "none": '{"city": "none", "daily": {"t": [1.0]}}',
        "empty": '{"city": "empty", "daily": {"time": [], "t": []}}',
        "other": '{"city": "other", "error": true}',
        "ragged": '{"city": "ragged", "daily": {"time": ["2024-01-01"], "t": [1.0, 2.0]}}',
        "lacking": '{"city": "lacking", "daily": {"time": ["2024-01-01"]}}',
        "days": '{"city": "days", "daily": {"time": ["2024-01-01", "2024-1-2", null, "2024-02-30"], "t": [1, 2, 3, 4]}}',
    }
    if multi_line:
        for name, text in documents.items():
            (tmp_path / f"{name}.json").write_text(text)
    else:
        (tmp_path / "all.json").write_text("\n".join(documents.values()) + "\n")
    found = quarantine.read_payloads(spark, str(tmp_path), ["t"], WEATHER, "city", multi_line)
    assert sorted((r.city, str(r.date), r.t) for r in found.good.collect()) == [("good", "2024-01-01", 1.5), ("good", "2024-01-02", None)]
    listed = sorted((r["record"] or "", r["column"] or "", r["reason"], r["value"] or "") for r in found.faults.collect())
    assert [x for x in listed if x[2] != "malformed record"] == sorted(
        [
            ("none", "time", "no days", ""),
            ("empty", "time", "no days", ""),
            ("other", "time", "no days", ""),
            ("ragged", "t", "length differs from time", "2"),
            ("lacking", "t", "length differs from time", "0"),
            ("days", "time", "not a day", "2024-1-2"),
            ("days", "time", "not a day", ""),
            ("days", "time", "not a day", "2024-02-30"),
        ]
    )
    broken = [x[3] for x in listed if x[2] == "malformed record"]
    assert sorted(b.strip() for b in broken) == sorted([documents["cut"], documents["typed"]])
