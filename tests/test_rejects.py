"""Lines that cannot be used come out with file and reason, or stop the read."""

import datetime as dt

import pytest

from fieldbalance.functions.nulls import to_number
from fieldbalance.schemas import IRRIGATION_DIARY
from fieldbalance.sources import climate, rejects, sheets

STATION = """Station information: somewhere
Station\tDate(NZST)\tAmount(mm)\tPeriod(Hrs)\tType
12\t2020,01,02,08\t3.5\t24\tP
12\t2020,01,03,08\t-\t24\tP
12\t2020,01,04,08\tNaN\t24\tP
12\t2020,01,05,08\t4.5\t24\tP\tmore
?\t2020,01,06,08\t4.5\t24\tP
12\t2020,02,31,08\t4.5\t24\tP
12\t2020,01,02,08\t-1d\t-\t0.0\t0.0\t24\tD
12\t2020,01,03,08\t7.0\t-\t0.0\t0.0\t24\tD
Total number of rows output = 8
"""


def test_station_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text(STATION)
    found = rejects.read_station_text_checked(spark, str(tmp_path), max_rejected=0.7)
    assert sorted(map(tuple, found.pet.collect()), key=str) == [
        (12, dt.date(2020, 1, 2), 3.5), (12, dt.date(2020, 1, 3), None)]
    assert [tuple(r) for r in found.rain.collect()] == [(12, dt.date(2020, 1, 3), 7.0)]
    got = found.rejects.collect()
    assert sorted(r.reason for r in got) == ["amount", "amount", "date", "fields", "station"]
    assert all(r.file.endswith("a.txt") and r.line in STATION for r in got)
    assert found.counts == {"pet": 2, "rain": 1, "rejects": 5}


def test_too_many_rejects_raise(spark, tmp_path):
    (tmp_path / "a.txt").write_text(STATION)
    with pytest.raises(ValueError, match="5 of 8 lines"):
        rejects.read_station_text_checked(spark, str(tmp_path))


def test_text_without_data(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Station information: somewhere\n\n")
    found = rejects.read_station_text_checked(spark, str(tmp_path))
    assert found.pet.count() == found.rain.count() == found.rejects.count() == 0


def test_sheet_cells_and_keys(spark, tmp_path):
    (tmp_path / "d.csv").write_text(
        "Diary of S1\nsite_id,crop,date,irrigation_1,irrigation_2\n"
        "S1,Wheat,2020-01-02,5.0,\nS1,Wheat,2020-13-02,5.0,1.0\nS1,Wheat,2020-01-04,NaN,12d\n"
        "S1,,,,\nS1,Wheat,2020-01-05, ,7\n")
    found = rejects.read_sheet_checked(spark, str(tmp_path), IRRIGATION_DIARY, "date", max_rejected=0.5)
    rows = {r.date.day: (r.irrigation_1, r.irrigation_2) for r in found.rows.collect()}
    assert rows == {2: (5.0, None), 4: (None, None), 5: (None, 7.0)}
    assert found.rows.schema.simpleString() == IRRIGATION_DIARY.simpleString()
    assert sorted(r.reason for r in found.rejects.collect()) == ["date", "irrigation_1", "irrigation_2"]
    plain = sheets.read_sheet(spark, str(tmp_path), IRRIGATION_DIARY, "date")
    assert plain.exceptAll(found.rows).count() == found.rows.exceptAll(plain).count() == 0


@pytest.mark.parametrize("text,value", [
    ("12", 12.0), (" -1.5e3 ", -1500.0), (".5", 0.5), ("5.", 5.0), ("NaN", None), ("Infinity", None),
    ("12d", None), ("3f", None), ("n/a", None), ("", None), (None, None), ("1,5", None), ("0x1p3", None)])
def test_number_text(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_number("t")).collect()[0][0] == value


def test_stored_weather_is_pruned_by_the_start_table(spark, tmp_path):
    days = spark.sql("""SELECT concat('S', s) AS site_id, date_add(date'2020-01-01', cast(d AS int)) AS date,
                          cast(d AS double) AS pet
                        FROM (SELECT explode(sequence(1, 20)) AS s), (SELECT explode(sequence(0, 30)) AS d)""")
    climate.store_by_station(days, str(tmp_path / "weather"))
    spark.createDataFrame([(f"S{i}", dt.date(2020, 1, 10 + i), i) for i in range(1, 21)],
                          "site_id string, start_date date, wet int").write.parquet(str(tmp_path / "starts"))
    starts = spark.read.parquet(str(tmp_path / "starts")).filter("wet = 3").select("site_id", "start_date")
    got = climate.stored_period(spark, str(tmp_path / "weather"), "date date, pet double, site_id string", starts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert {r.site_id for r in got.collect()} == {"S3"} and got.count() == 19


def test_lines_are_stored_as_they_come(spark, tmp_path):
    """No folder per kind: a task would sort all its lines in memory for it."""
    (tmp_path / "station.txt").write_text("123\t2020,07,07,09\t4.6\t24\tP\n123\tx\t4.6\t24\tP\n")
    found = rejects.read_station_text_checked(spark, str(tmp_path), max_rejected=0.5)
    assert (found.pet.count(), found.rain.count(), found.rejects.count()) == (1, 0, 1)
    assert not any("kind=" in f for f in found.rejects.inputFiles())
