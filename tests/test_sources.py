"""Reading and publishing, on small files of the real layouts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbalance.functions import dates, nulls
from fieldbalance.schemas import IRRIGATION_DIARY, PET, validate
from fieldbalance.session import new_shared_path, shared_folder, spread
from fieldbalance.sources import climate, headers, published, sheets, tagged

STATION_TEXT = """Station information:
Name\tAgent Number\tNetwork Number\tLatitude (dec.deg)\tLongitude (dec.deg)
Testfield\t123\tH1\t-43.6\t172.4
Note: Position precision types are: "W" = whole minutes,
"G" = derived from gridref.

Evaporation (Penman ET)
Station\tDate(NZST)\tAmount(mm)\tPeriod(Hrs)\tType
123\t2020,07,07,09\t4.6\t24\tP
123\t2020,07,09,09\t-\t24\tP

Rain: Daily
Station\tDate(NZST)\tAmount(mm)\tSofG\tDeficit(mm)\tRunoff(mm)\tPeriod(Hrs)\tFreq
123\t2020,07,07,09\t0.2\t-\t65.6\t0.0\t24\tD
123\t2020,12,31,08\t35.4\t-\t68.4\t0.0\t24\tD

Total number of rows output = 4
"""


def test_station_text(spark, tmp_path):
    (tmp_path / "station.txt").write_text(STATION_TEXT)
    pet, rain = climate.read_station_text(spark, str(tmp_path))
    assert sorted(map(tuple, pet.collect())) == [
        (123, dt.date(2020, 7, 7), 4.6), (123, dt.date(2020, 7, 9), None)]
    assert sorted(map(tuple, rain.collect())) == [
        (123, dt.date(2020, 7, 7), 0.2), (123, dt.date(2020, 12, 31), 35.4)]


def test_sheet_with_preamble(spark, tmp_path):
    (tmp_path / "diary.csv").write_text(
        "Irrigation diary,,,,\nkept by hand,2020,,,\n\nsite_id,crop,date,irrigation_1,irrigation_2\n"
        "S1,Potato,2020-01-05,12.5,\nS1,,2020-01-06,much,3\n")
    rows = sheets.read_sheet(spark, str(tmp_path), IRRIGATION_DIARY, "date").orderBy("date")
    assert [tuple(r) for r in rows.collect()] == [
        ("S1", "Potato", dt.date(2020, 1, 5), 12.5, None),
        ("S1", None, dt.date(2020, 1, 6), None, 3.0)]


def test_header_repair():
    assert headers.repair_names(["Crop", "Irrigation", "", "N rate", "Irrigation", None]) == [
        "Crop", "Irrigation...2", "...3", "N.rate", "Irrigation...5", "...6"]
    assert headers.repair_names(["(y)", "_z", ".2fa", "FALSE", "2"]) == [
        ".y.", "._z", "..2fa", ".FALSE", "...2"]


def test_select_by_regex_takes_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF(
        "Irrigation...1", "VWC_0_20", "...3")
    assert headers.select_by_regex(df, r"^\w").columns == ["Irrigation...1", "VWC_0_20"]


def test_tagged_files(spark, tmp_path):
    for stem, value in (("A_Onion_Sunscan", 1), ("A_Onion_Greenseeker", 2),
                        ("B_Wheat_Greenseeker", 3)):
        (tmp_path / f"{stem}.csv").write_text(f"{value}\n")
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    got = tagged.read_tagged(spark, str(tmp_path), schema, ["Onion", "Wheat", "Potato"],
                             ["Greenseeker"], fmt="csv")
    assert sorted(map(tuple, got.collect())) == [
        ("A", "Onion", "Greenseeker", 2), ("B", "Wheat", "Greenseeker", 3)]
    for folders in (False, True):
        none = tagged.read_tagged(spark, str(tmp_path), schema, ["Broccoli"], ["Sunscan"],
                                  fmt="csv", one_folder_each=folders)
        assert none.columns == ["site_id", "crop", "sensor", "x"] and none.count() == 0


def test_publish_replaces(spark):
    path = new_shared_path(spark, "t")
    for n in (5, 3):
        published.publish(spark.range(n), path)
    assert published.read_published(spark, path).count() == 3
    published.publish(spark.range(4).withColumn("site_id", F.lit("a")), path, ["site_id"])
    assert published.read_published(spark, path).count() == 4
    published.publish_table(spark.range(2), "published_rows")
    published.publish_table(spark.range(7), "published_rows")
    assert spark.table("published_rows").count() == 7


def test_publish_needs_a_table():
    for call in (lambda: published.publish(None, "x"), lambda: published.publish_table(None, "x"),
                 lambda: published.publish_jdbc(None, "x", "y")):
        with pytest.raises(ValueError):
            call()


def test_station_period(spark):
    rows = spark.createDataFrame(
        [("A", dt.date(2020, 1, d), 1.0) for d in (1, 2, 3)] + [("A", dt.date(2999, 1, 1), 1.0),
                                                              ("B", dt.date(2020, 1, 1), 1.0)],
        "site_id string, date date, pet double")
    assert climate.station_period(rows, "2020-01-02", F.col("site_id") == "A").count() == 2
    starts = spark.createDataFrame([("A", dt.date(2020, 1, 3))], "site_id string, start_date date")
    assert climate.station_period(rows, starts).count() == 1


def test_validate(spark):
    good = spark.createDataFrame([(1.0, dt.date(2020, 1, 1), "S", 2)],
                                 "pet double, date date, site_id string, more int")
    assert validate(good, PET).columns == ["site_id", "date", "pet"]
    with pytest.raises(ValueError, match="pet: want double, have string"):
        validate(good.withColumn("pet", F.col("pet").cast("string")), PET)
    with pytest.raises(ValueError, match="have nothing"):
        validate(good.drop("pet"), PET)


def test_local_date_rolls_over(spark):
    df = spark.sql("SELECT timestamp '2024-01-01 20:00:00' AS date")
    assert dates.with_local_date(df).collect()[0].date == dt.date(2024, 1, 2)
    already = spark.sql("SELECT date '2024-01-01' AS date")
    assert dates.with_local_date(already).collect()[0].date == dt.date(2024, 1, 1)
    with pytest.raises(ValueError):
        dates.with_local_date(df.withColumnRenamed("date", "when"))


def test_unparsable_date_is_missing(spark):
    df = spark.createDataFrame([("2020,01,05,08",), ("soon",)], "t string")
    got = [r[0] for r in df.select(dates.parsed_date("t", "yyyy,MM,dd,HH")).collect()]
    assert got == [dt.date(2020, 1, 5), None]


def test_null_rules(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(nulls.strict_least("a", "b")).collect()] == [None, 3.0]
    assert [r[0] for r in df.select(nulls.strict_greatest("a", "b")).collect()] == [None, 4.0]
    assert df.filter("b is null").agg(nulls.total("b")).collect()[0][0] == 0.0
    assert df.filter(nulls.not_in_or_null("b", [3.0])).count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_spread_leaves_a_wide_scan_alone(spark):
    assert spread(spark.range(100, numPartitions=9)).rdd.getNumPartitions() == 9
    assert spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 4


def test_tagged_folders_are_made_by_many_tasks_and_listed_by_few(spark, tmp_path):
    path = str(tmp_path / "folders")
    rows = spark.range(120).selectExpr("concat('S', id) AS site_id", "'Wheat' AS crop", "'Sunscan' AS sensor", "id")
    tagged.write_tagged(rows, path)
    tasks = {f.split("part-")[1][:5] for f in spark.read.parquet(path).inputFiles()}
    assert len(tasks) >= spark.sparkContext.defaultParallelism
    before = spark.conf.get(tagged.LISTING)
    schema = spark.createDataFrame([], "id long").schema
    jobs = []

    def load():
        jobs.append(int(spark.conf.get(tagged.LISTING)))
        return spark.read.schema(schema).parquet(path)

    assert tagged._listed(spark, load).count() == 120
    assert jobs == [4 * spark.sparkContext.defaultParallelism] and spark.conf.get(tagged.LISTING) == before
    got = tagged.read_tagged(spark, path, schema, ["Wheat"], ["Sunscan"], one_folder_each=True)
    assert sorted((r.site_id, r.id) for r in got.collect()) == sorted((f"S{i}", i) for i in range(120))
