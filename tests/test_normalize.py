from datetime import datetime

import pytest
from pyspark.sql import functions as F

from croptide.operators import filters, normalize, temporal


def test_time_names(spark):
    df = spark.range(1).selectExpr("1 AS x", "2 AS Run_Time", "3 AS time")
    assert normalize.normalize_time(df, "time").columns == ["x", "Run_Time", "time"]
    assert normalize.normalize_time(df).columns == ["x", "valid_time", "time"]
    with pytest.raises(ValueError):
        normalize.normalize_time(df.select("x"))
    assert normalize.find_time(["Day"], "time", ("time", "day", "date")) == "Day"


def test_coordinate_names(spark):
    df = spark.range(1).selectExpr("1 AS LAT", "2 AS Lon", "3 AS v")
    assert normalize.normalize_coords(df).columns == ["latitude", "longitude", "v"]
    odd = df.withColumnsRenamed({"LAT": "cell_lat", "Lon": "longit"})
    with pytest.raises(ValueError, match="latitude or longitude"):
        normalize.normalize_coords(odd)
    assert normalize.normalize_coords(odd, "substring").columns[:2] == [
        "latitude", "longitude"]
    both = spark.range(1).selectExpr("1 AS plateau", "2 AS latitude", "3 AS longitude")
    assert normalize.normalize_coords(both, "substring").columns == both.columns


def test_pick_variable_prefers_aliases_then_the_first_column(spark):
    df = spark.range(1).selectExpr("1 AS valid_time", "2 AS q", "3 AS tmax", "4 AS t2mmax")
    assert normalize.pick_variable(df, "tmax").first()["tmax"] == 4
    with pytest.warns(UserWarning, match="using 'q'"):
        assert normalize.pick_variable(df, "soil").first()["soil"] == 2
    with pytest.raises(ValueError, match="no data column"):
        normalize.pick_variable(df.select("valid_time"), "tmax")


def test_validate_time(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1),), (None,)], "valid_time timestamp_ntz")
    with pytest.raises(ValueError, match="missing timestamps"):
        normalize.validate_time(df)
    assert normalize.validate_time(df.dropna()).count() == 1


def test_wrap_longitude(spark):
    df = spark.createDataFrame([(0.0,), (90.0,), (180.0,), (181.0,), (359.5,)],
                               "longitude double")
    got = [r[0] for r in normalize.wrap_longitude(df).collect()]
    assert got == [0.0, 90.0, -180.0, -179.0, -0.5]
    up_to_180 = df.filter("longitude <= 180")
    assert normalize.wrap_longitude(up_to_180) is up_to_180
    mixed = df.withColumn("longitude", F.col("longitude") - 10)
    assert normalize.wrap_longitude(mixed) is mixed


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_utc_date_does_not_depend_on_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2020-07-01 12:00:00.25' AS t")
        micros = F.unix_micros("Date")
        naive = normalize.to_utc_date(df, "t").select(micros).first()[0]
        local = normalize.to_utc_date(df, "t", "America/Chicago").select(micros).first()[0]
        instant = normalize.to_utc_date(
            spark.sql("SELECT TIMESTAMP'2020-07-01 12:00:00.25+00:00' AS t"), "t",
            "America/Chicago").select(micros).first()[0]
        text = normalize.to_utc_date(
            spark.sql("SELECT '2020-07-01 12:00:00.25' AS t"), "t").select(micros).first()[0]
        days = normalize.to_utc_date(
            spark.sql("SELECT DATE'2020-07-01' AS t"), "t").select(micros).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert naive == instant == text == 1593604800250000
    assert local == naive + 5 * 3600 * 10**6
    assert days == 1593561600000000


def test_intervals_to_seconds(spark):
    df = spark.sql("""
        SELECT INTERVAL '1 02:00:00.5' DAY TO SECOND AS Heat_KS, '7' AS Heat_ND,
               'x' AS Heat_MT, 3 AS Heat_OK, 'keep' AS Other_KS,
               INTERVAL '2' HOUR AS Heat""")
    row = normalize.intervals_to_seconds(df, ["Heat", "Absent"]).first()
    assert (row["Heat_KS"], row["Heat_ND"], row["Heat_MT"], row["Heat_OK"]) == (
        93600.5, 7.0, None, 3)
    assert row["Other_KS"] == "keep" and row["Heat"].total_seconds() == 7200


def frame(spark):
    return spark.createDataFrame(
        [(1, datetime(2019, 12, 31, 23, 59), 10.0, 20.0, 850, "a"),
         (2, datetime(2020, 1, 1, 0, 0), 10.0, 20.0, 500, "b"),
         (3, datetime(2020, 2, 29, 6, 30), 49.0, -100.0, 850, "a"),
         (4, datetime(2021, 12, 31, 23, 59, 59), 50.0, -100.0, 700, "c"),
         (5, datetime(2022, 1, 1, 0, 0), 24.0, -66.0, 850, "a")],
        "i int, valid_time timestamp_ntz, latitude double, longitude double, "
        "level int, product_type string")


def ids(df):
    return sorted(r["i"] for r in df.collect())


def test_filters(spark):
    df = frame(spark)
    assert ids(filters.filter_bbox(df, [49.0, -125.0, 10.0, 20.0])) == [1, 2, 3, 5]
    assert ids(filters.filter_bbox(df, [49.0, -125.0, 24.5, 19.0])) == [3]
    assert ids(filters.filter_calendar(df, 2020, 2021)) == [2, 3, 4]
    assert ids(filters.filter_calendar(df, 2019, 2022, months=["12"], days=[31])) == [1, 4]
    assert ids(filters.filter_times(df, ["06:30", "23:59"])) == [1, 3, 4]
    assert ids(filters.filter_level(df, 850)) == [1, 3, 5]
    assert ids(filters.filter_level(df, [500, 700])) == [2, 4]
    assert ids(filters.filter_product(df, "a")) == [1, 3, 5]
    days = df.withColumn("date", F.to_date("valid_time"))
    assert ids(filters.clip_dates(days, "2020-01-01", "2021-12-31")) == [2, 3, 4]


def test_calendar_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark).withColumn("year", F.year("valid_time")).write.partitionBy("year").parquet(path)
    df = filters.filter_calendar(spark.read.parquet(path), 2020, 2021)
    assert ids(df) == [2, 3, 4]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(valid_time" in plan


def test_daily_statistic_shifts_the_day(spark):
    df = spark.createDataFrame(
        [(0, 0, datetime(2020, 1, 2, 4, 59), 1.0), (0, 0, datetime(2020, 1, 2, 5, 0), 3.0),
         (0, 0, datetime(2020, 1, 3, 4, 0), 7.0), (0, 0, datetime(2020, 1, 3, 4, 1), None)],
        "lat_i int, lon_i int, valid_time timestamp_ntz, x double")
    out = temporal.daily_statistic(df, "x", "daily_mean", "utc-05:00")
    assert {str(r["date"]): r["x"] for r in out.collect()} == {
        "2020-01-01": 1.0, "2020-01-02": 5.0}
    east = temporal.daily_statistic(df, "x", "daily_maximum", "UTC+05:30")
    assert {str(r["date"]): r["x"] for r in east.collect()} == {
        "2020-01-02": 3.0, "2020-01-03": 7.0}
    with pytest.raises(ValueError):
        temporal.daily_statistic(df, "x", "daily_mode")
    with pytest.raises(ValueError):
        temporal.parse_utc_offset("EST")


def test_subsample(spark):
    df = spark.createDataFrame([(h, datetime(2020, 1, 1, h, 5)) for h in range(24)],
                               "i int, valid_time timestamp_ntz")
    assert ids(temporal.subsample(df, "6_hourly")) == [0, 6, 12, 18]
    assert ids(temporal.subsample(df, "3h")) == list(range(0, 24, 3))
    assert ids(temporal.subsample(df, 1)) == list(range(24))
    with pytest.raises(ValueError):
        temporal.subsample(df, "0h")
