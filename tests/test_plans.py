import shutil
from datetime import date, datetime, timedelta

import pytest
from helpers import day
from pyspark.sql import functions as F

from croptide.constants import INPUT_FOLDERS, VARIABLE_ALIASES
from croptide.operators.indices import compute_indices
from croptide.plans import (
    belt_series,
    compute_index_store,
    load_observations,
    predictor_methods,
    predictor_run,
    process_regions_daily,
    weekly_predictors,
)
from croptide.sinks import RequestMismatch, write_index_store


def write_inputs(spark, base, days=40, skip=()):
    """Seven folders over 3 x 3 cells; soil has 2 x 2 and one day more."""
    for n, (key, folder) in enumerate(INPUT_FOLDERS.items()):
        if key in skip:
            continue
        step, extra = (2, 1) if key == "soil" else (1, 0)
        rows = [(datetime(2020, 1, 1) + timedelta(days=d), float(y), float(x),
                 280.0 + y + 2 * x + d + n)
                for d in range(days + extra) for y in range(0, 3, step)
                for x in range(0, 3, step)]
        name = VARIABLE_ALIASES[key][0]
        spark.createDataFrame(
            rows, f"valid_time timestamp_ntz, latitude double, longitude double, {name} double"
        ).write.parquet(f"{base}/{folder}")


def test_index_run(spark, tmp_path):
    base, store, stages = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "st")
    write_inputs(spark, base)
    assert compute_index_store(spark, base, store, stage_dir=stages) == store
    out = spark.read.parquet(store)
    assert out.count() == 40 * 9
    row = out.filter("date = '2020-01-11' AND lat = 1 AND lon = 1").first()
    # tmax and tmin differ by one: their mean in °C less the base of ten.
    assert row["GDD"] == pytest.approx(293.5 - 273.15 - 10, abs=1e-4)
    assert row["SoilMoistureAnomaly"] == 0.0
    assert not list((tmp_path / "st").glob("stage_*"))


def test_index_run_resumes_from_a_finished_stage(spark, tmp_path):
    base, stages = str(tmp_path / "in"), str(tmp_path / "st")
    write_inputs(spark, base)
    marked = spark.createDataFrame(
        [(day(d), y, x, float(y), float(x), None) for d in range(40)
         for y in range(3) for x in range(3)],
        "date date, lat_i int, lon_i int, lat double, lon double, value double")

    def unfinished():
        """A run that failed after its stage: the store's path is a file."""
        (tmp_path / "file").write_text("")
        with pytest.raises(Exception, match="file"):
            compute_index_store(spark, base, str(tmp_path / "file" / "x"), stage_dir=stages)
        (stage,) = (tmp_path / "st").glob("stage_cube_soil_*")
        marked.write.mode("overwrite").parquet(str(stage))

    unfinished()
    compute_index_store(spark, base, str(tmp_path / "a"), stage_dir=stages)
    assert spark.read.parquet(str(tmp_path / "a")).agg(
        F.count("SoilMoistureAnomaly")).first()[0] == 0
    unfinished()
    compute_index_store(spark, base, str(tmp_path / "b"), stage_dir=stages,
                        force_recompute=True)
    assert spark.read.parquet(str(tmp_path / "b")).agg(
        F.count("SoilMoistureAnomaly")).first()[0] == 360


def test_index_run_may_resume_after_assembly(spark, tmp_path):
    base, stages = str(tmp_path / "in"), tmp_path / "st"
    write_inputs(spark, base, 12)
    (tmp_path / "file").write_text("")
    with pytest.raises(Exception, match="file"):
        compute_index_store(spark, base, str(tmp_path / "file" / "x"), stage_dir=str(stages),
                            stage_assembled=True)
    assert len(list(stages.glob("stage_cube_assembled_*"))) == 1
    compute_index_store(spark, base, str(tmp_path / "a"), stage_dir=str(stages),
                        stage_assembled=True)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 12 * 9
    assert not list(stages.glob("stage_*"))


def test_stages_of_other_inputs_are_not_reused(spark, tmp_path):
    from croptide.sinks import fingerprint

    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    spark.range(3).write.parquet(one)
    spark.range(4).write.parquet(two)
    a, b = spark.read.parquet(one), spark.read.parquet(two)
    assert fingerprint(a, (1, 2)) == fingerprint(spark.read.parquet(one), (1, 2))
    assert len({fingerprint(a, (1, 2)), fingerprint(b, (1, 2)), fingerprint(a, (1, 3))}) == 3
    x = spark.createDataFrame([(1,)], "a int")
    assert fingerprint(x) != fingerprint(spark.createDataFrame([(2,)], "a int"))


def test_rows_without_a_place_stop_the_run(spark):
    from croptide.plans.indices import assemble_inputs

    rows = [(day(0), 1.0, 2.0, 3.0), (day(0), None, 2.0, 3.0)]
    grid = spark.createDataFrame(rows, "valid_time date, latitude double, longitude double, tmax double")
    with pytest.raises(ValueError, match="latitude"):
        assemble_inputs(spark, {"tmax": grid})


def test_index_run_stops_on_a_missing_input(spark, tmp_path):
    base = str(tmp_path / "in")
    write_inputs(spark, base, 3, skip=("evap",))
    assert compute_index_store(spark, base, str(tmp_path / "out")) is None
    assert not (tmp_path / "out").exists()


def store_and_outlines(spark, tmp_path, shift=0.0):
    rows = [(day(d), y, x, 40.0 + y, 258.0 + x + shift, 300.0 + d + x)
            for d in range(3) for y in range(2) for x in range(4)]
    df = spark.createDataFrame(
        rows, "date date, lat_i int, lon_i int, lat double, lon double, tmax double")
    df = df.withColumns({"tmin": F.col("tmax"), "u_wind": F.lit(3.0), "v_wind": F.lit(4.0)})
    write_index_store(compute_indices(df, ["GDD", "WindSpeed"]), str(tmp_path / "store"))
    west, east = -102.5, -100.5
    spark.createDataFrame(
        [(1, "KS", [(west, 39.0), (east, 39.0), (east, 42.0), (west, 42.0)]),
         (2, "ND", [(east, 39.0), (east + 1, 39.0), (east + 1, 42.0), (east, 42.0)])],
        "region int, region_abbr string, ring array<struct<x:double,y:double>>",
    ).write.parquet(str(tmp_path / "regions"))
    return str(tmp_path / "store"), str(tmp_path / "regions")


def test_regional_run_wraps_longitudes(spark, tmp_path):
    store, outlines = store_and_outlines(spark, tmp_path)
    out = process_regions_daily(spark, store, outlines, str(tmp_path / "o"), "daily",
                                interval_roots=["HeatwaveIndex"], save_csv=True)
    assert out["status"] == "success" and out["output_csv_path"]
    wide = spark.read.parquet(out["output_parquet_path"]).orderBy("Date")
    assert wide.columns == ["Date", "GDD_KS", "GDD_ND", "WindSpeed_KS", "WindSpeed_ND"]
    rows = wide.collect()
    assert [r["Date"].date() for r in rows] == [day(0), day(1), day(2)]
    # Cells −102 and −101 are in KS, −100 in ND, −99 in none.
    assert rows[0]["GDD_KS"] == pytest.approx(300.5 - 283.15, abs=1e-4)
    assert rows[2]["GDD_ND"] == pytest.approx(304.0 - 283.15, abs=1e-4)


def test_regional_run_with_key_regions(spark, tmp_path):
    store, outlines = store_and_outlines(spark, tmp_path)
    only = process_regions_daily(spark, store, outlines, str(tmp_path / "o"), "k",
                                 method="max", key_regions=["ND", "XX"])
    wide = spark.read.parquet(only["output_parquet_path"])
    assert wide.columns == ["Date", "GDD_ND", "WindSpeed_ND"]
    none = process_regions_daily(spark, store, outlines, str(tmp_path / "o"), "n",
                                 key_regions=["XX"])
    assert none["status"] == "success" and none["output_parquet_path"] is None


def test_regional_run_reports_errors(spark, tmp_path):
    out = process_regions_daily(spark, str(tmp_path / "none"), "x", str(tmp_path), "b")
    assert out["status"] == "error" and "no grid files" in out["message"]
    store, outlines = store_and_outlines(spark, tmp_path)
    out = process_regions_daily(spark, store, outlines, str(tmp_path), "b", method="mode")
    assert out["status"] == "error" and "unknown method" in out["message"]


def test_observations_skip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "obs")
    obs = spark.createDataFrame(
        [(datetime(y, 1, 2, h), 45.0, -100.0, 10.0 * (y - 2019) + h)
         for y in (2020, 2021) for h in (6, 7, 12)],
        "valid_time timestamp_ntz, latitude double, longitude double, t2m double")

    def load(df, **kw):
        load_observations(df, path, "t2m", 2020, 2021, "daily_mean", "utc-05:00",
                          frequency="6_hourly", bbox=[50.0, -120.0, 20.0, -60.0], **kw)
        return {r["year"]: r["value"] for r in spark.read.parquet(path).collect()}

    assert load(obs.filter("valid_time < '2021-01-01'")) == {2020: 19.0}
    more = obs.withColumn("t2m", F.col("t2m") * 100)
    assert load(more) == {2020: 19.0, 2021: 2900.0}
    assert load(more, overwrite=True) == {2020: 1900.0, 2021: 2900.0}


@pytest.mark.parametrize("zone", ["utc-05:00", "utc+09:00"])
@pytest.mark.parametrize("years", [(2023, 2024), (2024, 2023)])
@pytest.mark.parametrize("overwrite", [False, True])
def test_loads_of_neighbouring_years(spark, tmp_path, zone, years, overwrite):
    path = str(tmp_path / "obs")
    hours = spark.sql("""SELECT explode(sequence(TIMESTAMP_NTZ '2022-12-30 00:00:00',
        TIMESTAMP_NTZ '2025-01-03 00:00:00', INTERVAL 3 HOURS)) AS valid_time""")
    obs = hours.selectExpr("valid_time", "1D AS latitude", "2D AS longitude", "3D AS t2m")
    for year in years:
        load_observations(obs, path, "t2m", year, year, "daily_sum", zone, overwrite=overwrite)
    got = spark.read.parquet(path).groupBy("year").agg(
        F.countDistinct("date").alias("days"), F.sum("value").alias("total")).collect()
    assert {r["year"]: (r["days"], r["total"]) for r in got} == {
        2023: (365, 365 * 24.0), 2024: (366, 366 * 24.0)}


def test_loads_of_other_levels(spark, tmp_path):
    path = str(tmp_path / "obs")
    obs = spark.createDataFrame(
        [(datetime(2020, 1, 2, 6), 1.0, 2.0, level, float(level)) for level in (500, 850)],
        "valid_time timestamp_ntz, latitude double, longitude double, level int, t double")
    for overwrite in (False, True):
        for level in (500, 850):
            load_observations(obs, path, "t", 2020, 2020, overwrite=overwrite,
                              pressure_level=level)
        assert sorted((r["level"], r["value"]) for r in spark.read.parquet(path).collect()) == [
            (500, 500.0), (850, 850.0)]


def products(spark):
    return spark.createDataFrame(
        [(datetime(2020, 1, d, h), 1.0, 2.0, kind, scale * (d + h))
         for d in (2, 20) for h in (6, 12) for kind, scale in (("reanalysis", 1.0),
                                                               ("ensemble_members", 100.0))],
        "valid_time timestamp_ntz, latitude double, longitude double, product_type string, "
        "t double")


def loaded(spark, path):
    return {(r["statistic"], r["product_type"], r["date"].day): r["value"]
            for r in spark.read.parquet(path).collect()}


@pytest.mark.parametrize("order", [1, -1])
def test_another_statistic_or_product_is_stored_as_well(spark, tmp_path, order):
    path, obs = str(tmp_path / "obs"), products(spark)
    requests = [{"daily_stat": "daily_mean"}, {"daily_stat": "daily_max"},
                {"daily_stat": "daily_mean", "product_type": "ensemble_members"}]
    for request in requests[::order]:
        load_observations(obs, path, "t", 2020, 2020, **request)
    assert loaded(spark, path) == {
        ("daily_mean", "reanalysis", 2): 11.0, ("daily_mean", "reanalysis", 20): 29.0,
        ("daily_maximum", "reanalysis", 2): 14.0, ("daily_maximum", "reanalysis", 20): 32.0,
        ("daily_mean", "ensemble_members", 2): 1100.0,
        ("daily_mean", "ensemble_members", 20): 2900.0}


def test_requests_are_compared_before_a_partition_is_skipped(spark, tmp_path, caplog):
    path, obs = str(tmp_path / "obs"), products(spark)

    def load(**kw):
        load_observations(obs, path, "t", 2020, 2020, **kw)
        return {d for s, p, d in loaded(spark, path) if p == "reanalysis"}

    assert load(days=range(1, 11)) == {2}
    assert load(days=["01", "02", "03", *range(4, 11)], on_mismatch="error") == {2}
    assert not caplog.records
    assert load() == {2}  # kept, and said so
    assert "another request" in caplog.text
    with pytest.raises(RequestMismatch, match="2020"):
        load(on_mismatch="error")
    with pytest.raises(RequestMismatch):
        load(days=range(1, 11), frequency="6h", on_mismatch="error")
    # Another product's partitions have nothing to do with it.
    load(product_type="ensemble_members", on_mismatch="error")
    assert load(on_mismatch="replace") == {2, 20}
    assert load(on_mismatch="error") == {2, 20}
    assert load(days=[20], overwrite=True) == {20}
    assert load(days=[20], on_mismatch="error") == {20}
    assert load(product_type=None, days=[20]) == {20}
    assert ("daily_mean", "ensemble_members", 2) in loaded(spark, path)
    with pytest.raises(ValueError, match="on_mismatch"):
        load(on_mismatch="other")


def test_partitions_without_a_note_or_a_statistic(spark, tmp_path):
    path, obs = str(tmp_path / "obs"), products(spark)
    load_observations(obs, path, "t", 2020, 2020)
    shutil.rmtree(f"{path}/_requests")
    with pytest.raises(RequestMismatch):
        load_observations(obs, path, "t", 2020, 2020, on_mismatch="error")
    old = str(tmp_path / "old")
    obs.withColumn("variable", F.lit("t")).withColumn("year", F.lit(2020)).write.partitionBy(
        "variable", "year").parquet(old)
    with pytest.raises(ValueError, match="statistic"):
        load_observations(obs, old, "t", 2020, 2020)


def test_wrapped_axis_holds_a_meridian_once(spark):
    from croptide.plans.regional import regional_features

    rows = [(day(0), 40.0, x, v) for x, v in
            ((0.0, 1.0), (90.0, 7.0), (180.0, 9.0), (270.0, 2.0), (360.0, 4.0))]
    store = spark.createDataFrame(rows, "date date, latitude double, longitude double, GDD double")
    outline = spark.createDataFrame(
        [(1, "A", [(-1.0, 39.0), (1.0, 39.0), (1.0, 41.0), (-1.0, 41.0)])],
        "region int, region_abbr string, ring array<struct<x:double,y:double>>")
    wide = regional_features(store, outline, "sum", time_col="date")
    assert wide.first()["GDD_A"] == 5.0


def test_regional_job_reads_the_values_once(spark, tmp_path):
    """Axes once and values once, whatever is written."""
    store, outlines = store_and_outlines(spark, tmp_path)
    executions = spark._jsparkSession.sharedState().statusStore()
    # The store keeps the last executions only, so ids, not places in it, tell which are new.
    old = executions.executionsList()
    last = max((old.apply(k).executionId() for k in range(old.size())), default=-1)
    out = process_regions_daily(spark, store, outlines, str(tmp_path / "o"), "daily",
                                save_csv=True)
    assert out["output_csv_path"] and out["output_parquet_path"]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    plans = executions.executionsList()
    reads = sum(f"{store}]" in plans.apply(k).physicalPlanDescription()
                for k in range(plans.size()) if plans.apply(k).executionId() > last)
    assert reads == 2


def test_predictor_run(spark, tmp_path):
    start = date(2019, 12, 30)
    features = spark.createDataFrame(
        [(datetime(2020, 1, d), float(d), 2.0 * d) for d in range(1, 28)],
        "Date timestamp, GDD_KS double, GDD_ND double")
    features.write.parquet(str(tmp_path / "f"))

    def table(name, header, *lines):
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join([header, *lines]) + "\n")
        return str(path)

    tables = {
        "market": table("m", "Date,ZW=F", *(f"{start + timedelta(days=k)},{500 + k}"
                                            for k in range(28))),
        "quarterly_supply": table("q", "Marketing_Year,Time_Period,US_Exports_M_Bu,US_Ending_Stocks_M_Bu",
                                  "2019/10,Q3 Dec-Feb,300,70", "2019/10,n.a.,9,9"),
        "annual_supply": table("a", "Marketing year 1,US_Yield_Bu_Acre", "2019/20,51.7", "n.a.,1"),
        "risk": table("r", "date,GPR", "2019-11-01,80", "2020-01-10,NaN"),
    }
    path = predictor_run(spark, str(tmp_path / "f"), tables, str(tmp_path / "out"),
                         ["KS", "ND", "XX"], "2020-01-01", "2020-01-26",
                         csv_path=str(tmp_path / "csv"))
    (file,) = (tmp_path / "csv").glob("*.csv")
    lines = file.read_text().splitlines()
    assert lines[0].split(",") == spark.read.parquet(path).columns
    assert [x.split(",")[0] for x in lines[1:]] == ["2020-01-06", "2020-01-13", "2020-01-20"]
    rows = spark.read.parquet(path).orderBy("Date").collect()
    assert [r["Date"] for r in rows] == [date(2020, 1, 6), date(2020, 1, 13), date(2020, 1, 20)]
    assert rows[1]["GDD_Belt_Mean"] == pytest.approx(sum(1.5 * d for d in range(7, 14)))
    assert rows[1]["ZW=F"] == 514 and rows[1]["Target_Return"] == pytest.approx(700 / 507)
    assert [r["GPR"] for r in rows] == [80.0] * 3


def test_weekly_predictors(spark):
    monday = date(2020, 1, 6)
    belt = spark.createDataFrame(
        [(monday + timedelta(days=d), "GDD", 2.0, None, None, 3.0) for d in range(8)],
        "date date, variable string, Belt_Mean double, Belt_Std double, Belt_Min double, "
        "Belt_Max double")
    supply = spark.createDataFrame(
        [("annual_supply.US_Production_M_Bu", date(2020, 1, 1), 99.0),
         ("quarterly_supply.US_Production_M_Bu", date(2020, 1, 1), 5.0),
         ("commodity.DAP", date(2020, 1, 1), 300.0)], "series string, date date, value double")
    market = spark.createDataFrame(
        [("ZW=F", monday, 500.0), ("ZW=F", monday + timedelta(3), 540.0),
         ("ZW=F", monday + timedelta(7), 550.0)], "series string, date date, value double")
    wide = weekly_predictors([belt_series(belt), supply, market], "2020-01-01", "2020-01-13")
    rows = wide.orderBy("Date").collect()
    assert [r["GDD_Belt_Mean"] for r in rows] == [2.0, 14.0]
    assert [r["US_Production_M_Bu"] for r in rows] == [5.0, 5.0]
    assert [r["DAP"] for r in rows] == [300.0, 300.0]
    assert rows[1]["ZW=F"] == 550.0 and rows[1]["Target_Return"] == pytest.approx(10.0)
    assert "GDD_Belt_Std" not in wide.columns
    how = predictor_methods()
    assert how["GDD_Belt_Std"] == "sum" and how["SPI_Belt_Min"] == "mean"
    assert how["ZW=F"] == "last" and "CPIAUCSL" not in how
