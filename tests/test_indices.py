import math
import statistics
import warnings
from datetime import date

import pytest
from helpers import column, day, one_cell
from pyspark.sql import functions as F

from croptide.functions import et_ratio, gdd, rolling_sum, wind_speed
from croptide.operators import indices

K = 273.15


def test_gdd_counts_missing_and_cold_as_zero(spark):
    df = spark.createDataFrame(
        [(1, K + 30, K + 10), (2, K + 12, K + 8), (3, None, K + 20), (4, K + 9, K + 1)],
        "i int, tmax double, tmin double")
    got = column(df.select("i", gdd("tmax", "tmin").alias("g")), "g", "i")
    assert got[0] == pytest.approx(10) and got[1:] == [0.0, 0.0, 0.0]


def test_et_ratio_thresholds(spark):
    df = spark.createDataFrame(
        [(1, -3.0, 2.0), (2, -3.0, 1e-4), (3, -3.0, 0.99e-4), (4, -3.0, -5.0),
         (5, -3.0, 0.0), (6, None, 2.0), (7, -3.0, None)],
        "i int, e double, p double")
    got = column(df.select("i", et_ratio("e", "p").alias("r")), "r", "i")
    assert got[0] == 1.5 and got[1] == pytest.approx(3e4)
    assert got[2:] == [None] * 5


def test_et_ratio_with_zero_threshold_does_not_divide_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "e double, p double")
    assert df.select(et_ratio("e", "p", 0.0)).first()[0] is None


def test_wind_speed(spark):
    df = spark.createDataFrame([(3.0, -4.0), (None, 1.0)], "u double, v double")
    assert [r[0] for r in df.select(wind_speed("u", "v")).collect()] == [5.0, None]


def test_rolling_sum_min_periods(spark):
    df = one_cell(spark, "x", [1.0, 2.0, None, 4.0])
    part = ("lat_i", "lon_i")
    full = df.select("date", rolling_sum("x", 2, 2, part, "date").alias("s"))
    any_ = df.select("date", rolling_sum("x", 2, 1, part, "date").alias("s"))
    assert column(full, "s") == [None, 3.0, None, None]
    assert column(any_, "s") == [1.0, 3.0, 2.0, 4.0]


def test_heatwave_is_strict_and_counts_from_the_first_day(spark):
    hot = [K + 40, K + 35.0, None, K + 36] + [K + 50] * 7
    got = column(indices.heatwave(one_cell(spark, "tmax", hot)), "HeatwaveIndex")
    flags = [int(t is not None and t - K > 35) for t in hot]
    assert got == [sum(flags[max(0, i - 6): i + 1]) for i in range(len(flags))]
    assert got[:4] == [1, 1, 1, 2]


def test_climatology_uses_population_deviation_and_zero_for_missing(spark):
    a = one_cell(spark, "x", [2.0], date(2020, 3, 1)).unionByName(
        one_cell(spark, "x", [6.0], date(2021, 3, 2)))  # both day 61
    b = one_cell(spark, "x", [None], date(2020, 6, 1))
    rows = {r["dayofyear"]: r for r in
            indices.climatology(a.unionByName(b), "x").collect()}
    assert (rows[61]["mean"], rows[61]["std"]) == (4.0, 2.0)
    assert (rows[153]["mean"], rows[153]["std"]) == (None, 0.0)


def test_flat_groups_spi_zero_even_where_the_total_is_missing(spark):
    # One year only: every day of year is a group of one, so all are flat.
    got = column(indices.spi(one_cell(spark, "precip", [1.0] * 40)), "SPI")
    assert got == [0.0] * 40


def test_flat_groups_sma_keeps_missing(spark):
    got = column(indices.sma(one_cell(spark, "soil", [1.0, None, 3.0])),
                 "SoilMoistureAnomaly")
    assert got == [0.0, None, 0.0]


def brute_spi(rain, days):
    rain = [max(r or 0.0, 0.0) for r in rain]
    total = [sum(rain[i - 29: i + 1]) if i >= 29 else None for i in range(len(rain))]
    groups = {}
    for d, t in zip(days, total):
        groups.setdefault(d.timetuple().tm_yday, []).append(t)
    out = []
    for d, t in zip(days, total):
        known = [x for x in groups[d.timetuple().tm_yday] if x is not None]
        sd = statistics.pstdev(known) if known else 0.0
        out.append(0.0 if sd <= 1e-6 else
                   None if t is None else (t - statistics.fmean(known)) / sd)
    return out


def test_spi_matches_brute_force_over_three_years(spark):
    n = 3 * 365 + 20
    rain = [None if i % 17 == 0 else (i * 37 % 11) - 2.0 for i in range(n)]
    days = [day(i) for i in range(n)]
    got = column(indices.spi(one_cell(spark, "precip", rain)), "SPI")
    want = brute_spi(rain, days)
    assert [g is None for g in got] == [w is None for w in want]
    assert all(math.isclose(g, w, abs_tol=1e-9)
               for g, w in zip(got, want) if w is not None)
    assert None in got and 0.0 in got


def test_standardized_groups_have_mean_0_and_deviation_1(spark):
    df = one_cell(spark, "x", [float(i * i % 97) for i in range(4 * 366)])
    z = indices.standardize(df, "x", out="z")
    stats = z.groupBy(F.dayofyear("date")).agg(
        F.abs(F.avg("z")).alias("m"), F.stddev_pop("z").alias("s"),
        F.stddev_pop("x").alias("sx")).filter("sx > 1e-6")
    worst = stats.agg(F.max("m"), F.max(F.abs(F.col("s") - 1))).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9


def test_cells_do_not_mix(spark):
    a = one_cell(spark, "tmax", [K + 40] * 3)
    b = one_cell(spark, "tmax", [K] * 3).withColumn("lat_i", F.lit(1))
    got = indices.heatwave(a.unionByName(b)).filter("lat_i = 1")
    assert column(got, "HeatwaveIndex") == [0, 0, 0]


def all_inputs(spark, n=40):
    df = one_cell(spark, "tmax", [K + 20.0 + i for i in range(n)])
    return df.withColumns({
        "tmin": F.col("tmax") - 10, "precip": F.lit(2.0), "evap": F.lit(-1.0),
        "soil": F.col("tmax"), "u_wind": F.lit(3.0), "v_wind": F.lit(4.0)})


def test_compute_indices_agrees_with_the_single_ones(spark):
    df = all_inputs(spark)
    wide = indices.compute_indices(df)
    assert wide.columns[5:] == ["GDD", "SPI", "SoilMoistureAnomaly",
                                "EvapotranspirationRatio", "HeatwaveIndex", "WindSpeed"]
    assert column(wide, "SPI") == column(indices.spi(df), "SPI")
    assert column(wide, "HeatwaveIndex") == column(indices.heatwave(df), "HeatwaveIndex")
    assert column(wide, "WindSpeed") == [5.0] * 40


def test_compute_indices_skips_what_it_cannot_compute(spark):
    df = all_inputs(spark).drop("u_wind")
    with pytest.warns(UserWarning, match="WindSpeed skipped"):
        wide = indices.compute_indices(df)
    assert "WindSpeed" not in wide.columns and "SPI" in wide.columns
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert indices.compute_indices(df, ["GDD"]).columns[-1] == "GDD"
    with pytest.raises(ValueError, match="unknown"):
        indices.compute_indices(df, ["Rain"])


def test_compute_indices_plans_one_exchange(spark):
    df = all_inputs(spark)
    plan = indices.compute_indices(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_indices_long_has_a_row_per_index(spark):
    long = indices.indices_long(indices.compute_indices(all_inputs(spark)))
    assert long.count() == 240 and long.columns[-2:] == ["variable", "value"]
