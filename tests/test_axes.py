"""Axes as tables: the same rows as with axes on the driver, and axes that are too long for it."""

import random

import pytest
from helpers import day
from pyspark.sql import functions as F

from croptide.constants import INPUT_FOLDERS, VARIABLE_ALIASES
from croptide.operators import axes, profile
from croptide.operators.align import index_cells
from croptide.operators.numbering import number_rows
from croptide.plans import compute_index_store, regional_features
from croptide.plans.indices import assemble_inputs, profiles_of

GRID = "valid_time date, latitude double, longitude double"


def inputs(spark, keys=("tmax", "soil"), gap=None):
    rng = random.Random(5)
    lats, lons = sorted({rng.uniform(-60, 60) for _ in range(7)}), [-3.5, 0.25, 11.0, 11.5]
    out = {}
    for n, key in enumerate(keys):
        rows = [(day(d + n), y, x, 280.0 + d + y + 2 * x) for d in range(5) for y in lats
                for x in lons if (key, d, y, x) != gap]
        rng.shuffle(rows)
        out[key] = spark.createDataFrame(rows, f"{GRID}, {VARIABLE_ALIASES[key][0]} double")
    return out


def test_numbers_are_places_in_order(spark):
    values = random.Random(1).sample(range(10**6), 3000)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    got = {r["v"]: r["row"] for r in number_rows(frame, "v").collect()}
    assert got == {float(v): k for k, v in enumerate(sorted(values))}
    down = {r["v"]: r["n"] for r in number_rows(frame, F.col("v").desc(), name="n").collect()}
    assert all(down[v] == len(values) - 1 - got[v] for v in got)
    assert number_rows(frame.limit(0), "v").count() == 0


def test_assembly_is_that_of_axes_on_the_driver(spark):
    grids = inputs(spark)
    tables = assemble_inputs(spark, grids, max_axis=3)
    assert sorted(map(tuple, tables.collect())) == sorted(map(
        tuple, assemble_inputs(spark, grids).select(*tables.columns).collect()))
    assert tables.count() == 4 * 7 * 4  # four days in common


def test_million_coordinates(spark):
    """No axis reaches the driver, whatever its length; the bound on it is tiny."""
    n = 1_000_000
    points = spark.range(n).select(
        F.lit(day(0)).alias("valid_time"), (F.pmod(F.col("id") * 7919, n) / n * 170 - 85)
        .alias("latitude"), (F.col("id") / n * 350 - 175).alias("longitude"), "id")
    grids = {k: points.withColumn(VARIABLE_ALIASES[k][0], F.col("id") + s).drop("id")
             for k, s in (("tmax", 0.5), ("tmin", 0.25))}
    wide = assemble_inputs(spark, grids, max_axis=1000)
    facts = wide.agg(F.count("*"), F.max("lat_i"), F.max("lon_i"), F.countDistinct("lat_i"),
                     F.sum(F.col("tmax") - F.col("tmin"))).first()
    assert tuple(facts) == (n, n - 1, n - 1, n, 0.25 * n)
    row = wide.where("lon_i = 1234").first()
    assert row["tmax"] == 1234.5 and row["lat_i"] == 1234 * 7919 % n


def test_profiles_know_lengths_and_gaps(spark):
    grids = inputs(spark)
    grids["soil"] = grids["soil"].unionByName(spark.createDataFrame(
        [(None, 1.0, 2.0, 0.0), (day(9), None, 2.0, 0.0)], grids["soil"].schema))
    columns = dict.fromkeys(grids, ("valid_time", "latitude", "longitude"))
    known = profile.profile_grids(grids, columns)
    lengths = profiles_of(grids, columns, 3)
    for k in grids:
        assert lengths[k].axes is None and known[k].axes is not None
        for fact in ("days", "rows", "missing_times", "missing_places", "size"):
            assert getattr(lengths[k], fact) == getattr(known[k], fact), fact
    with pytest.raises(ValueError, match="missing timestamps"):
        assemble_inputs(spark, grids, max_axis=3)


def test_other_places_cannot_be_regridded(spark):
    grids = inputs(spark)
    grids["soil"] = grids["soil"].where("latitude < 0")
    with pytest.raises(Exception, match="not all inputs have latitude"):
        assemble_inputs(spark, grids, max_axis=3).collect()


def test_places_by_table_and_by_arithmetic(spark):
    grid = inputs(spark)["tmax"]
    tables = axes.common_axes([grid])
    assert sorted(map(tuple, index_cells(grid, tables).collect())) == sorted(
        map(tuple, index_cells(grid, profile.grid_axes(grid)).collect()))


def test_whole_jobs(spark, tmp_path):
    """Index run and regional features with axes as tables give the same rows."""
    base = tmp_path / "in"
    for key, grid in inputs(spark, tuple(INPUT_FOLDERS)).items():
        grid.withColumn("valid_time", F.lit(day(0))).dropDuplicates(
            ["latitude", "longitude"]).write.parquet(str(base / INPUT_FOLDERS[key]))
    stores = [compute_index_store(spark, str(base), str(tmp_path / f"out{m}"), max_axis=m)
              for m in (3, 100)]
    one, two = (spark.read.parquet(s) for s in stores)
    assert one.count() == 28
    assert sorted(map(tuple, one.collect())) == sorted(
        map(tuple, two.select(*one.columns).collect()))
    strip = spark.createDataFrame(
        [(1, "A", [(-10.0, -90.0), (1.0, -90.0), (1.0, 90.0), (-10.0, 90.0)])],
        "region int, region_abbr string, ring array<struct<x:double,y:double>>")
    store = one.drop("year").withColumnRenamed("lat", "latitude").withColumnRenamed(
        "lon", "longitude").withColumn("longitude", F.col("longitude") + 180)
    a, b = (regional_features(store, strip, "max", time_col="date", max_axis=m).collect()
            for m in (3, 100))
    assert a == b
