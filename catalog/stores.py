"""Readers and writers: what is written is read back and compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.fixtures import (
    DENSE,
    GRID,
    OBSERVATIONS,
    VARIABLES,
    as_input,
    dense_grid,
    index_rows,
    index_rows_sql,
    index_sql,
    observations,
    r,
    regions,
    rounded,
    sparse_grid,
)
from catalog.space import DENSE_MASK
from croptide.constants import INPUT_FOLDERS, VARIABLE_ALIASES
from croptide.operators.indices import compute_indices
from croptide.operators.quality import verify_store
from croptide.plans.indices import compute_index_store
from croptide.plans.observations import load_observations
from croptide.plans.regional import process_regions_daily, regional_features
from croptide.session import stage_path
from croptide.sinks import (
    materialize_stage,
    write_features,
    write_index_store,
    write_missing_partitions,
)
from croptide.sources import read_grid, read_index_store, read_regions

K = "date, lat_i, lon_i"
KEYS = ("date", "lat_i", "lon_i")


def q_read_grid(spark, sf):
    """A folder of several files with NaN in place of missing values."""
    path = stage_path(spark, "grid")
    g = as_input(dense_grid(spark, sf), "soil", "swvl1")
    g = g.withColumn("swvl1", F.coalesce("swvl1", F.lit(float("nan"))))
    g.withColumnRenamed("valid_time", "time").repartition(3).write.parquet(path)
    return read_grid(spark, path)


def q_read_grid_unlike(spark, sf):
    """One folder, soil in some files and, for some years, rain in others."""
    path = stage_path(spark, "grid")
    g = dense_grid(spark, sf)
    as_input(g, "soil", "swvl1").repartition(2).write.parquet(path)
    (as_input(g.filter("year(date) <= 1998"), "precip", "tp").repartition(2)
     .write.mode("append").parquet(path))
    return read_grid(spark, path)


def q_read_index_store(spark, sf):
    path = stage_path(spark, "index")
    static = F.col("lat_i") * 10 + F.col("lon_i")
    (sparse_grid(spark, sf).select(*KEYS, "soil",
                                   static.alias("height", metadata={"dims": "space"}))
     .write.parquet(path))
    return read_index_store(spark, path)


def q_write_index_store(spark, sf):
    path = stage_path(spark, "store")
    write_index_store(compute_indices(sparse_grid(spark, sf)), path)
    back = read_index_store(spark, path)
    return index_rows(back, *KEYS, digits=3).withColumn(
        "year", F.year("date").cast("long"))


def float_rows_sql() -> str:
    return index_rows_sql(3).replace('CAST("', 'CAST(CAST("').replace(
        '" AS DOUBLE)', '" AS FLOAT) AS DOUBLE)')


def q_index_run(spark, sf):
    """Seven input folders, soil on a coarser grid, through the whole index run."""
    base = stage_path(spark, "inputs")
    g = materialize_stage(spark, lambda: dense_grid(spark, sf), "all", base)
    for key, column in zip(INPUT_FOLDERS, VARIABLES, strict=True):
        part = g.filter("lat_i % 2 = 0 AND lon_i % 2 = 0") if key == "soil" else g
        (as_input(part, column, VARIABLE_ALIASES[key][0])
         .write.parquet(f"{base}/{INPUT_FOLDERS[key]}"))
    path = compute_index_store(spark, base, stage_path(spark, "store"),
                               stage_dir=stage_path(spark, "stages"))
    return index_rows(spark.read.parquet(path), *KEYS, digits=3)


def q_regional_run(spark, sf):
    """Index store and outlines through the whole regional job."""
    store, outlines = stage_path(spark, "store"), stage_path(spark, "regions")
    write_index_store(compute_indices(dense_grid(spark, sf)), store)
    regions(spark, sf).write.parquet(outlines)
    status = process_regions_daily(
        spark, store, outlines, stage_path(spark, "out"), "daily", method="max",
        key_regions=["ASIA", "EUROPE", "nowhere"], interval_roots=["HeatwaveIndex"])
    back = spark.read.parquet(status["output_parquet_path"])
    return back.select(F.to_date("Date").alias("Date"), *(
        rounded(f"`{c}`", 3).alias(c) for c in back.columns if c != "Date"))


def _regional_cols():
    cols = []
    for v in ("GDD", "SPI", "SoilMoistureAnomaly", "EvapotranspirationRatio",
              "HeatwaveIndex", "WindSpeed"):
        for a in ("ASIA", "EUROPE"):
            inner = (f"max(CASE WHEN r_name = '{a}' THEN "
                     f"CAST(CAST(\"{v}\" AS FLOAT) AS DOUBLE) END)")
            cols.append(f'{r(inner, 3)} AS "{v}_{a}"')
    return ", ".join(cols)


def q_replace_store(spark, sf):
    """A store that is replaced from itself; a replacement that fails changes nothing."""
    path = stage_path(spark, "store")
    g = sparse_grid(spark, sf)
    write_index_store(compute_indices(g), path)
    old = spark.read.parquet(path).filter("GDD > 5")
    write_index_store(old, path)
    failing = compute_indices(g).withColumn("GDD", F.when(
        F.col("date") == "1996-05-05", F.raise_error(F.lit("a day that cannot be read"))
    ).otherwise(F.col("GDD")))
    try:
        write_index_store(failing, path)
    except Exception:  # the old store is what is left
        return index_rows(read_index_store(spark, path), *KEYS, digits=3)
    raise AssertionError("the failing write succeeded")


def q_verify_shape(spark, sf):
    out = verify_store(compute_indices(sparse_grid(spark, sf)), shape=True)
    return out.select("variable", "present", "n", "days", "lats", "lons", "n_absent")


def q_write_features(spark, sf):
    wide = sparse_grid(spark, sf).groupBy("date").agg(
        F.max("soil").alias("soil_max"), F.min("precip").alias("precip_min"))
    status = write_features(wide, stage_path(spark, "features"), "f", True, True)
    a = spark.read.parquet(status["output_parquet_path"])
    b = spark.read.option("header", True).schema(a.schema).csv(status["output_csv_path"])
    return (a.withColumn("format", F.lit("parquet"))
            .unionByName(b.withColumn("format", F.lit("csv"))))


def q_missing_partitions(spark, sf):
    """Old years first, all years second (old kept), 1999 overwritten third."""
    path = stage_path(spark, "parts")
    g = sparse_grid(spark, sf).select(
        *KEYS, "soil", F.year("date").alias("year"), F.lit("soil").alias("variable"))
    write_missing_partitions(g.filter("year <= 1997").withColumn("soil", F.lit(-1.0)), path)
    write_missing_partitions(g, path)
    write_missing_partitions(g.filter("year = 1999").withColumn("soil", F.lit(-2.0)), path,
                             overwrite=True)
    return spark.read.parquet(path).select(*KEYS, "soil", "variable",
                                           F.col("year").cast("long").alias("year"))


def q_stage(spark, sf):
    """The second call finds the stage and does not compute; the third is forced."""
    folder, g = stage_path(spark, "stages"), sparse_grid(spark, sf).select(*KEYS, "soil")
    first = materialize_stage(spark, lambda: g, "grid", folder)
    again = materialize_stage(spark, lambda: g.filter("soil < 0"), "grid", folder)
    forced = materialize_stage(spark, lambda: g.withColumn("soil", -F.col("soil")),
                               "other", folder, force=True)
    return reduce(lambda a, b: a.unionByName(b), (
        d.withColumn("call", F.lit(i)) for i, d in enumerate((first, again, forced))))


def q_read_regions(spark, sf):
    path = stage_path(spark, "regions")
    regions(spark, sf).write.parquet(path)
    out = read_regions(spark, path)
    return out.select("region", "region_abbr", F.posexplode("ring").alias("pos", "p")).select(
        "region", "region_abbr", "pos", rounded("p.x").alias("x"), rounded("p.y").alias("y"))


def q_load_observations(spark, sf):
    """Two variables as daily tables; the second request adds only what is missing."""
    path = stage_path(spark, "obs")
    obs = observations(spark, sf).withColumn("double_value", F.col("value") * 2)
    load_observations(obs, path, "value", 2024, 2024, "daily_maximum", "utc-05:00",
                      days=range(1, 16), product_type=None)
    load_observations(obs, path, ["value", "double_value"], 2024, 2024, "daily_maximum",
                      "utc-05:00", product_type=None)
    return spark.read.parquet(path).select(
        "date", "latitude", "longitude", "level", "product_type", "variable",
        rounded("value").alias("value"), F.col("year").cast("long").alias("year"))


def q_load_requests(spark, sf):
    """Statistics and products of one variable side by side; another request replaces its own."""
    path = stage_path(spark, "obs")
    obs = observations(spark, sf).withColumn("product_type", F.when(
        F.col("product_type") == "view", "reanalysis").otherwise(F.col("product_type")))

    def load(statistic, **request):
        load_observations(obs, path, "value", 2024, 2024, statistic, "utc-05:00", **request)

    load("daily_mean", days=range(1, 16))
    load("daily_maximum")
    load("daily_maximum", product_type=["click", "reanalysis"])
    load("daily_mean", on_mismatch="replace")
    load("daily_minimum", product_type="click", pressure_level=[1, 2], frequency="6h")
    return spark.read.parquet(path).select(
        "date", "latitude", "longitude", "level", "product_type", "statistic",
        rounded("value").alias("value"))


COARSE_SOIL = """,
t(j, i0, i1, w) AS (VALUES (0, 0, 0, 0.0E0), (1, 0, 2, 0.5E0), (2, 2, 2, 0.0E0),
                           (3, 2, 4, 0.5E0), (4, 4, 4, 0.0E0)),
corner AS (
  SELECT a.j AS lat_i, b.j AS lon_i, y.i AS sy, x.i AS sx, y.w * x.w AS w
  FROM t a CROSS JOIN t b
  CROSS JOIN LATERAL (SELECT a.i0 AS i, 1 - a.w AS w
                      UNION ALL SELECT a.i1, a.w WHERE a.w > 0) y
  CROSS JOIN LATERAL (SELECT b.i0 AS i, 1 - b.w AS w
                      UNION ALL SELECT b.i1, b.w WHERE b.w > 0) x),
moved AS (
  SELECT date, c.lat_i, c.lon_i,
         CASE WHEN count(soil) = count(*) THEN sum(w * soil) END AS soil
  FROM dense d JOIN corner c ON d.lat_i = c.sy AND d.lon_i = c.sx
  GROUP BY date, c.lat_i, c.lon_i),
mixed AS (
  SELECT d.date, d.lat_i, d.lon_i, d.lat, d.lon, tmax, tmin, precip, evap, moved.soil,
         u_wind, v_wind
  FROM dense d JOIN moved USING (date, lat_i, lon_i))"""

def q_wrap_cyclic(spark, sf):
    """A store whose longitudes hold both 0 and 360: one meridian, every row once."""
    g = dense_grid(spark, sf).select("date", F.col("lat").alias("latitude"),
                                     (F.col("lon_i") * 90.0).alias("longitude"),
                                     F.col("soil").alias("GDD"))
    strip = spark.createDataFrame(
        [(1, "CENTRE", [(-1.0, -1.0), (1.0, -1.0), (1.0, 9.0), (-1.0, 9.0)])],
        "region int, region_abbr string, ring array<struct<x:double,y:double>>")
    wide = regional_features(g, strip, "sum", time_col="date")
    return wide.select(F.to_date("Date").alias("Date"), rounded("GDD_CENTRE").alias("total"))


WRAP_CYCLIC_SQL = f"""
WITH {DENSE}
SELECT date AS "Date", {r('coalesce(sum(soil), 0)')} AS total
FROM dense WHERE lon_i IN (0, 4) GROUP BY date"""

QUERIES = {
    "wrap_cyclic": (q_wrap_cyclic, WRAP_CYCLIC_SQL),
    "read_grid": (q_read_grid, f"""
WITH {DENSE}
SELECT date AS valid_time, lat AS latitude, lon AS longitude, soil AS swvl1 FROM dense"""),
    "read_grid_unlike": (q_read_grid_unlike, f"""
WITH {DENSE}
SELECT date AS valid_time, lat AS latitude, lon AS longitude, soil AS swvl1,
       CASE WHEN year(date) <= 1998 THEN precip END AS tp FROM dense"""),
    "read_index_store": (q_read_index_store, f"WITH {GRID} SELECT {K}, soil FROM grid"),
    "write_index_store": (q_write_index_store, f"""
WITH {GRID}{index_sql('grid')}
SELECT {K}, {float_rows_sql()}, year(date) AS year FROM idx"""),
    "replace_store": (q_replace_store, f"""
WITH {GRID}{index_sql('grid')}
SELECT {K}, {float_rows_sql()} FROM idx WHERE CAST("GDD" AS FLOAT) > 5"""),
    "verify_shape": (q_verify_shape, f"""
WITH {GRID}{index_sql('grid')}, long AS (
  UNPIVOT (SELECT {K}, CAST("GDD" AS DOUBLE) AS "GDD", CAST("SPI" AS DOUBLE) AS "SPI",
                  CAST("SoilMoistureAnomaly" AS DOUBLE) AS "SoilMoistureAnomaly",
                  CAST("EvapotranspirationRatio" AS DOUBLE) AS "EvapotranspirationRatio",
                  CAST("HeatwaveIndex" AS DOUBLE) AS "HeatwaveIndex",
                  CAST("WindSpeed" AS DOUBLE) AS "WindSpeed" FROM idx)
  ON COLUMNS(* EXCLUDE (date, lat_i, lon_i)) INTO NAME variable VALUE v),
counted AS (SELECT variable, count(*) AS n FROM long GROUP BY variable)
SELECT variable, true AS present, n, days, lats, lons, days * lats * lons - cells AS n_absent
FROM counted CROSS JOIN (
  SELECT count(DISTINCT date) AS days, count(DISTINCT lat_i) AS lats,
         count(DISTINCT lon_i) AS lons, count(*) AS cells FROM idx)"""),
    "index_run": (q_index_run, f"""
WITH {DENSE}{COARSE_SOIL}{index_sql('mixed')}
SELECT {K}, {float_rows_sql()} FROM idx"""),
    "regional_run": (q_regional_run, f"""
WITH {DENSE}{index_sql('dense')}, {DENSE_MASK}
SELECT date AS "Date", {_regional_cols()}
FROM idx JOIN mask USING (lat_i, lon_i) JOIN region ON r_regionkey = mask.region
GROUP BY date"""),
    "write_features": (q_write_features, f"""
WITH {GRID}, f AS (
  SELECT date, max(soil) AS soil_max, min(precip) AS precip_min FROM grid GROUP BY date)
SELECT date, soil_max, precip_min, format
FROM f CROSS JOIN (VALUES ('parquet'), ('csv')) AS t(format)"""),
    "write_missing_partitions": (q_missing_partitions, f"""
WITH {GRID}
SELECT {K}, CASE WHEN year(date) <= 1997 THEN -1.0E0 WHEN year(date) = 1999 THEN -2.0E0
                 ELSE soil END AS soil, 'soil' AS variable, year(date) AS year
FROM grid"""),
    "materialize_stage": (q_stage, f"""
WITH {GRID}
SELECT {K}, CASE WHEN call = 2 THEN -soil ELSE soil END AS soil, CAST(call AS INT) AS call
FROM grid CROSS JOIN unnest(range(0, 3)) AS t(call)"""),
    "read_regions": (q_read_regions, f"""
SELECT r_regionkey AS region, r_name AS region_abbr, CAST(pos AS INT) AS pos,
       {r('r_regionkey + dx')} AS x, {r('y')} AS y
FROM region CROSS JOIN (VALUES (0, -0.5E0, -0.5E0), (1, 0.5E0, -0.5E0),
  (2, 0.9E0, 4.5E0), (3, -0.1E0, 4.5E0), (4, -0.5E0, -0.5E0)) AS t(pos, dx, y)"""),
    # Local days of the local year 2024. The first request stored `value` for half a
    # month, and those partitions are kept. Products are never mixed.
    "load_observations": (q_load_observations, f"""
WITH {OBSERVATIONS}, local AS (
  SELECT CAST(valid_time - INTERVAL 5 HOUR AS DATE) AS date, latitude, longitude, level,
         product_type, value
  FROM obs),
kept AS (
  SELECT level, product_type FROM local WHERE year(date) = 2024 AND day(date) <= 15
  GROUP BY level, product_type),
d AS (
  SELECT 'value' AS variable, l.* FROM local l LEFT JOIN kept k USING (level, product_type)
  WHERE k.level IS NULL OR day(date) <= 15
  UNION ALL
  SELECT 'double_value', date, latitude, longitude, level, product_type, value * 2 FROM local)
SELECT date, latitude, longitude, level, product_type, variable, {r('max(value)')} AS value,
       year(date) AS year
FROM d WHERE year(date) = 2024
GROUP BY date, latitude, longitude, level, product_type, variable"""),
    "load_requests": (q_load_requests, f"""
WITH {OBSERVATIONS}, local AS (
  SELECT CAST(valid_time - INTERVAL 5 HOUR AS DATE) AS date, hour(valid_time) AS hour,
         latitude, longitude, level, value,
         CASE product_type WHEN 'view' THEN 'reanalysis' ELSE product_type END AS product_type
  FROM obs WHERE year(CAST(valid_time - INTERVAL 5 HOUR AS DATE)) = 2024)
SELECT date, latitude, longitude, level, product_type, 'daily_mean' AS statistic,
       {r('avg(value)')} AS value
FROM local WHERE product_type = 'reanalysis' GROUP BY ALL
UNION ALL
SELECT date, latitude, longitude, level, product_type, 'daily_maximum', {r('max(value)')}
FROM local WHERE product_type IN ('click', 'reanalysis') GROUP BY ALL
UNION ALL
SELECT date, latitude, longitude, level, product_type, 'daily_minimum', {r('min(value)')}
FROM local WHERE product_type = 'click' AND level IN (1, 2) AND hour % 6 = 0 GROUP BY ALL"""),
}
