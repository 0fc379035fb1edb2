"""Index formulas, filters and names over the weather grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import (
    DENSE,
    GRID,
    as_input,
    dense_grid,
    index_rows,
    index_rows_sql,
    index_sql,
    r,
    rounded,
    sparse_grid,
)
from croptide.constants import CELL, INDEX_NAMES
from croptide.functions import (
    et_ratio,
    gdd,
    kelvin_to_celsius,
    rolling_sum,
    wind_speed,
)
from croptide.operators import filters, indices, normalize, quality

KEYS = ("date", *CELL)
K = "date, lat_i, lon_i"


def q_kelvin(spark, sf):
    g = dense_grid(spark, sf)
    return g.select(*KEYS, rounded(kelvin_to_celsius("tmax")).alias("tmax_c"))


def q_gdd(spark, sf):
    return dense_grid(spark, sf).select(*KEYS, rounded(gdd("tmax", "tmin")).alias("gdd"))


def q_rolling(spark, sf):
    return sparse_grid(spark, sf).select(
        *KEYS, rolling_sum("soil", 30, 30, CELL, "date").alias("sum30"),
        rolling_sum("soil", 7, 1, CELL, "date").alias("sum7"))


def q_climatology(spark, sf):
    out = indices.climatology(dense_grid(spark, sf), "soil")
    return out.select(*CELL, F.col("dayofyear").cast("long").alias("dayofyear"),
                      rounded("mean").alias("mean"), rounded("std").alias("std"))


def q_standardize(spark, sf):
    out = indices.standardize(dense_grid(spark, sf), "soil", out="z")
    return out.select(*KEYS, rounded("z").alias("z"))


def q_spi(spark, sf):
    return indices.spi(sparse_grid(spark, sf)).select(*KEYS, rounded("SPI").alias("spi"))


def q_sma(spark, sf):
    return indices.sma(dense_grid(spark, sf)).select(
        *KEYS, rounded("SoilMoistureAnomaly").alias("sma"))


def q_et(spark, sf):
    return dense_grid(spark, sf).select(
        *KEYS, rounded(et_ratio("evap", "precip")).alias("et_ratio"))


def q_heatwave(spark, sf):
    return indices.heatwave(dense_grid(spark, sf)).select(*KEYS, "HeatwaveIndex")


def q_wind(spark, sf):
    return dense_grid(spark, sf).select(
        *KEYS, rounded(wind_speed("u_wind", "v_wind")).alias("wind_speed"))


def q_indices(spark, sf):
    return index_rows(indices.compute_indices(dense_grid(spark, sf)), *KEYS)


def q_indices_long(spark, sf):
    """The long form, reduced to one row per cell and index."""
    out = indices.indices_long(indices.compute_indices(sparse_grid(spark, sf)))
    return (out.groupBy("variable", *CELL)
            .agg(F.count("value").alias("n"), rounded(F.max("value")).alias("top")))


def q_bbox(spark, sf):
    g = filters.filter_bbox(dense_grid(spark, sf), [3.0, 1.0, 1.0, 4.0], "lat", "lon")
    return g.select(*KEYS, "soil")


def q_calendar(spark, sf):
    g = filters.filter_calendar(dense_grid(spark, sf), 1996, 1998, ["03", "04", "12"],
                                ["01", "15", "31"], time="date")
    return g.select(*KEYS, "soil")


def q_clip(spark, sf):
    g = filters.clip_dates(dense_grid(spark, sf), "1996-02-29", "1999-12-31")
    return g.select(*KEYS, "soil")


def _inputs(spark, sf):
    dense, sparse = dense_grid(spark, sf), sparse_grid(spark, sf)
    return {
        "tmax": as_input(dense, "tmax", "mx2t").withMetadata("mx2t", {"units": "K"}),
        "soil": as_input(dense.filter("lat_i % 2 = 0"), "soil", "swvl1"),
        "precip": as_input(sparse, "precip", "tp").withColumnRenamed("valid_time", "time"),
        "evap": as_input(sparse, "evap", "e").filter("longitude < 0"),
    }


def q_diagnose(spark, sf):
    return quality.diagnose(spark, _inputs(spark, sf))


DIAGNOSE_SQL = f"""
WITH {DENSE},
facts AS (
  SELECT 'tmax' AS dataset, count(*) AS n, min(date) AS lo, max(date) AS hi,
         count(DISTINCT lat) AS y, count(DISTINCT lon) AS x FROM dense
  UNION ALL SELECT 'soil', count(*), min(date), max(date), count(DISTINCT lat),
         count(DISTINCT lon) FROM dense WHERE lat_i % 2 = 0
  UNION ALL SELECT 'precip', count(*), min(date), max(date), count(DISTINCT lat),
         count(DISTINCT lon) FROM grid
  UNION ALL SELECT 'evap', count(*), min(date), max(date), count(DISTINCT lat),
         count(DISTINCT lon) FROM grid WHERE lon < 0)
SELECT dataset, 'rows' AS "check", CASE WHEN n = 0 THEN 'warning' ELSE 'info' END AS severity,
       CAST(n AS VARCHAR) AS detail FROM facts
UNION ALL
SELECT dataset, 'time', CASE WHEN dataset = 'precip' THEN 'warning' ELSE 'info' END,
       CASE WHEN dataset = 'precip' THEN 'time' ELSE 'valid_time' END FROM facts
UNION ALL
SELECT dataset, 'range', 'info', CAST(lo AS VARCHAR) || ' .. ' || CAST(hi AS VARCHAR)
FROM facts WHERE n > 0
UNION ALL
SELECT f.dataset, 'grid', CASE WHEN f.y = t.y AND f.x = t.x THEN 'info' ELSE 'warning' END,
       CAST(f.y AS VARCHAR) || ' x ' || CAST(f.x AS VARCHAR) || ' (latitude, longitude)'
FROM facts f CROSS JOIN (SELECT y, x FROM facts WHERE dataset = 'tmax') t
UNION ALL
SELECT dataset, 'units', CASE WHEN dataset = 'tmax' THEN 'info' ELSE 'warning' END,
       CASE dataset WHEN 'tmax' THEN 'mx2t: K' WHEN 'soil' THEN 'swvl1: not stated'
            WHEN 'precip' THEN 'tp: not stated' ELSE 'e: not stated' END
FROM facts"""


def q_verify(spark, sf):
    out = quality.verify_store(indices.compute_indices(
        dense_grid(spark, sf), [i for i in INDEX_NAMES if i != "WindSpeed"]))
    return out.select("variable", "present", "data_type", "n", "n_null",
                      *(rounded(c).alias(c) for c in ("min", "max", "sample")))


def _verify_sql() -> str:
    rows = []
    for name in INDEX_NAMES:
        if name == "WindSpeed":
            rows.append("SELECT 'WindSpeed', false, CAST(NULL AS VARCHAR), "
                        "CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), "
                        "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)")
            continue
        c, kind = f'"{name}"', "smallint" if name == "HeatwaveIndex" else "double"
        sample = (f"(SELECT {c} FROM idx WHERE date = (SELECT min(date) FROM idx) "
                  "AND lat_i = 0 AND lon_i = 0)")
        rows.append(f"SELECT '{name}', true, '{kind}', count({c}), "
                    f"count(*) - count({c}), {r(f'min({c})')}, {r(f'max({c})')}, "
                    f"{r(sample)} FROM idx")
    first = rows[0].replace("SELECT 'GDD', true, 'double', ", "SELECT 'GDD' AS variable, "
                            "true AS present, 'double' AS data_type, ")
    return (f"WITH {DENSE}{index_sql('dense')}, v(variable, present, data_type, n, n_null, "
            f'"min", "max", sample) AS ({" UNION ALL ".join([first, *rows[1:]])}) '
            "SELECT * FROM v")


def q_validate_time(spark, sf):
    """The validated rows themselves: nothing is dropped."""
    return normalize.validate_time(sparse_grid(spark, sf), "date").select(*KEYS, "soil")


def q_normalize_time(spark, sf):
    g = as_input(sparse_grid(spark, sf), "soil", "soil")
    g = g.withColumnRenamed("valid_time", "Forecast_Time")
    return normalize.normalize_time(g)


def q_normalize_coords(spark, sf):
    """Both rules: exact names in any case, and names that contain lat / lon."""
    g = as_input(sparse_grid(spark, sf), "soil", "soil")
    a = normalize.normalize_coords(
        g.withColumnsRenamed({"latitude": "LAT", "longitude": "Lon"}), "exact")
    b = normalize.normalize_coords(
        g.withColumnsRenamed({"latitude": "cell_lat", "longitude": "cell_long"}),
        "substring")
    return a.withColumn("rule", F.lit("exact")).unionByName(
        b.withColumn("rule", F.lit("substring")))


def q_pick(spark, sf):
    g = as_input(sparse_grid(spark, sf), "tmax", "tasmax").withColumn("quality", F.lit(1))
    return normalize.pick_variable(g, "tmax")


QUERIES = {
    "kelvin_to_celsius": (q_kelvin, f"""
WITH {DENSE}
SELECT {K}, {r('tmax - CAST(273.15 AS DOUBLE)')} AS tmax_c FROM dense"""),
    "gdd": (q_gdd, f"""
WITH {DENSE}, m AS (
  SELECT {K}, ((tmax - CAST(273.15 AS DOUBLE)) + (tmin - CAST(273.15 AS DOUBLE))) / 2 AS t
  FROM dense)
SELECT {K}, {r('CASE WHEN t > 10 THEN t - 10 ELSE 0.0E0 END')} AS gdd FROM m"""),
    "rolling_sum": (q_rolling, f"""
WITH {GRID}
SELECT {K}, CASE WHEN count(*) OVER a >= 30 THEN sum(soil) OVER a END AS sum30,
       sum(soil) OVER b AS sum7
FROM grid
WINDOW a AS (PARTITION BY lat_i, lon_i ORDER BY date
             ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
       b AS (PARTITION BY lat_i, lon_i ORDER BY date
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
    "climatology": (q_climatology, f"""
WITH {DENSE}
SELECT lat_i, lon_i, CAST(dayofyear(date) AS BIGINT) AS dayofyear,
       {r('avg(soil)')} AS mean, {r('coalesce(stddev_pop(soil), 0)')} AS std
FROM dense GROUP BY lat_i, lon_i, dayofyear(date)"""),
    "standardize": (q_standardize, f"""
WITH {DENSE}, k AS (
  SELECT lat_i, lon_i, dayofyear(date) AS doy, avg(soil) AS m,
         coalesce(stddev_pop(soil), 0) AS sd
  FROM dense GROUP BY lat_i, lon_i, dayofyear(date))
SELECT d.date, d.lat_i, d.lon_i,
       {r('CASE WHEN sd > 1e-6 THEN (soil - m) / sd ELSE 0.0E0 END')} AS z
FROM dense d JOIN k ON d.lat_i = k.lat_i AND d.lon_i = k.lon_i
                   AND dayofyear(d.date) = k.doy"""),
    "spi": (q_spi, f"""
WITH {GRID}{index_sql('grid')}
SELECT {K}, {r('"SPI"')} AS spi FROM idx"""),
    "sma": (q_sma, f"""
WITH {DENSE}{index_sql('dense')}
SELECT {K}, {r('"SoilMoistureAnomaly"')} AS sma FROM idx"""),
    "et_ratio": (q_et, f"""
WITH {DENSE}
SELECT {K}, {r('CASE WHEN precip >= 1e-4 THEN abs(evap) / precip END')} AS et_ratio
FROM dense"""),
    "heatwave": (q_heatwave, f"""
WITH {DENSE}{index_sql('dense')}
SELECT {K}, "HeatwaveIndex" FROM idx"""),
    "wind_speed": (q_wind, f"""
WITH {DENSE}
SELECT {K}, {r('sqrt(u_wind * u_wind + v_wind * v_wind)')} AS wind_speed FROM dense"""),
    "compute_indices": (q_indices, f"""
WITH {DENSE}{index_sql('dense')}
SELECT {K}, {index_rows_sql()} FROM idx"""),
    "indices_long": (q_indices_long, f"""
WITH {GRID}{index_sql('grid')}, v AS (
  {" UNION ALL ".join(
      f"SELECT '{n}' AS variable, lat_i, lon_i, CAST({chr(34)}{n}{chr(34)} AS DOUBLE) AS value FROM idx"
      for n in INDEX_NAMES)})
SELECT variable, lat_i, lon_i, count(value) AS n, {r('max(value)')} AS top
FROM v GROUP BY variable, lat_i, lon_i"""),
    "filter_bbox": (q_bbox, f"""
WITH {DENSE}
SELECT {K}, soil FROM dense WHERE lat BETWEEN 1 AND 3 AND lon BETWEEN 1 AND 4"""),
    "filter_calendar": (q_calendar, f"""
WITH {DENSE}
SELECT {K}, soil FROM dense
WHERE year(date) BETWEEN 1996 AND 1998 AND month(date) IN (3, 4, 12)
  AND day(date) IN (1, 15, 31)"""),
    "clip_dates": (q_clip, f"""
WITH {DENSE}
SELECT {K}, soil FROM dense WHERE date BETWEEN DATE '1996-02-29' AND DATE '1999-12-31'"""),
    "diagnose": (q_diagnose, DIAGNOSE_SQL),
    "verify_store": (q_verify, _verify_sql()),
    "validate_time": (q_validate_time, f"WITH {GRID} SELECT {K}, soil FROM grid"),
    "normalize_time": (q_normalize_time, f"""
WITH {GRID}
SELECT date AS valid_time, lat AS latitude, lon AS longitude, soil FROM grid"""),
    "normalize_coords": (q_normalize_coords, f"""
WITH {GRID}
SELECT date AS valid_time, lat AS latitude, lon AS longitude, soil, rule
FROM grid CROSS JOIN (VALUES ('exact'), ('substring')) AS t(rule)"""),
    "pick_variable": (q_pick, f"""
WITH {GRID}
SELECT date AS valid_time, lat AS latitude, lon AS longitude, tmax FROM grid"""),
}
