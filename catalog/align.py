"""Time alignment, target grid, regridding, assembly, longitude wrap."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import (
    DENSE,
    GRID,
    ORDER_GRID,
    as_input,
    cube,
    dense_grid,
    order_grid,
    r,
    rounded,
    sparse_grid,
)
from croptide.operators import align, normalize
from croptide.operators.profile import GridAxes, grid_axes
from croptide.plans.indices import assemble_inputs


def q_align_time(spark, sf):
    a = cube(sparse_grid(spark, sf), "soil")
    b = cube(order_grid(spark, sf), "price")
    left, right = align.align_time([a, b])
    return (left.withColumn("input", F.lit("soil"))
            .unionByName(right.withColumn("input", F.lit("price")))
            .select("input", "date", "lat_i", "lon_i", rounded("value", 4).alias("value")))


def q_target_grid(spark, sf):
    g = as_input(sparse_grid(spark, sf), "soil", "soil")
    inputs = [
        g.filter("latitude < 3"),
        g,
        g.withColumn("latitude", F.col("latitude") + 0.5),  # ties with the second
        g.filter("longitude % 2 = 0"),
    ]
    axes = [grid_axes(i) for i in inputs]
    best = align.choose_target_grid(axes)
    return spark.createDataFrame(
        [(i, len(a.lats), len(a.lons), a.cells, i == best) for i, a in enumerate(axes)],
        "input int, lats int, lons int, cells int, chosen boolean")


HALF = tuple(i / 2 for i in range(9))


def q_regrid(spark, sf):
    out = align.regrid_bilinear(cube(sparse_grid(spark, sf), "soil"), GridAxes(HALF, HALF))
    return out.select("date", "lat_i", "lon_i", "lat", "lon", rounded("value").alias("soil"))


OUTER = (-1.0, 0.25, 1.0, 2.75, 4.0, 4.5)


def q_regrid_outside(spark, sf):
    """Uneven targets, some outside the source: those are missing."""
    out = align.regrid_bilinear(cube(dense_grid(spark, sf), "soil"), GridAxes(OUTER, OUTER))
    return out.select("date", "lat_i", "lon_i", rounded("value").alias("soil"))


def _regrid_sql(axis: str, extra: str = "", digits: int = 9) -> str:
    """Weights per axis, then a weighted sum over corners of non-zero weight."""
    return f"""
WITH {GRID},
t(j, v) AS (VALUES {axis}),
ax AS (
  SELECT j, v, CAST(floor(v) AS INT) AS i, 1 - (v - floor(v)) AS w FROM t
  WHERE v >= 0 AND v <= 4
  UNION ALL
  SELECT j, v, CAST(floor(v) AS INT) + 1, v - floor(v) FROM t
  WHERE v >= 0 AND v <= 4 AND v > floor(v)),
st AS (SELECT a.j AS tlat, b.j AS tlon, a.i AS lat_i, b.i AS lon_i, a.w * b.w AS w
       FROM ax a CROSS JOIN ax b),
sz AS (SELECT tlat, tlon, count(*) AS n FROM st GROUP BY tlat, tlon),
dt AS (SELECT DISTINCT date FROM grid),
x AS (SELECT g.date, tlat, tlon, sum(w * soil) AS x, count(soil) AS k
      FROM grid g JOIN st ON g.lat_i = st.lat_i AND g.lon_i = st.lon_i
      GROUP BY g.date, tlat, tlon)
SELECT dt.date, a.j AS lat_i, b.j AS lon_i, {extra}
       {r('CASE WHEN x.k = sz.n THEN x.x END', digits)} AS soil
FROM dt CROSS JOIN t a CROSS JOIN t b
LEFT JOIN sz ON sz.tlat = a.j AND sz.tlon = b.j
LEFT JOIN x ON x.date = dt.date AND x.tlat = a.j AND x.tlon = b.j"""


def _axis_rows(values) -> str:
    return ", ".join(f"(CAST({i} AS INT), CAST({v} AS DOUBLE))" for i, v in enumerate(values))


def q_assemble(spark, sf):
    g = sparse_grid(spark, sf)
    out = align.assemble({"tmax": cube(g, "tmax"), "soil": cube(g, "soil"),
                          "price": cube(order_grid(spark, sf), "price")})
    return out.select("date", "lat_i", "lon_i", "lat", "lon",
                      *(rounded(c, 4).alias(c) for c in ("tmax", "soil", "price")))


def q_assemble_points(spark, sf):
    """More coordinates than may pass the driver: the axes are numbered as tables."""
    g = dense_grid(spark, sf)
    out = assemble_inputs(spark, {"tmax": as_input(g, "tmax", "mx2t"),
                                  "soil": as_input(g, "soil", "swvl1")}, max_axis=3)
    return out.select("date", "lat_i", "lon_i", "lat", "lon",
                      *(rounded(c, 4).alias(c) for c in ("tmax", "soil")))


def q_wrap(spark, sf):
    g = as_input(sparse_grid(spark, sf), "soil", "soil")
    out = normalize.wrap_longitude(g.withColumn("longitude", F.col("longitude") * 72))
    return out.select("valid_time", "latitude", rounded("longitude").alias("longitude"),
                      "soil")


THIRDS = (0.0, 1 / 3, 2 / 3, 1.0, 2.0, 3.0, 3.7, 4.0)


def q_regrid_float(spark, sf):
    """Source axes that went through FLOAT, on a target in DOUBLE: nodes are nodes."""
    g = cube(sparse_grid(spark, sf), "soil")
    noisy = g.withColumns({c: ((F.col(c) + 0.1).cast("float") - F.lit(0.1).cast("float"))
                           .cast("double") for c in ("lat", "lon")})
    out = align.regrid_bilinear(noisy, GridAxes(THIRDS, THIRDS))
    return out.select("date", "lat_i", "lon_i", rounded("value", 4).alias("soil"))


QUERIES = {
    "align_time": (q_align_time, f"""
WITH {GRID}, {ORDER_GRID},
common AS (SELECT date FROM grid INTERSECT SELECT date FROM ogrid)
SELECT 'soil' AS input, date, lat_i, lon_i, {r('soil', 4)} AS value
FROM grid WHERE date IN (SELECT date FROM common)
UNION ALL
SELECT 'price', date, lat_i, lon_i, {r('price', 4)}
FROM ogrid WHERE date IN (SELECT date FROM common)"""),
    "choose_target_grid": (q_target_grid, f"""
WITH {GRID},
g(input, y, x) AS (
  SELECT 0, count(DISTINCT lat), count(DISTINCT lon) FROM grid WHERE lat < 3
  UNION ALL SELECT 1, count(DISTINCT lat), count(DISTINCT lon) FROM grid
  UNION ALL SELECT 2, count(DISTINCT lat + 0.5), count(DISTINCT lon) FROM grid
  UNION ALL SELECT 3, count(DISTINCT lat), count(DISTINCT lon) FROM grid WHERE lon_i % 2 = 0)
SELECT CAST(input AS INT) AS input, CAST(y AS INT) AS lats, CAST(x AS INT) AS lons,
       CAST(y * x AS INT) AS cells,
       row_number() OVER (ORDER BY y * x DESC, input) = 1 AS chosen
FROM g"""),
    "regrid_bilinear": (q_regrid, _regrid_sql(
        _axis_rows(HALF), "a.v AS lat, b.v AS lon,")),
    "regrid_float_axes": (q_regrid_float, _regrid_sql(_axis_rows(THIRDS), digits=4)),
    "regrid_outside": (q_regrid_outside, _regrid_sql(_axis_rows(OUTER))),
    "assemble": (q_assemble, f"""
WITH {GRID}, {ORDER_GRID}
SELECT date, lat_i, lon_i, grid.lat, grid.lon, {r('tmax', 4)} AS tmax, {r('soil', 4)} AS soil,
       {r('price', 4)} AS price
FROM grid JOIN ogrid USING (date, lat_i, lon_i)"""),
    "assemble_points": (q_assemble_points, f"""
WITH {DENSE}
SELECT date, lat_i, lon_i, lat, lon, {r('tmax', 4)} AS tmax, {r('soil', 4)} AS soil
FROM dense"""),
    "wrap_longitude": (q_wrap, f"""
WITH {GRID}
SELECT date AS valid_time, lat AS latitude,
       {r('CASE WHEN lon * 72 >= 180 THEN lon * 72 - 360 ELSE lon * 72 END')} AS longitude,
       soil FROM grid"""),
}
