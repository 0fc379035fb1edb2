"""Weather grids, observations and price series derived from the test tables.

A nation is a grid cell (5 x 5 by nation key) and a ship date a day. Values are
whole numbers, so sums are exact in any order and both engines must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 5
VARIABLES = ("tmax", "tmin", "precip", "evap", "soil", "u_wind", "v_wind")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(c: Column | str, digits: int = 9) -> Column:
    """Rounded to hide the order of summation; + 0.0 removes negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def r(expr: str, digits: int = 9) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0E0"


def cell_columns(key: Column) -> list[Column]:
    lat_i = F.floor(key / SIDE).cast("int")
    lon_i = (key % SIDE).cast("int")
    return [lat_i.alias("lat_i"), lon_i.alias("lon_i"),
            lat_i.cast("double").alias("lat"), lon_i.cast("double").alias("lon")]


def sparse_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The cell-days with shipments."""
    item, supp = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    q = F.col("l_quantity")
    return (
        item.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", F.to_date("l_shipdate").alias("date"))
        .agg(
            (F.max(q) + 273.15).alias("tmax"),
            (F.min(q) + 273.15).alias("tmin"),
            (F.sum(F.round(F.col("l_discount") * 100).cast("long")) - 4)
            .cast("double").alias("precip"),
            (-F.sum(F.round(F.col("l_tax") * 100).cast("long")))
            .cast("double").alias("evap"),
            F.sum(q).alias("soil"),
            (F.min(q) - 25).alias("u_wind"),
            (F.max(q) - 25).alias("v_wind"),
        )
        .select("date", *cell_columns(F.col("s_nationkey")), *VARIABLES)
    )


def dense_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell on every day; days without shipments are missing."""
    grid = sparse_grid(spark, sf)
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    frame = (days.distinct()
             .select("date", F.explode(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)))
                     .alias("key"))
             .select("date", *cell_columns(F.col("key"))))
    return frame.join(grid.drop("lat", "lon"), ["date", "lat_i", "lon_i"], "left")


def order_grid(spark: SparkSession, sf: str) -> DataFrame:
    """A second grid with other days: the largest order per nation and day."""
    orders, cust = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (
        orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.to_date("o_orderdate").alias("date"))
        .agg(F.max("o_totalprice").alias("price"))
        .select("date", *cell_columns(F.col("c_nationkey")), "price")
    )


def as_input(df: DataFrame, variable: str, name: str) -> DataFrame:
    """One variable in the shape of an input grid."""
    return df.select(F.col("date").alias("valid_time"), F.col("lat").alias("latitude"),
                     F.col("lon").alias("longitude"), F.col(variable).alias(name))


def nation_cells(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(*cell_columns(F.col("n_nationkey")))


def cube(df: DataFrame, variable: str) -> DataFrame:
    return df.select("date", "lat_i", "lon_i", "lat", "lon",
                     F.col(variable).alias("value"))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """One slanted strip of longitude per region, west to east."""
    def at(dx: float, y: float) -> Column:
        return F.struct((F.col("r_regionkey") + F.lit(dx)).alias("x"),
                        F.lit(y).alias("y"))
    return table(spark, sf, "region").select(
        F.col("r_regionkey").alias("region"), F.col("r_name").alias("region_abbr"),
        F.array(at(-0.5, -0.5), at(0.5, -0.5), at(0.9, 4.5), at(-0.1, 4.5),
                at(-0.5, -0.5)).alias("ring"))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sub-daily observations of 150 stations."""
    user = F.col("user_id")
    return table(spark, sf, "events").select(
        F.col("ts").alias("valid_time"), user.alias("station"),
        (user % 10).cast("double").alias("latitude"),
        F.floor(user / 10).cast("double").alias("longitude"),
        (user % 5).cast("int").alias("level"),
        F.col("event_type").alias("product_type"), "value")


def daily_prices(spark: SparkSession, sf: str) -> DataFrame:
    """(series, date, value): the largest order of each nation and day."""
    return order_grid(spark, sf).select(
        F.concat(F.lit("nation_"), (F.col("lat_i") * SIDE + F.col("lon_i")).cast("string"))
        .alias("series"), "date", F.col("price").alias("value"))


# The same fixtures as SQL; each text is one or more members of a WITH list.

GRID = """
grid AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(floor(s_nationkey / 5.0) AS INT) AS lat_i,
         CAST(s_nationkey % 5 AS INT) AS lon_i,
         CAST(floor(s_nationkey / 5.0) AS DOUBLE) AS lat,
         CAST(s_nationkey % 5 AS DOUBLE) AS lon,
         max(l_quantity) + CAST(273.15 AS DOUBLE) AS tmax,
         min(l_quantity) + CAST(273.15 AS DOUBLE) AS tmin,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) - 4 AS DOUBLE) AS precip,
         -CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) AS evap,
         sum(l_quantity) AS soil,
         min(l_quantity) - 25 AS u_wind,
         max(l_quantity) - 25 AS v_wind
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY s_nationkey, CAST(l_shipdate AS DATE))"""

DENSE = GRID + """,
days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
cells AS (
  SELECT CAST(floor(k / 5.0) AS INT) AS lat_i, CAST(k % 5 AS INT) AS lon_i,
         CAST(floor(k / 5.0) AS DOUBLE) AS lat, CAST(k % 5 AS DOUBLE) AS lon
  FROM unnest(range(0, 25)) AS t(k)),
dense AS (
  SELECT days.date, cells.lat_i, cells.lon_i, cells.lat, cells.lon,
         tmax, tmin, precip, evap, soil, u_wind, v_wind
  FROM days CROSS JOIN cells
  LEFT JOIN grid ON grid.date = days.date AND grid.lat_i = cells.lat_i
                AND grid.lon_i = cells.lon_i)"""


def index_sql(source: str, name: str = "idx") -> str:
    """All six indices over the rows of ``source``."""
    return f""",
{name}_r AS (
  SELECT *, dayofyear(date) AS doy,
    CASE WHEN count(*) OVER w30 >= 30
         THEN sum(greatest(coalesce(precip, 0.0E0), 0.0E0)) OVER w30 END AS total,
    CAST(sum(CASE WHEN tmax - CAST(273.15 AS DOUBLE) > 35 THEN 1 ELSE 0 END) OVER w7
         AS SMALLINT) AS hot
  FROM {source}
  WINDOW w30 AS (PARTITION BY lat_i, lon_i ORDER BY date
                 ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
         w7 AS (PARTITION BY lat_i, lon_i ORDER BY date
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
{name}_k AS (
  SELECT lat_i, lon_i, doy, avg(total) AS mt, coalesce(stddev_pop(total), 0) AS st,
         avg(soil) AS ms, coalesce(stddev_pop(soil), 0) AS ss
  FROM {name}_r GROUP BY lat_i, lon_i, doy),
{name} AS (
  SELECT r.date, r.lat_i, r.lon_i, r.lat, r.lon,
    CASE WHEN ((tmax - CAST(273.15 AS DOUBLE)) + (tmin - CAST(273.15 AS DOUBLE))) / 2 > 10
         THEN ((tmax - CAST(273.15 AS DOUBLE)) + (tmin - CAST(273.15 AS DOUBLE))) / 2 - 10
         ELSE 0.0E0 END AS "GDD",
    CASE WHEN st > 1e-6 THEN (total - mt) / st ELSE 0.0E0 END AS "SPI",
    CASE WHEN soil IS NULL THEN NULL WHEN ss > 1e-6 THEN (soil - ms) / ss
         ELSE 0.0E0 END AS "SoilMoistureAnomaly",
    CASE WHEN precip >= 1e-4 THEN abs(evap) / precip END AS "EvapotranspirationRatio",
    hot AS "HeatwaveIndex",
    sqrt(u_wind * u_wind + v_wind * v_wind) AS "WindSpeed"
  FROM {name}_r r JOIN {name}_k k
    ON r.lat_i = k.lat_i AND r.lon_i = k.lon_i AND r.doy = k.doy)"""


ORDER_GRID = """
ogrid AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CAST(floor(c_nationkey / 5.0) AS INT) AS lat_i,
         CAST(c_nationkey % 5 AS INT) AS lon_i,
         CAST(floor(c_nationkey / 5.0) AS DOUBLE) AS lat,
         CAST(c_nationkey % 5 AS DOUBLE) AS lon,
         max(o_totalprice) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_nationkey, CAST(o_orderdate AS DATE))"""

PRICES = ORDER_GRID + """,
prices AS (
  SELECT 'nation_' || CAST(lat_i * 5 + lon_i AS VARCHAR) AS series, date,
         price AS value
  FROM ogrid)"""

OBSERVATIONS = """
obs AS (
  SELECT ts AS valid_time, user_id AS station,
         CAST(user_id % 10 AS DOUBLE) AS latitude,
         CAST(floor(user_id / 10.0) AS DOUBLE) AS longitude,
         CAST(user_id % 5 AS INT) AS level, event_type AS product_type, value
  FROM events)"""


def monday_sql(date: str) -> str:
    """The Monday on or after a day."""
    return (f"CAST(date_trunc('week', {date} - INTERVAL 1 DAY) + INTERVAL 7 DAY AS DATE)")


INDEX_COLUMNS = ("GDD", "SPI", "SoilMoistureAnomaly", "EvapotranspirationRatio",
                 "HeatwaveIndex", "WindSpeed")


def index_rows(df: DataFrame, *keys: str, digits: int = 9) -> DataFrame:
    """Keys and rounded indices."""
    return df.select(*keys, *(
        F.col(c) if c == "HeatwaveIndex" else rounded(c, digits).alias(c)
        for c in INDEX_COLUMNS if c in df.columns))


def index_rows_sql(digits: int = 9, prefix: str = "") -> str:
    return ", ".join(
        f'"{c}"' if c == "HeatwaveIndex" else f'{r(f"{prefix}{chr(34)}{c}{chr(34)}", digits)} AS "{c}"'
        for c in INDEX_COLUMNS)
