"""The weekly predictor table from climate belts and market series."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import daily_prices, monday_sql, r, rounded
from catalog.series import QUARTERLY, quarterly, releases, table
from catalog.space import BELT, _indices_by_region
from croptide.operators import series, spatial
from croptide.plans.weekly import belt_series, predictor_run, weekly_predictors
from croptide.session import stage_path

START, END = "1995-01-01", "2001-12-31"
CARRY_START = "1995-02-15"
BELT_REGIONS = ["AFRICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _sources(spark, sf):
    belt = spatial.belt_aggregate(_indices_by_region(spark, sf), BELT_REGIONS)
    q = quarterly(spark, sf)
    supply = series.disaggregate_quarterly(
        q.unpivot(["date"], q.columns[1:], "series", "value")
        .withColumn("series", F.concat(F.lit("quarterly_supply."), "series")))
    macro = series.hold_to_monthly(
        releases(spark, sf).withColumn(
            "series", F.concat(F.lit("GDP_"), F.substring("series", 1, 1))),
        "1995-01-01", "2001-12-31")
    orders = table(spark, sf, "orders")
    market = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.max("o_totalprice").alias("value")).select(F.lit("ZW=F").alias("series"),
                                                     "date", "value")
    farm = orders.groupBy(F.to_date(F.trunc("o_orderdate", "MM")).alias("date")).agg(
        F.max("o_totalprice").alias("value")).select(
        F.lit("farm_price.Price_USD_per_Bushel").alias("series"), "date", "value")
    return [belt_series(belt), supply, macro, market, farm]


def _names():
    belts = []
    for v in ("GDD", "SPI", "SoilMoistureAnomaly", "EvapotranspirationRatio",
              "HeatwaveIndex", "WindSpeed"):
        belts += [f"{v}_Belt_Mean", f"{v}_Belt_Std"]
        if v in ("SPI", "SoilMoistureAnomaly"):
            belts.append(f"{v}_Belt_Min")
        if v in ("HeatwaveIndex", "GDD"):
            belts.append(f"{v}_Belt_Max")
    return [*belts, "US_Exports_M_Bu", "US_Ending_Stocks_M_Bu",
            *(f"GDP_{k}" for k in range(1, 6)), "ZW=F", "Price_USD_per_Bushel"]


NAMES = _names()


def digits(name: str) -> int:
    """Belts are small means of means; the other series are large amounts."""
    return 9 if "_Belt_" in name else 4


def q_predictors(spark, sf):
    wide = weekly_predictors(_sources(spark, sf), START, END, names=NAMES)
    return wide.select("Date", *(rounded(f"`{c}`", digits(c)).alias(c)
                                 for c in wide.columns if c != "Date"))


def q_merge(spark, sf):
    """Daily, monthly and quarterly series of orders, names found by the engine."""
    q = quarterly(spark, sf)
    long = q.unpivot(["date"], q.columns[1:], "series", "value")
    monthly = series.disaggregate_quarterly(long).withColumn("how", F.lit("mean"))
    daily = daily_prices(spark, sf).withColumn("how", F.lit("last"))
    wide = series.merge_weekly([daily, monthly], START, END, target="nation_7")
    return wide.select("Date", *(rounded(f"`{c}`", digits(c)).alias(c)
                                 for c in wide.columns if c != "Date"))


def q_predictor_run(spark, sf):
    """Stored regional features and published tables through the whole job."""
    features = stage_path(spark, "features")
    wide = spatial.pivot_regions(_indices_by_region(spark, sf))
    wide.withColumnRenamed("date", "Date").write.parquet(features)
    orders = table(spark, sf, "orders")

    def published(date, name):
        path = stage_path(spark, "published")
        (orders.groupBy(F.to_date(date).alias("Date"))
         .agg(F.max("o_totalprice").cast("decimal(15,2)").alias(name))
         .write.option("header", True).csv(path))
        return path

    tables = {"market": published("o_orderdate", "ZW=F"),
              "farm_price": published(F.trunc("o_orderdate", "MM"), "Price_USD_per_Bushel")}
    path = predictor_run(spark, features, tables, stage_path(spark, "predictors"),
                         BELT_REGIONS, START, END)
    back = spark.read.parquet(path)
    return back.select("Date", *(rounded(f"`{c}`", digits(c)).alias(c)
                                 for c in back.columns if c != "Date"))


def q_merge_carry(spark, sf):
    """Quarterly releases from a start within a quarter: the last one holds there."""
    wide = series.merge_weekly([releases(spark, sf)], CARRY_START, END, target=None)
    return wide.select("Date", *(rounded(f"`{c}`", 4).alias(c)
                                 for c in wide.columns if c != "Date"))


def chain_sql(rows: str, how: str, start: str = START, first: str = "1995-01-02") -> str:
    """Resample, densify and fill the rows (series, date, value).

    ``first`` is the first Monday from ``start`` on. What a series held last
    before the start stands in the week before it.
    """
    return f"""
rows_in AS ({rows}),
parts AS (
  SELECT series, {monday_sql('date')} AS week, date < DATE '{start}' AS early,
         CASE {how} WHEN 'sum' THEN sum(value) WHEN 'last' THEN arg_max(value, date)
              ELSE avg(value) END AS value
  FROM rows_in WHERE date <= DATE '{END}' GROUP BY 1, 2, 3),
wk AS (
  SELECT series, week, value FROM parts WHERE NOT early
  UNION ALL
  SELECT series, DATE '{first}' - 7, arg_max(value, week) FROM parts
  WHERE early AND value IS NOT NULL
    AND series IN (SELECT series FROM parts WHERE NOT early)
  GROUP BY 1),
cal AS (SELECT CAST(d AS DATE) AS week FROM
        unnest(range(DATE '{first}' - 7, DATE '2002-01-01', INTERVAL 7 DAY)) AS t(d)),
sr AS (SELECT DISTINCT series FROM wk),
dn AS (SELECT sr.series, cal.week, wk.value FROM sr CROSS JOIN cal
       LEFT JOIN wk ON wk.series = sr.series AND wk.week = cal.week),
ff AS (SELECT series, week, last_value(value IGNORE NULLS) OVER (
         PARTITION BY series ORDER BY week
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM dn),
bf AS (SELECT series, week, first_value(value IGNORE NULLS) OVER (
         PARTITION BY series ORDER BY week
         ROWS BETWEEN CURRENT ROW AND 10 FOLLOWING) AS value FROM ff
       WHERE week >= DATE '{first}'),
rt AS (SELECT series, week, value, (value / lag(value) OVER (
         PARTITION BY series ORDER BY week) - 1) * 100 AS gain FROM bf)"""


def wide_sql(names, target: str) -> str:
    one = "max(CASE WHEN series = '{n}' THEN value END)"
    cols = ", ".join(f'{r(one.format(n=n), digits(n))} AS "{n}"' for n in names)
    gain = f"max(CASE WHEN series = '{target}' THEN gain END)"
    return (f'SELECT week AS "Date", {cols}, {r(gain, 4)} AS "Target_Return" '
            "FROM rt GROUP BY week")


_BELT_ROWS = " UNION ALL ".join(
    f"""SELECT variable || '_{s}' AS series, date, "{s}" AS value FROM belt
  WHERE "{s}" IS NOT NULL""" for s in ("Belt_Mean", "Belt_Std", "Belt_Min", "Belt_Max"))
_MONTHS3 = "CROSS JOIN unnest(range(0, 3)) AS t(m)"
_SUPPLY_ROWS = f"""
  SELECT 'US_Exports_M_Bu' AS series, CAST(date + m * INTERVAL 1 MONTH AS DATE) AS date,
         flow / 3 AS value FROM quarterly {_MONTHS3}
  UNION ALL
  SELECT 'US_Ending_Stocks_M_Bu', CAST(date + m * INTERVAL 1 MONTH AS DATE), level
  FROM quarterly {_MONTHS3}"""

RELEASES = """
rel AS (
  SELECT o_orderpriority AS series, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date,
         CAST(count(*) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2
  HAVING o_orderpriority <> '5-LOW'
      OR CAST(date_trunc('quarter', o_orderdate) AS DATE) >= DATE '1996-07-01')"""

PREDICTORS_SQL = f"""
WITH {BELT}, {QUARTERLY},
{RELEASES},
mcal AS (SELECT CAST(d AS DATE) AS date FROM
         unnest(range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 MONTH)) AS t(d)),
{chain_sql(f'''
  {_BELT_ROWS} UNION ALL {_SUPPLY_ROWS} UNION ALL
  SELECT 'GDP_' || p.series[1], mcal.date, last_value(rel.value IGNORE NULLS) OVER (
    PARTITION BY p.series
    ORDER BY mcal.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (SELECT DISTINCT series FROM rel) p CROSS JOIN mcal
  LEFT JOIN rel ON rel.date = mcal.date AND rel.series = p.series
  UNION ALL
  SELECT 'ZW=F', CAST(o_orderdate AS DATE), max(o_totalprice) FROM orders GROUP BY 2
  UNION ALL
  SELECT 'Price_USD_per_Bushel', CAST(date_trunc('month', o_orderdate) AS DATE),
         max(o_totalprice) FROM orders GROUP BY 2''', """
    CASE WHEN series LIKE 'GDD%' THEN 'sum'
         WHEN series IN ('ZW=F', 'Price_USD_per_Bushel') THEN 'last' ELSE 'mean' END""")}
{wide_sql(NAMES, 'ZW=F')}"""

MERGE_SQL = f"""
WITH {QUARTERLY},
og AS (SELECT 'nation_' || CAST(c_nationkey AS VARCHAR) AS series,
              CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
{chain_sql(f'SELECT series, date, value FROM og UNION ALL {_SUPPLY_ROWS}',
           "CASE WHEN series LIKE 'nation%' THEN 'last' ELSE 'mean' END")}
{wide_sql([*(f'nation_{i}' for i in range(25)), 'US_Exports_M_Bu',
           'US_Ending_Stocks_M_Bu'], 'nation_7')}"""

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
CARRY_SQL = f"""
WITH {RELEASES},
{chain_sql('SELECT series, date, value FROM rel', "'mean'", CARRY_START, '1995-02-20')}
SELECT week AS "Date", {", ".join(
    f"""{r(f"max(CASE WHEN series = '{p}' THEN value END)", 4)} AS "{p}" """
    for p in _PRIORITIES)}
FROM bf GROUP BY week"""

PREDICTOR_RUN_SQL = f"""
WITH {BELT},
{chain_sql(f'''
  {_BELT_ROWS} UNION ALL
  SELECT 'ZW=F', CAST(o_orderdate AS DATE), max(o_totalprice) FROM orders GROUP BY 2
  UNION ALL
  SELECT 'Price_USD_per_Bushel', CAST(date_trunc('month', o_orderdate) AS DATE),
         max(o_totalprice) FROM orders GROUP BY 2''', """
    CASE WHEN series LIKE 'GDD%' THEN 'sum'
         WHEN series IN ('ZW=F', 'Price_USD_per_Bushel') THEN 'last' ELSE 'mean' END""")}
{wide_sql([n for n in NAMES if not n.startswith(("US_", "GDP_"))], 'ZW=F')}"""

QUERIES = {
    "predictor_run": (q_predictor_run, PREDICTOR_RUN_SQL),
    "merge_weekly": (q_merge, MERGE_SQL),
    "merge_weekly_carry": (q_merge_carry, CARRY_SQL),
    "weekly_predictors": (q_predictors, PREDICTORS_SQL),
}
