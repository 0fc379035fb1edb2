"""Calendars, resampling, filling and returns over order series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.fixtures import PRICES, daily_prices, monday_sql, r, rounded, table
from croptide.operators import series
from croptide.session import stage_path
from croptide.sources import read_series

START, END = "1995-01-01", "2001-08-12"
MONDAYS = ("unnest(range(DATE '1995-01-02', DATE '2001-08-07', INTERVAL 7 DAY))")


def _order_days(spark, sf):
    return table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), "o_orderpriority", "o_totalprice")


def q_marketing(spark, sf):
    return series.marketing_calendar(_order_days(spark, sf).select("date").distinct())


MARKETING_YEAR = ("CAST(year({d} - INTERVAL 5 MONTH) AS VARCHAR) || '/' || "
                  "lpad(CAST((year({d} - INTERVAL 5 MONTH) + 1) % 100 AS VARCHAR), 2, '0')")
MARKETING_QUARTER = "CAST(floor(((month({d}) + 6) % 12) / 3.0) + 1 AS INT)"


def _year_start(d):
    return F.make_date(F.year(F.add_months(d, -5)), F.lit(6), F.lit(1))


def _quarter_start(d):
    return F.add_months(F.trunc(F.add_months(d, 1), "quarter"), -1)


def annual(spark, sf):
    """Marketing-year totals per priority."""
    o = _order_days(spark, sf)
    return o.groupBy("o_orderpriority", _year_start(F.col("date")).alias("date")).agg(
        F.count("o_totalprice").alias("orders"), F.max("o_totalprice").alias("top"))


def q_expand_annual(spark, sf):
    return series.expand_annual(annual(spark, sf))


def quarterly(spark, sf):
    """Marketing-quarter totals: a flow (sum) and a level (maximum)."""
    o = _order_days(spark, sf)
    return o.groupBy(_quarter_start(F.col("date")).alias("date")).agg(
        F.sum(F.round("o_totalprice").cast("long")).cast("double").alias("US_Exports_M_Bu"),
        F.max("o_totalprice").alias("US_Ending_Stocks_M_Bu"))


QUARTER_START = "CAST(date_trunc('quarter', {d} + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE)"
QUARTERLY = f"""
quarterly AS (
  SELECT {QUARTER_START.format(d='CAST(o_orderdate AS DATE)')} AS date,
         CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS flow,
         max(o_totalprice) AS level
  FROM orders GROUP BY 1)"""


def q_disaggregate(spark, sf):
    out = series.disaggregate_quarterly(quarterly(spark, sf))
    return out.select("date", rounded("US_Exports_M_Bu", 4).alias("US_Exports_M_Bu"),
                      "US_Ending_Stocks_M_Bu")


def q_disaggregate_long(spark, sf):
    q = quarterly(spark, sf)
    long = q.unpivot(["date"], q.columns[1:], "series", "value")
    long = long.withColumn("series", F.concat(F.lit("quarterly_supply."), "series"))
    out = series.disaggregate_quarterly(long)
    return out.select("date", "series", rounded("value", 4).alias("value"))


def releases(spark, sf):
    """Calendar-quarter order counts per priority; the lowest starts late."""
    o = _order_days(spark, sf)
    rows = o.groupBy(F.col("o_orderpriority").alias("series"),
                     F.trunc("date", "quarter").alias("date")).agg(
        F.count("*").cast("double").alias("value"))
    return rows.filter("series <> '5-LOW' OR date >= DATE '1996-07-01'")


def q_hold(spark, sf):
    return series.hold_to_monthly(releases(spark, sf), "1994-11-01", "2002-03-31")


def q_resample(spark, sf):
    p = daily_prices(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), (
        series.resample_weekly(p, how).select(
            F.lit(how).alias("how"), "series", "week", rounded("value", 4).alias("value"))
        for how in ("sum", "mean", "last")))


def q_resample_mixed(spark, sf):
    """A method per series; series without one are averaged."""
    how = {f"nation_{i}": ("sum", "last")[i % 2] for i in range(20)}
    out = series.resample_weekly(daily_prices(spark, sf), how)
    return out.select("series", "week", rounded("value", 4).alias("value"))


def _weekly(spark, sf):
    return series.resample_weekly(daily_prices(spark, sf), "last")


def _dense(spark, sf):
    return series.densify_weekly(_weekly(spark, sf), START, END)


def q_densify(spark, sf):
    return _dense(spark, sf)


def q_ffill(spark, sf):
    return series.ffill(_dense(spark, sf))


def q_bfill(spark, sf):
    return series.bfill(series.ffill(_dense(spark, sf)), limit=10)


def q_bfill_short(spark, sf):
    return series.bfill(_dense(spark, sf), limit=1)


def q_return(spark, sf):
    filled = series.bfill(series.ffill(_dense(spark, sf)))
    return series.pct_change(filled).select(
        "series", "week", "value", rounded("Target_Return", 6).alias("Target_Return"))


CHAIN = f"""
{PRICES},
wk AS (SELECT series, {monday_sql('date')} AS week, arg_max(value, date) AS value
       FROM prices GROUP BY 1, 2),
cal AS (SELECT CAST(d AS DATE) AS week FROM {MONDAYS} AS t(d)),
sr AS (SELECT DISTINCT series FROM wk),
dn AS (SELECT sr.series, cal.week, wk.value FROM sr CROSS JOIN cal
       LEFT JOIN wk ON wk.series = sr.series AND wk.week = cal.week),
ff AS (SELECT series, week, last_value(value IGNORE NULLS) OVER (
         PARTITION BY series ORDER BY week
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM dn),
bf AS (SELECT series, week, first_value(value IGNORE NULLS) OVER (
         PARTITION BY series ORDER BY week
         ROWS BETWEEN CURRENT ROW AND 10 FOLLOWING) AS value FROM ff)"""


def _csv(spark, df, name):
    path = stage_path(spark, name)
    df.write.option("header", True).csv(path)
    return path


def q_read_series(spark, sf):
    """Three of the table shapes, written from the orders and read back."""
    o = _order_days(spark, sf)
    price = o.groupBy(F.trunc("date", "MM").alias("Date")).agg(
        F.lit("All wheat").alias("Class"), F.date_format(F.first("date"), "MMM").alias("Month"),
        F.max("o_totalprice").alias("Price_USD_per_Bushel"))
    year = series.marketing_year("date")
    # The year rather than the dates make a row of the annual table.
    yearly = o.groupBy(year.alias("Marketing year 1")).agg(
        F.count("*").alias("US_Production_M_Bu"),
        F.max("o_totalprice").alias("US_Farm_Price_USD_Bu"))
    q = quarterly(spark, sf)
    quarter = series.marketing_quarter("date")
    label = F.concat(F.lit("Q"), quarter.cast("string"), F.lit(" "),
                     F.element_at(F.array(*(F.lit(x) for x in (
                         "Jun-Aug", "Sep-Nov", "Dec-Feb", "Mar-May"))), quarter))
    quarters = q.select(year.alias("Marketing_Year"), label.alias("Time_Period"),
                        "US_Exports_M_Bu", "US_Ending_Stocks_M_Bu")
    frames = [
        read_series(spark, _csv(spark, price, "price"), "farm_price", qualify=True),
        read_series(spark, _csv(spark, yearly, "annual"), "annual_supply", qualify=True),
        read_series(spark, _csv(spark, quarters, "quarter"), "quarterly_supply",
                    qualify=True),
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


D = "CAST(o_orderdate AS DATE)"
YEAR_START = f"make_date(CAST(year({D} - INTERVAL 5 MONTH) AS INT), 6, 1)"

QUERIES = {
    "marketing_calendar": (q_marketing, f"""
WITH d AS (SELECT DISTINCT {D} AS date FROM orders)
SELECT date, {MARKETING_YEAR.format(d='date')} AS "Marketing_Year",
       {MARKETING_QUARTER.format(d='date')} AS "Quarter",
       strftime(date, '%b') AS "Month" FROM d"""),
    "expand_annual": (q_expand_annual, f"""
WITH a AS (
  SELECT o_orderpriority, {YEAR_START} AS date, count(o_totalprice) AS orders,
         max(o_totalprice) AS top
  FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, CAST(date + m * INTERVAL 1 MONTH AS DATE) AS date, orders, top
FROM a CROSS JOIN unnest(range(0, 12)) AS t(m)"""),
    "disaggregate_quarterly": (q_disaggregate, f"""
WITH {QUARTERLY}
SELECT CAST(date + m * INTERVAL 1 MONTH AS DATE) AS date,
       {r('flow / 3', 4)} AS "US_Exports_M_Bu", level AS "US_Ending_Stocks_M_Bu"
FROM quarterly CROSS JOIN unnest(range(0, 3)) AS t(m)"""),
    "disaggregate_long": (q_disaggregate_long, f"""
WITH {QUARTERLY}
SELECT CAST(date + m * INTERVAL 1 MONTH AS DATE) AS date, series, {r('value', 4)} AS value
FROM (SELECT date, 'quarterly_supply.US_Exports_M_Bu' AS series, flow / 3 AS value
      FROM quarterly
      UNION ALL SELECT date, 'quarterly_supply.US_Ending_Stocks_M_Bu', level
      FROM quarterly) q
CROSS JOIN unnest(range(0, 3)) AS t(m)"""),
    "hold_to_monthly": (q_hold, f"""
WITH rel AS (
  SELECT * FROM (
    SELECT o_orderpriority AS series, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date,
           CAST(count(*) AS DOUBLE) AS value
    FROM orders GROUP BY 1, 2)
  WHERE series <> '5-LOW' OR date >= DATE '1996-07-01'),
cal AS (SELECT CAST(d AS DATE) AS date FROM
        unnest(range(DATE '1994-11-01', DATE '2002-04-01', INTERVAL 1 MONTH)) AS t(d)),
sr AS (SELECT DISTINCT series FROM rel)
SELECT sr.series, cal.date, last_value(rel.value IGNORE NULLS) OVER (
         PARTITION BY sr.series ORDER BY cal.date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM sr CROSS JOIN cal LEFT JOIN rel ON rel.series = sr.series AND rel.date = cal.date"""),
    "resample_weekly": (q_resample, f"""
WITH {PRICES}, w AS (
  SELECT series, {monday_sql('date')} AS week, sum(value) AS s, avg(value) AS a,
         arg_max(value, date) AS l
  FROM prices GROUP BY 1, 2)
SELECT 'sum' AS how, series, week, {r('s', 4)} AS value FROM w
UNION ALL SELECT 'mean', series, week, {r('a', 4)} FROM w
UNION ALL SELECT 'last', series, week, {r('l', 4)} FROM w"""),
    "resample_mixed": (q_resample_mixed, f"""
WITH {PRICES}, w AS (
  SELECT series, {monday_sql('date')} AS week, sum(value) AS s, avg(value) AS a,
         arg_max(value, date) AS l, CAST(substr(series, 8) AS INT) AS n
  FROM prices GROUP BY 1, 2)
SELECT series, week,
       {r('CASE WHEN n >= 20 THEN a WHEN n % 2 = 0 THEN s ELSE l END', 4)} AS value FROM w"""),
    "densify_weekly": (q_densify, f"WITH {CHAIN} SELECT series, week, value FROM dn"),
    "ffill": (q_ffill, f"WITH {CHAIN} SELECT series, week, value FROM ff"),
    "bfill": (q_bfill, f"WITH {CHAIN} SELECT series, week, value FROM bf"),
    "bfill_limit": (q_bfill_short, f"""
WITH {CHAIN}
SELECT series, week, first_value(value IGNORE NULLS) OVER (
         PARTITION BY series ORDER BY week
         ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS value FROM dn"""),
    "pct_change": (q_return, f"""
WITH {CHAIN}
SELECT series, week, value, {r('''(value / lag(value) OVER (
         PARTITION BY series ORDER BY week) - 1) * 100''', 6)} AS "Target_Return" FROM bf"""),
    "read_series": (q_read_series, f"""
WITH {QUARTERLY}
SELECT 'farm_price.Price_USD_per_Bushel' AS series,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS date, max(o_totalprice) AS value
FROM orders GROUP BY 2
UNION ALL
SELECT 'annual_supply.US_Production_M_Bu', {YEAR_START}, CAST(count(*) AS DOUBLE)
FROM orders GROUP BY 2
UNION ALL
SELECT 'annual_supply.US_Farm_Price_USD_Bu', {YEAR_START}, max(o_totalprice)
FROM orders GROUP BY 2
UNION ALL SELECT 'quarterly_supply.US_Exports_M_Bu', date, flow FROM quarterly
UNION ALL SELECT 'quarterly_supply.US_Ending_Stocks_M_Bu', date, level FROM quarterly"""),
}
