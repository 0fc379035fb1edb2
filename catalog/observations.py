"""Sub-daily observations: filters, subsampling, daily statistics, time types."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import OBSERVATIONS, observations, r, rounded
from croptide.operators import filters, normalize, temporal
from croptide.plans.observations import select_observations

STATS = {"daily_mean": "avg", "daily_maximum": "max", "daily_minimum": "min",
         "daily_sum": "sum"}


def _daily(stat):
    def run(spark, sf):
        out = temporal.daily_statistic(observations(spark, sf), "value", stat,
                                       "utc-05:00", ("latitude", "longitude"))
        return out.select("date", "latitude", "longitude", rounded("value").alias("value"))
    return run


def _daily_sql(fn: str) -> str:
    return f"""
WITH {OBSERVATIONS}
SELECT CAST(valid_time - INTERVAL 5 HOUR AS DATE) AS date, latitude, longitude,
       {r(f'{fn}(value)')} AS value
FROM obs GROUP BY 1, 2, 3"""


def q_subsample(spark, sf):
    return temporal.subsample(observations(spark, sf), "6_hourly")


def q_times(spark, sf):
    return filters.filter_times(observations(spark, sf), ["00:00", "06:30", "12:15", "18:45"])


def q_level(spark, sf):
    obs = observations(spark, sf)
    return filters.filter_level(obs, 3).unionByName(filters.filter_level(obs, [0, 1]))


def q_product(spark, sf):
    return filters.filter_product(observations(spark, sf), ["view", "click"])


def q_request(spark, sf):
    """One request with every filter, then the daily mean."""
    chosen = select_observations(
        observations(spark, sf), 2024, 2024, months=["01"], days=range(2, 29),
        bbox=[8.0, 0.0, 1.0, 12.0], pressure_level=[0, 1, 2, 3],
        product_type=["view", "click", "signup"], frequency="3h")
    out = temporal.daily_statistic(chosen, "value", "daily_mean", "utc-05:00",
                                   ("latitude", "longitude", "level"))
    return out.select("date", "latitude", "longitude", "level",
                      rounded("value").alias("value"))


def q_utc(spark, sf):
    """Zone-less times read as UTC and as New York wall-clock time."""
    obs = observations(spark, sf).select("station", "valid_time")
    utc = normalize.to_utc_date(obs, "valid_time")
    local = normalize.to_utc_date(obs, "valid_time", "America/New_York")
    return (utc.select("station", F.lit("UTC").alias("zone"), "Date").unionByName(
        local.select("station", F.lit("America/New_York").alias("zone"), "Date"))
        .select("station", "zone", F.unix_micros("Date").alias("utc_micros")))


def q_intervals(spark, sf):
    """Activity span per station and day as an interval, text and a number."""
    obs = observations(spark, sf)
    span = F.max("valid_time") - F.min("valid_time")
    rows = obs.groupBy("station", F.to_date("valid_time").alias("date")).agg(
        span.alias("Span_A"),
        F.when(F.count("value") > 1, F.max("level").cast("string"))
        .otherwise(F.lit("n/a")).alias("Span_B"),
        F.min("value").alias("Span_C"),
        F.max("product_type").alias("Other_A"))
    out = normalize.intervals_to_seconds(rows, ["Span", "Absent"])
    return out.select("station", "date", rounded("Span_A").alias("Span_A"), "Span_B",
                      "Span_C", "Other_A")


_ALL = ("valid_time, station, latitude, longitude, level, product_type, value")

QUERIES = {
    **{("daily_statistic" if s == "daily_mean" else s): (_daily(s), _daily_sql(fn))
       for s, fn in STATS.items()},
    "subsample": (q_subsample, f"""
WITH {OBSERVATIONS} SELECT {_ALL} FROM obs WHERE hour(valid_time) % 6 = 0"""),
    "filter_times": (q_times, f"""
WITH {OBSERVATIONS} SELECT {_ALL} FROM obs
WHERE strftime(valid_time, '%H:%M') IN ('00:00', '06:30', '12:15', '18:45')"""),
    "filter_level": (q_level, f"""
WITH {OBSERVATIONS} SELECT {_ALL} FROM obs WHERE level IN (0, 1, 3)"""),
    "filter_product": (q_product, f"""
WITH {OBSERVATIONS} SELECT {_ALL} FROM obs WHERE product_type IN ('view', 'click')"""),
    "observation_request": (q_request, f"""
WITH {OBSERVATIONS}
SELECT CAST(valid_time - INTERVAL 5 HOUR AS DATE) AS date, latitude, longitude, level,
       {r('avg(value)')} AS value
FROM obs
WHERE year(valid_time) = 2024 AND month(valid_time) = 1
  AND day(valid_time) BETWEEN 2 AND 28 AND latitude BETWEEN 1 AND 8
  AND longitude BETWEEN 0 AND 12 AND level IN (0, 1, 2, 3)
  AND product_type IN ('view', 'click', 'signup') AND hour(valid_time) % 3 = 0
GROUP BY 1, 2, 3, 4"""),
    # New York is five hours behind UTC throughout the January of the events.
    "to_utc_date": (q_utc, f"""
WITH {OBSERVATIONS}
SELECT station, zone, epoch_us(valid_time + h * INTERVAL 1 HOUR) AS utc_micros
FROM obs CROSS JOIN (VALUES ('UTC', 0), ('America/New_York', 5)) AS z(zone, h)"""),
    "intervals_to_seconds": (q_intervals, f"""
WITH {OBSERVATIONS}
SELECT station, CAST(valid_time AS DATE) AS date,
       {r('(epoch_us(max(valid_time)) - epoch_us(min(valid_time))) / 1000000.0E0')} AS "Span_A",
       TRY_CAST(CASE WHEN count(value) > 1 THEN CAST(max(level) AS VARCHAR)
                     ELSE 'n/a' END AS DOUBLE) AS "Span_B",
       min(value) AS "Span_C", max(product_type) AS "Other_A"
FROM obs GROUP BY station, CAST(valid_time AS DATE)"""),
}
