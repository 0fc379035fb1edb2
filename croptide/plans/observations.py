"""Select hourly observations and store them as daily tables per variable and year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.constants import DEFAULT_PRODUCT
from croptide.functions.calendar import parse_utc_offset
from croptide.operators.filters import (
    filter_bbox,
    filter_calendar,
    filter_level,
    filter_product,
    filter_times,
)
from croptide.operators.temporal import daily_statistic, parse_frequency, subsample
from croptide.sinks import existing_keys, store_request

KEYS = ("latitude", "longitude")
#: Names of statistics that have two.
_ONE_NAME = {"daily_max": "daily_maximum", "daily_min": "daily_minimum"}


def select_observations(df: DataFrame, start_year: int, end_year: int,
                        months: Sequence | None = None, days: Sequence | None = None,
                        times: Sequence[str] | None = None,
                        bbox: Sequence[float] | None = None, pressure_level=None,
                        product_type=None, frequency: str | int | None = None,
                        time: str = "valid_time", utc_offset: str | None = None) -> DataFrame:
    """All filters of one request, each only when asked for.

    ``utc_offset`` makes years, months and days local; ``times`` and
    ``frequency`` are hours of the observations as they are.
    """
    df = filter_calendar(df, start_year, end_year, months, days, time, utc_offset)
    if bbox is not None:
        df = filter_bbox(df, bbox)
    if product_type is not None:
        df = filter_product(df, product_type)
    if pressure_level is not None:
        df = filter_level(df, pressure_level)
    if times:
        df = filter_times(df, times, time)
    if frequency is not None:
        df = subsample(df, frequency, time)
    return df


def _listed(value) -> list | None:
    if value is None or isinstance(value, list | tuple | set | range):
        return None if value is None else list(value)
    return [value]


def _request(time_zone: str, months=None, days=None, times=None, bbox=None, frequency=None
             ) -> dict:
    """What a partition's name leaves open, in one spelling."""
    months, days = (sorted({int(v) for v in values}) if values else full
                    for values, full in ((months, list(range(1, 13))), (days, list(range(1, 32)))))
    return {"months": months, "days": days, "times": sorted({t[:5] for t in times or ()}),
            "bbox": [float(x) for x in bbox] if bbox is not None else None,
            "frequency": None if frequency is None else parse_frequency(frequency),
            "utc_offset": parse_utc_offset(time_zone)}


def load_observations(df: DataFrame, path: str, variables: Sequence[str] | str,
                      start_year: int, end_year: int, daily_stat: str = "daily_mean",
                      time_zone: str = "utc+00:00", overwrite: bool = False,
                      time: str = "valid_time", product_type=DEFAULT_PRODUCT,
                      pressure_level=None, on_mismatch: str = "keep", **request) -> str:
    """Daily values of some variables, stored by what they are and year.

    Partitions are (variable, statistic, product, level, year), product and level
    where observations have such a column; so another statistic, product or
    level of a variable is another partition. ``product_type`` is the reanalysis
    unless told otherwise, a name, a list or None for all; products are never
    mixed. Years are those of the local days in ``time_zone``, for the choice of
    rows and for the partitions alike, so a request never touches a neighbouring
    year.

    Partitions already stored are skipped unless ``overwrite``. What else was asked
    for (months, days, times, box, frequency, offset) is noted beside them; a
    stored partition that other such values made is kept with a warning, refused
    (``on_mismatch="error"``) or written anew (``"replace"``).
    """
    spark = df.sparkSession
    if existing_keys(spark, path, ("variable", "year")) or existing_keys(
            spark, path, ("variable", "level", "year")):
        raise ValueError(f"{path} holds partitions that don't name their statistic")
    variables = [variables] if isinstance(variables, str) else list(variables)
    products = _listed(product_type) if "product_type" in df.columns else None
    levels = _listed(pressure_level)
    chosen = select_observations(df, start_year, end_year, time=time, utc_offset=time_zone,
                                 product_type=products, pressure_level=levels, **request)
    kinds = [c for c in ("product_type", "level") if c in df.columns]
    daily = reduce(DataFrame.unionByName, (
        daily_statistic(chosen, v, daily_stat, time_zone, [*KEYS, *kinds], time)
        .withColumnRenamed(v, "value").withColumn("variable", F.lit(v))
        for v in variables))
    statistic = _ONE_NAME.get(daily_stat, daily_stat)
    wanted = {"variable": variables, "statistic": [statistic],
              "year": range(start_year, end_year + 1)}
    if products is not None:
        wanted["product_type"] = products
    if levels is not None:
        wanted["level"] = levels
    return store_request(
        daily.withColumn("statistic", F.lit(statistic)).withColumn("year", F.year("date")),
        path, ("variable", "statistic", *kinds, "year"), _request(time_zone, **request), wanted,
        overwrite, on_mismatch)
