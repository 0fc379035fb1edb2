"""Predicates on space, calendar, level and product.

Each is a plain comparison so that it reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.functions.calendar import parse_utc_offset


def _listed(value) -> list:
    if isinstance(value, str) or not isinstance(value, Iterable):
        return [value]
    return list(value)


def filter_bbox(df: DataFrame, bbox: Sequence[float], lat: str = "latitude",
                lon: str = "longitude") -> DataFrame:
    """Keep ``[north, west, south, east]``, edges included."""
    north, west, south, east = (float(x) for x in bbox)
    return df.filter(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def filter_calendar(df: DataFrame, start_year: int, end_year: int,
                    months: Iterable | None = None, days: Iterable | None = None,
                    time: str = "valid_time", utc_offset: str | None = None) -> DataFrame:
    """Whole years ``start_year … end_year``, optionally some months and days.

    Years are a range on the time column (pushed to the scan) and, where the
    table is partitioned by ``year``, also on that column (prunes folders). With
    ``utc_offset`` the calendar is the local one: the range is shifted by the
    offset, and the year before or after may hold a few hours of it.
    """
    minutes = parse_utc_offset(utc_offset) if utc_offset else 0
    t = F.col(time)
    if minutes:
        shift = timedelta(minutes=minutes)
        bounds = [F.lit(datetime(y, 1, 1) - shift).cast(df.schema[time].dataType)
                  for y in (start_year, end_year + 1)]
        local = t + F.make_dt_interval(mins=F.lit(minutes))
    else:
        bounds = [F.lit(date(y, 1, 1)) for y in (start_year, end_year + 1)]
        local = t
    keep = (t >= bounds[0]) & (t < bounds[1])
    if "year" in df.columns and time != "year":
        keep &= F.col("year").between(start_year - (minutes > 0), end_year + (minutes < 0))
    if months:
        keep &= F.month(local).isin([int(m) for m in months])
    if days:
        keep &= F.dayofmonth(local).isin([int(d) for d in days])
    return df.filter(keep)


def filter_times(df: DataFrame, times: Iterable[str],
                 time: str = "valid_time") -> DataFrame:
    """Keep observations made at one of the ``HH:MM`` times of day."""
    minutes = [int(t[:2]) * 60 + int(t[3:5]) for t in times]
    return df.filter((F.hour(time) * 60 + F.minute(time)).isin(minutes))


def filter_level(df: DataFrame, levels, level: str = "level") -> DataFrame:
    """Keep one pressure level or a list of them."""
    return df.filter(F.col(level).isin(_listed(levels)))


def filter_product(df: DataFrame, product, column: str = "product_type") -> DataFrame:
    """Keep one product type or a list of them."""
    return df.filter(F.col(column).isin(_listed(product)))


def clip_dates(df: DataFrame, start: str, end: str, column: str = "date") -> DataFrame:
    """Keep ``start … end``, both days included."""
    return df.filter(F.col(column).between(F.lit(start).cast("date"),
                                           F.lit(end).cast("date")))
