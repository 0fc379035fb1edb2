"""Sub-daily observations to daily values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.constants import CELL
from croptide.functions.calendar import parse_utc_offset

DAILY_STATISTICS = {
    "daily_mean": F.avg,
    "daily_maximum": F.max,
    "daily_max": F.max,
    "daily_minimum": F.min,
    "daily_min": F.min,
    "daily_sum": F.sum,
}


def parse_frequency(text: str | int) -> int:
    """Hours of ``6h``, ``6_hourly`` or ``6``."""
    m = re.fullmatch(r"(\d+)(h|_hourly)?", str(text).strip().lower())
    if not m or int(m[1]) == 0:
        raise ValueError(f"not an hourly frequency: {text!r}")
    return int(m[1])


def subsample(df: DataFrame, hours: int | str, time: str = "valid_time") -> DataFrame:
    """Keep the observations of every n-th hour of the day."""
    return df.filter(F.hour(time) % parse_frequency(hours) == 0)


def daily_statistic(df: DataFrame, value: str, stat: str = "daily_mean",
                    utc_offset: str = "utc+00:00", keys: Sequence[str] = CELL,
                    time: str = "valid_time", date: str = "date") -> DataFrame:
    """One value per key and local day.

    Every statistic combines map-side, so a cell that holds a large share of the
    observations reaches the shuffle as one row per day and task.
    """
    if stat not in DAILY_STATISTICS:
        raise ValueError(f"unknown statistic {stat!r}; one of {sorted(DAILY_STATISTICS)}")
    shift = F.make_dt_interval(mins=F.lit(parse_utc_offset(utc_offset)))
    day = F.to_date(F.col(time) + shift).alias(date)
    return (df.groupBy(*keys, day)
            .agg(DAILY_STATISTICS[stat](F.col(value)).alias(value)))
