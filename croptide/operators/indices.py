"""The six climate indices over cubes.

Windowed indices partition by cell (days on record bound the partition) or by
cell and day of year (years on record bound it). Both are satisfied by one hash
exchange on the cell.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croptide.constants import CELL, CUBE_COORDS, INDEX_NAMES
from croptide.functions.climate import et_ratio, gdd, hot_day, wind_speed
from croptide.functions.windows import rolling_sum


def climatology(df: DataFrame, value: str, cell: Sequence[str] = CELL,
                date: str = "date") -> DataFrame:
    """Mean and population deviation per cell and day of year (1–366)."""
    return (df.groupBy(*cell, F.dayofyear(date).alias("dayofyear"))
            .agg(F.avg(value).alias("mean"),
                 F.coalesce(F.stddev_pop(value), F.lit(0.0)).alias("std")))


def _z_score(x: Column, day: Column, cell: Sequence[str], min_std: float) -> Column:
    """Standardise against the cell's own day of year; flat groups give 0.

    The window form reuses the exchange of the rolling windows; grouping and
    joining back would add two shuffles and read the input twice.
    """
    group = Window.partitionBy(*cell, day)
    std = F.stddev_pop(x).over(group)
    return F.when(std > F.lit(float(min_std)),
                  (x - F.avg(x).over(group)) / std).otherwise(F.lit(0.0))


def standardize(df: DataFrame, value: str, min_std: float = 1e-6,
                out: str = "anomaly", cell: Sequence[str] = CELL,
                date: str = "date") -> DataFrame:
    return (df.withColumn("_doy", F.dayofyear(date))
            .withColumn(out, _z_score(F.col(value), F.col("_doy"), cell, min_std))
            .drop("_doy"))


def _rain_total(precip: str, window: int, cell: Sequence[str], date: str) -> Column:
    rain = F.greatest(F.coalesce(F.col(precip), F.lit(0.0)), F.lit(0.0))
    return rolling_sum(rain, window, window, cell, date)


def spi(df: DataFrame, precip: str = "precip", window: int = 30,
        min_std: float = 1e-6, out: str = "SPI", cell: Sequence[str] = CELL,
        date: str = "date") -> DataFrame:
    """Standardised anomaly of the trailing rain total.

    Missing rain counts as none. The first ``window - 1`` days have no total and
    are missing, except in flat groups, which give 0 throughout.
    """
    return (df.withColumn("_total", _rain_total(precip, window, cell, date))
            .withColumn("_doy", F.dayofyear(date))
            .withColumn(out, _z_score(F.col("_total"), F.col("_doy"), cell, min_std))
            .drop("_total", "_doy"))


def sma(df: DataFrame, soil: str = "soil", min_std: float = 1e-6,
        out: str = "SoilMoistureAnomaly", cell: Sequence[str] = CELL,
        date: str = "date") -> DataFrame:
    """Standardised soil moisture; missing input stays missing."""
    return (df.withColumn("_doy", F.dayofyear(date))
            .withColumn(out, F.when(F.col(soil).isNotNull(), _z_score(
                F.col(soil), F.col("_doy"), cell, min_std)))
            .drop("_doy"))


def heatwave(df: DataFrame, tmax: str = "tmax", threshold: float = 35.0,
             window: int = 7, out: str = "HeatwaveIndex",
             cell: Sequence[str] = CELL, date: str = "date") -> DataFrame:
    """Hot days in the trailing window, counted from the first day on."""
    days = rolling_sum(hot_day(tmax, threshold), window, 1, cell, date)
    return df.withColumn(out, days.cast("smallint"))


def compute_indices(df: DataFrame, indices: Iterable[str] | None = None,
                    cell: Sequence[str] = CELL, date: str = "date") -> DataFrame:
    """All indices (or some) over the assembled variables, as one wide table.

    Cell windows are stated first and day-of-year windows second, so Spark plans
    one exchange, one sort and one window for each of the two. An index whose
    inputs are absent is skipped with a warning; an unknown name is an error.
    """
    wanted = list(INDEX_NAMES if indices is None else indices)
    unknown = [i for i in wanted if i not in INDEX_NAMES]
    if unknown:
        raise ValueError(f"unknown indices {unknown}; one of {list(INDEX_NAMES)}")

    # Stage 1: what is row-local or a trailing window over the cell.
    first = {
        "GDD": lambda: gdd("tmax", "tmin"),
        "SPI": lambda: _rain_total("precip", 30, cell, date),
        "SoilMoistureAnomaly": lambda: F.col("soil"),
        "EvapotranspirationRatio": lambda: et_ratio("evap", "precip"),
        "HeatwaveIndex": lambda: rolling_sum(hot_day("tmax"), 7, 1, cell, date)
        .cast("smallint"),
        "WindSpeed": lambda: wind_speed("u_wind", "v_wind"),
    }
    keep = [c for c in (*CUBE_COORDS, date, *cell) if c in df.columns]
    keep = list(dict.fromkeys(keep))
    columns = {}
    for name in wanted:
        try:
            df.select(first[name]())
        except AnalysisException as e:
            warnings.warn(f"index {name} skipped: {e.getCondition()}", stacklevel=2)
            continue
        columns[name] = first[name]()
    out = df.select(*keep, *(c.alias(n) for n, c in columns.items()))

    # Stage 2: anomalies against the day of year.
    if not {"SPI", "SoilMoistureAnomaly"} & set(columns):
        return out
    out = out.withColumn("_doy", F.dayofyear(date))
    day = F.col("_doy")
    second = {n: F.col(n) for n in columns}
    if "SPI" in second:
        second["SPI"] = _z_score(F.col("SPI"), day, cell, 1e-6)
    if "SoilMoistureAnomaly" in second:
        soil = F.col("SoilMoistureAnomaly")
        second["SoilMoistureAnomaly"] = F.when(
            soil.isNotNull(), _z_score(soil, day, cell, 1e-6))
    return out.select(*keep, *(c.alias(n) for n, c in second.items()))


def indices_long(df: DataFrame, indices: Iterable[str] = INDEX_NAMES) -> DataFrame:
    """The wide index table as (coordinates, variable, value) rows."""
    names = [i for i in indices if i in df.columns]
    coords = [c for c in CUBE_COORDS if c in df.columns]
    return (df.select(*coords, *(F.col(n).cast("double").alias(n) for n in names))
            .unpivot(coords, names, "variable", "value"))
