"""Row-local climate formulas.

Missing values are NULL everywhere (sources turn NaN into NULL), so a CASE with
a NULL condition takes its ELSE branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from croptide.constants import KELVIN_ZERO

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c: ColumnOrName) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def kelvin_to_celsius(c: ColumnOrName) -> Column:
    return _col(c) - F.lit(KELVIN_ZERO)


def gdd(tmax: ColumnOrName, tmin: ColumnOrName, base: float = 10.0) -> Column:
    """Growing degree days; a missing temperature counts as no growth (0)."""
    mean = (kelvin_to_celsius(tmax) + kelvin_to_celsius(tmin)) / F.lit(2.0)
    base = F.lit(float(base))
    return F.when(mean > base, mean - base).otherwise(F.lit(0.0))


def et_ratio(evap: ColumnOrName, precip: ColumnOrName,
             min_precip: float = 1e-4) -> Column:
    """|evaporation| / precipitation where it rained enough, else missing."""
    precip = _col(precip)
    wet = F.when(precip < 0, F.lit(0.0)).otherwise(precip)
    return F.when(wet >= F.lit(float(min_precip)),
                  F.try_divide(F.abs(_col(evap)), wet))


def hot_day(tmax: ColumnOrName, threshold: float = 35.0) -> Column:
    """1 on days strictly above the threshold in °C, else 0 (also if missing)."""
    return F.when(kelvin_to_celsius(tmax) > F.lit(float(threshold)), 1).otherwise(0)


def wind_speed(u: ColumnOrName, v: ColumnOrName) -> Column:
    u, v = _col(u), _col(v)
    return F.sqrt(u * u + v * v)
