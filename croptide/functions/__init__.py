"""Column expressions: everything here stays inside whole-stage codegen."""

from croptide.functions.calendar import (
    closing_monday,
    marketing_month,
    marketing_quarter,
    marketing_year,
)
from croptide.functions.climate import (
    et_ratio,
    gdd,
    hot_day,
    kelvin_to_celsius,
    null_if_nan,
    wind_speed,
)
from croptide.functions.windows import bfill_column, ffill_column, rolling_sum

__all__ = [
    "bfill_column",
    "closing_monday",
    "et_ratio",
    "ffill_column",
    "gdd",
    "hot_day",
    "kelvin_to_celsius",
    "marketing_month",
    "marketing_quarter",
    "marketing_year",
    "null_if_nan",
    "rolling_sum",
    "wind_speed",
]
