"""Window expressions over one cell or one series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from croptide.functions.climate import ColumnOrName, _col


def rolling_sum(c: ColumnOrName, n: int, min_periods: int,
                part: Sequence[str], order: str) -> Column:
    """Sum over the last ``n`` rows; missing below ``min_periods`` values.

    Rows are positional, not calendar days, and missing values add nothing.
    """
    c = _col(c)
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(w) >= min_periods, F.sum(c).over(w))


def ffill_column(c: ColumnOrName, part: Sequence[str], order: str) -> Column:
    """Last known value, carried forward without limit."""
    w = (Window.partitionBy(*part).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, 0))
    return F.last(_col(c), ignorenulls=True).over(w)


def bfill_column(c: ColumnOrName, part: Sequence[str], order: str,
                 limit: int = 10) -> Column:
    """Next known value, at most ``limit`` rows ahead."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(0, limit)
    return F.first(_col(c), ignorenulls=True).over(w)
