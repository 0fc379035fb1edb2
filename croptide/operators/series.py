"""Periodic series: calendars, resampling, filling, merging.

Series stay long, (series, date, value), until the last step. Once resampled
there is one row per series and week, so a window over a series is bounded by
the weeks in the calendar, however many raw rows the series had.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date as Date
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croptide.constants import (
    PREDICTOR_END,
    PREDICTOR_START,
    SUPPLY_FLOWS,
    SUPPLY_LEVELS,
    TARGET_SERIES,
)
from croptide.functions.calendar import (
    closing_monday,
    marketing_month,
    marketing_quarter,
    marketing_year,
)
from croptide.functions.windows import bfill_column, ffill_column
from croptide.session import stage_path

MAX_SERIES = 10_000


def marketing_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Add Marketing_Year, Quarter and Month."""
    return df.withColumns({
        "Marketing_Year": marketing_year(date),
        "Quarter": marketing_quarter(date),
        "Month": marketing_month(date),
    })


def _months(df: DataFrame, n: int, date: str) -> DataFrame:
    """Repeat every row on ``n`` month starts from its own date on."""
    start = F.trunc(date, "MM")
    return df.withColumn(date, F.explode(F.sequence(
        start, F.add_months(start, n - 1), F.expr("interval 1 month"))))


def expand_annual(df: DataFrame, date: str = "date") -> DataFrame:
    """Annual rows repeated on the twelve month starts of their year."""
    return _months(df, 12, date)


def disaggregate_quarterly(df: DataFrame, flows: Sequence[str] = SUPPLY_FLOWS,
                           levels: Sequence[str] = SUPPLY_LEVELS,
                           date: str = "date") -> DataFrame:
    """Quarterly rows on three month starts: flows split evenly, levels repeated.

    Takes wide rows (one column per amount) or long rows (series, value); columns
    or series in neither list are repeated like levels.
    """
    monthly = _months(df, 3, date)
    if {"series", "value"} <= set(df.columns):
        name = F.element_at(F.split("series", r"\."), -1)
        return monthly.withColumn("value", F.when(
            name.isin(list(flows)), F.col("value") / 3).otherwise(F.col("value")))
    split = {c: F.col(f"`{c}`") / 3 for c in flows if c in df.columns}
    return monthly.withColumns(split) if split else monthly


def hold_to_monthly(df: DataFrame, start: str, end: str) -> DataFrame:
    """Releases held on a monthly calendar until the next one, and past the last.

    Months before the first release are NULL. Releases are first reduced to the
    last known one per month, which combines map-side and bounds a series by the
    months on record; each month then writes the months up to the next one, so no
    calendar join and no separate fill is needed.
    """
    first = F.trunc(F.lit(start).cast("date"), "MM")
    last = F.trunc(F.lit(end).cast("date"), "MM")
    value, month = F.col("value"), F.col("month")
    monthly = df.groupBy("series", F.trunc("date", "MM").alias("month")).agg(
        F.max_by(value, F.when(value.isNotNull(), F.col("date"))).alias("value"))
    w = Window.partitionBy("series").orderBy("month")
    known = F.last("value", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0))
    opening = F.lag("month").over(w).isNull()
    until = F.add_months(F.lead("month").over(w), -1)
    spans = monthly.select(
        "series", month.alias("_from"), known.alias("value"),
        F.greatest(F.when(opening, F.least(first, month)).otherwise(month), first)
        .alias("_lo"),
        F.least(F.coalesce(until, F.greatest(last, month)), last).alias("_hi"))
    return (
        spans.filter("_lo <= _hi")
        .withColumn("date", F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))))
        .select("series", "date",
                F.when(F.col("date") >= F.col("_from"), F.col("value")).alias("value"))
    )


def _method(how: str | Mapping[str, str], columns: Sequence[str]) -> Column | str:
    if "how" in columns:
        return F.first("how")
    if isinstance(how, str):
        return how
    table = F.create_map(*(F.lit(x) for pair in how.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.col("series")), F.lit("mean"))


def resample_weekly(df: DataFrame, how: str | Mapping[str, str] = "mean",
                    order: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """(series, week, *by, value) per Monday-closed week.

    ``how`` is sum, mean or last: for all series, per series, or in a column
    ``how`` of the rows. ``last`` is the last known value by ``order``. All
    three combine map-side, so one series may hold most of the rows.
    """
    value = F.col("value")
    pick = {
        "sum": F.sum(value),
        "mean": F.avg(value),
        "last": F.max_by(value, F.when(value.isNotNull(), F.col(order))),
    }
    method = _method(how, df.columns)
    if isinstance(method, str):
        if method not in pick:
            raise ValueError(f"unknown method {method!r}; one of {sorted(pick)}")
        chosen = pick[method]
    else:
        # `how` and the map both depend on the series alone.
        chosen = reduce(lambda c, m: c.when(method == m, pick[m]), ("mean", "last"),
                        F.when(method == "sum", pick["sum"]))
    return (df.groupBy("series", closing_monday("date").alias("week"), *by)
            .agg(chosen.alias("value")))


def _mondays(start: str, end: str) -> tuple[Date, Date]:
    """First and last Monday within the range."""
    lo, hi = Date.fromisoformat(start), Date.fromisoformat(end)
    return (lo + timedelta(days=-lo.weekday() % 7), hi - timedelta(days=hi.weekday()))


def densify_weekly(df: DataFrame, start: str, end: str) -> DataFrame:
    """Every Monday in range for every series; gaps as NULL.

    Each row also writes the empty weeks up to the next row of its series, which
    takes one shuffle by series (shared with the fills that follow) instead of a
    product of series and weeks with a join. Needs one row per series and week.
    """
    lo, hi = (F.lit(d) for d in _mondays(start, end))
    w = Window.partitionBy("series").orderBy("week")
    week, following = F.col("week"), F.lead("week").over(w)
    opening = F.lag("week").over(w).isNull()
    repeated = F.raise_error(F.concat(
        F.lit("two rows of one series in week "), week.cast("string")))
    until = F.when(following == week, repeated.cast("date")).otherwise(
        F.date_sub(following, 7))
    return (
        df.select(
            "series", "week", "value",
            F.greatest(F.when(opening, F.least(lo, week)).otherwise(week), lo).alias("_lo"),
            F.least(F.coalesce(until, F.greatest(hi, week)), hi).alias("_hi"))
        .filter("_lo <= _hi")
        .withColumn("_week", F.explode(F.sequence("_lo", "_hi", F.expr("interval 7 days"))))
        .select("series", F.col("_week").alias("week"),
                F.when(F.col("_week") == week, F.col("value")).alias("value"))
    )


def ffill(df: DataFrame, part: Sequence[str] = ("series",), order: str = "week",
          cols: Iterable[str] = ("value",)) -> DataFrame:
    """Carry the last known value forward within each partition, unbounded."""
    return df.withColumns({c: ffill_column(c, part, order) for c in cols})


def bfill(df: DataFrame, part: Sequence[str] = ("series",), order: str = "week",
          cols: Iterable[str] = ("value",), limit: int = 10) -> DataFrame:
    """Take the next known value, at most ``limit`` rows ahead."""
    return df.withColumns({c: bfill_column(c, part, order, limit) for c in cols})


def pct_change(df: DataFrame, series: str | None = None, order: str = "week",
               out: str = "Target_Return") -> DataFrame:
    """Percent change against the previous row of the series (first is NULL)."""
    if series is not None:
        df = df.filter(F.col("series") == series)
    before = F.lag("value").over(Window.partitionBy("series").orderBy(order))
    return df.withColumn(out, (F.try_divide(F.col("value"), before) - 1) * 100)


def series_names(df: DataFrame, most: int | None = None) -> list[str]:
    """Distinct series, sorted; more than ``most`` can't become columns.

    ``merge_weekly_long`` gives the same values as rows, for any number.
    """
    most = most or MAX_SERIES
    rows = df.select("series").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} series cannot become columns")
    return sorted(r[0] for r in rows)


def merge_weekly_long(sources: Sequence[DataFrame], start: str = PREDICTOR_START,
                      end: str = PREDICTOR_END,
                      how: str | Mapping[str, str] = "mean",
                      bfill_limit: int = 10) -> DataFrame:
    """(series, week, value): union, resample, densify, fill, clip.

    What a series last held before ``start`` is carried into the range, so a
    value known at the start is never overwritten by a later one filled
    backwards. A series that ends before the range is absent, as before.
    """
    rows = reduce(DataFrame.unionByName, sources)
    opens, closes = (F.lit(d).cast("date") for d in (start, end))
    weekly = resample_weekly(
        rows.filter(F.col("date") <= closes).withColumn("_early", F.col("date") < opens), how,
        by=["_early"])
    # Of the weeks before the range one row is left per series, in the week before the
    # first one. The windows are by series, like those of the fills.
    first, early = F.lit(_mondays(start, end)[0]), F.col("_early")
    series = Window.partitionBy("series")
    latest = F.max(F.when(early & F.col("value").isNotNull(), F.col("week"))).over(series)
    known = (weekly.select("*", latest.alias("_last"), F.min("_early").over(series).alias("_gone"))
             .filter(~early | ((F.col("week") == F.col("_last")) & ~F.col("_gone")))
             .select("series", F.when(early, F.date_sub(first, 7)).otherwise(F.col("week"))
                     .alias("week"), "value"))
    before = (Date.fromisoformat(start) - timedelta(days=7)).isoformat()
    filled = ffill(densify_weekly(known, before, end))
    return bfill(filled.filter(F.col("week") >= first), limit=bfill_limit)


def merge_weekly(sources: Sequence[DataFrame], start: str = PREDICTOR_START,
                 end: str = PREDICTOR_END, how: str | Mapping[str, str] = "mean",
                 target: str | None = TARGET_SERIES,
                 names: Sequence[str] | None = None,
                 bfill_limit: int = 10) -> DataFrame:
    """Sources of any frequency as one wide table, one row per Monday.

    Rows are (series, date, value[, how]). ``target`` adds ``Target_Return``,
    the weekly return of the filled target price. Without ``names`` the weekly
    rows are written as a stage that both the list of series and the pivot read;
    series without a row in range are no column then. Seven sources cost one
    union and a few shuffles, all but the first over weekly rows; there is no
    seven-way join.
    """
    filled = merge_weekly_long(sources, start, end, how, bfill_limit)
    if names is None:
        path = stage_path(filled.sparkSession, "weekly")
        filled.write.parquet(path)
        filled = filled.sparkSession.read.parquet(path)
        names = series_names(filled)
    names = list(names)
    row = F.struct("series", "value")
    if target is not None:
        filled = pct_change(filled)
        gain = F.struct(F.lit("Target_Return").alias("series"),
                        F.col("Target_Return").alias("value"))
        filled = filled.select("week", F.inline(F.when(
            F.col("series") == target, F.array(row, gain)).otherwise(F.array(row))))
        names.append("Target_Return")
    return (filled.groupBy(F.col("week").alias("Date")).pivot("series", names)
            .agg(F.max("value")))
