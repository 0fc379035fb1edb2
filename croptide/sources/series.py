"""Periodic market and economy tables as (series, date, value) rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.constants import (
    ANNUAL_SUPPLY,
    COMMODITY_PRICES,
    FARM_PRICE,
    MACRO_SERIES,
    MARKET_SERIES,
    RISK_SERIES,
    SUPPLY_FLOWS,
    SUPPLY_LEVELS,
)
from croptide.functions.climate import null_if_nan


def _iso(name: str) -> Column:
    return F.try_to_date(F.col(f"`{name}`"), "yyyy-MM-dd")


def _year_start(name: str) -> Column:
    """1 June of the year a ``2009/10`` label starts in."""
    year = F.when(F.col(f"`{name}`").rlike(r"^\s*\d{4}\b"),
                  F.substring(F.trim(F.col(f"`{name}`")), 1, 4))
    return F.make_date(year.cast("int"), F.lit(6), F.lit(1))


def _quarter_start(year: str, period: str) -> Column:
    """First month of ``Q1 Jun-Aug`` … ``Q4 Mar-May`` in a marketing year."""
    quarter = F.when(F.col(f"`{period}`").rlike(r"^Q[1-4]"),
                     F.substring(F.col(f"`{period}`"), 2, 1)).cast("int")
    return F.add_months(_year_start(year), (quarter - 1) * 3)


@dataclass(frozen=True)
class SeriesKind:
    """How one table shape names its date and its values."""

    dates: tuple[str, ...]  # accepted date headers, first present wins
    values: tuple[str, ...]
    calendar: str = "iso"  # iso | marketing_year | marketing_quarter


# The headers of the published tables. ``_c0`` is what Spark calls
# a column whose header is empty.
SERIES_KINDS = {
    "farm_price": SeriesKind(("Date",), (FARM_PRICE,)),
    "annual_supply": SeriesKind(("Marketing year 1", "Marketing_Year"),
                                ANNUAL_SUPPLY, "marketing_year"),
    "annual_supply_monthly": SeriesKind(("Date",), ANNUAL_SUPPLY),
    "quarterly_supply": SeriesKind(("Marketing_Year",),
                                   SUPPLY_FLOWS + SUPPLY_LEVELS,
                                   "marketing_quarter"),
    "quarterly_supply_monthly": SeriesKind(("Date",), SUPPLY_FLOWS + SUPPLY_LEVELS),
    "commodity": SeriesKind(("Date",), COMMODITY_PRICES),
    "macro": SeriesKind(("_c0", "DATE", "Date"), MACRO_SERIES),
    "risk": SeriesKind(("date", "Date"), RISK_SERIES),
    "market": SeriesKind(("Date",), MARKET_SERIES),
}


def read_series(spark: SparkSession, path: str, kind: str,
                qualify: bool = False) -> DataFrame:
    """One published table in long form.

    Columns are taken by name and read as text, so no inference pass runs and a
    bad number, NaN or a bad date label becomes NULL. ``qualify`` prefixes series with the kind, which
    keeps the two production columns of the supply tables apart.
    """
    if kind not in SERIES_KINDS:
        raise ValueError(f"unknown series kind {kind!r}; one of {sorted(SERIES_KINDS)}")
    shape = SERIES_KINDS[kind]
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    label = next((c for c in shape.dates if c in raw.columns), None)
    values = [c for c in shape.values if c in raw.columns]
    if label is None or not values:
        raise ValueError(f"{path} does not look like a {kind} table: {raw.columns}")
    date = {
        "iso": lambda: _iso(label),
        "marketing_year": lambda: _year_start(label),
        "marketing_quarter": lambda: _quarter_start(label, "Time_Period"),
    }[shape.calendar]()
    prefix = f"{kind}." if qualify else ""
    wide = raw.select(date.alias("date"), *(
        null_if_nan(F.col(f"`{c}`").try_cast("double")).alias(prefix + c) for c in values))
    return wide.unpivot(["date"], [F.col(f"`{prefix}{c}`") for c in values],
                        "series", "value").select("series", "date", "value")
