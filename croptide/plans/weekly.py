"""Climate belts and market series to the weekly predictor table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.constants import (
    BELT_STATES,
    COMMODITY_PRICES,
    FARM_PRICE,
    INDEX_NAMES,
    MARKET_SERIES,
    PREDICTOR_END,
    PREDICTOR_START,
    TARGET_SERIES,
)
from croptide.operators.series import disaggregate_quarterly, expand_annual, merge_weekly
from croptide.operators.spatial import belt_aggregate
from croptide.sinks import replace_table
from croptide.sources import read_series

BELT_STATS = ("Belt_Mean", "Belt_Std", "Belt_Min", "Belt_Max")
# Both supply tables name their production alike; the quarterly one is merged.
ANNUAL_PRODUCTION = "annual_supply.US_Production_M_Bu"


def predictor_methods() -> dict[str, str]:
    """Weekly method per series; whatever is not listed is averaged."""
    how = {f"{v}_{s}": "sum" if v == "GDD" else "mean"
           for v in INDEX_NAMES for s in BELT_STATS}
    prices = (FARM_PRICE, "US_Farm_Price_USD_Bu", *COMMODITY_PRICES, *MARKET_SERIES)
    return how | dict.fromkeys(prices, "last")


def belt_series(belt: DataFrame) -> DataFrame:
    """Belt statistics as (series, date, value), e.g. ``GDD_Belt_Mean``."""
    return (belt.unpivot(["date", "variable"], list(BELT_STATS), "stat", "value")
            .select(F.concat_ws("_", "variable", "stat").alias("series"), "date", "value")
            .filter(F.col("value").isNotNull()))


def regions_of_features(wide: DataFrame, regions: Sequence[str] = BELT_STATES,
                        date: str = "Date") -> DataFrame:
    """Wide ``{variable}_{abbr}`` features as (date, region_abbr, variables…).

    Regions without any column are absent, variables without one are NULL.
    """
    def value(v: str, a: str):
        name = f"{v}_{a}"
        known = F.col(f"`{name}`") if name in wide.columns else F.lit(None)
        return known.cast("double").alias(v)

    variables = [v for v in INDEX_NAMES if any(f"{v}_{a}" in wide.columns for a in regions)]
    held = [a for a in regions if any(f"{v}_{a}" in wide.columns for v in variables)]
    if not held:
        raise ValueError(f"no feature columns of the regions {list(regions)}")
    rows = F.array(*(F.struct(F.lit(a).alias("region_abbr"), *(value(v, a) for v in variables))
                     for a in held))
    return wide.select(F.to_date(F.col(f"`{date}`")).alias("date"), F.inline(rows))


def published_series(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One published table as (series, date, value), at monthly or finer dates.

    Annual amounts are repeated on the months of their year, quarterly ones split
    or repeated; everything else keeps its dates and is held by the merge.
    """
    rows = read_series(spark, path, kind, qualify=True).filter(F.col("date").isNotNull())
    if kind == "annual_supply":
        return expand_annual(rows)
    if kind == "quarterly_supply":
        return disaggregate_quarterly(rows)
    return rows


def predictor_run(spark: SparkSession, features_path: str, tables: Mapping[str, str],
                  output_path: str, regions: Sequence[str] = BELT_STATES,
                  start: str = PREDICTOR_START, end: str = PREDICTOR_END,
                  target: str | None = TARGET_SERIES, csv_path: str | None = None) -> str:
    """Regional features and published tables to the stored weekly predictor table.

    ``features_path`` is a table of ``process_regions_daily``; ``tables`` maps
    kinds of ``read_series`` to paths. Writes one row per Monday (``Date``) as
    Parquet, an existing table is replaced once the new one is complete, and
    returns the path. ``csv_path`` gets the same rows as one CSV file with a header,
    in order.
    """
    belt = belt_aggregate(
        regions_of_features(spark.read.parquet(features_path), regions), regions)
    sources = [belt_series(belt)] + [published_series(spark, p, k) for k, p in tables.items()]
    merged = weekly_predictors(sources, start, end, target)
    replace_table(spark, output_path, merged.write.parquet)
    if csv_path:
        # One row per Monday: the calendar bounds it.
        stored = spark.read.parquet(output_path).orderBy("Date").coalesce(1)
        replace_table(spark, csv_path, stored.write.option("header", True).csv)
    return output_path


def weekly_predictors(sources: Sequence[DataFrame], start: str = PREDICTOR_START,
                      end: str = PREDICTOR_END, target: str | None = TARGET_SERIES,
                      names: Sequence[str] | None = None) -> DataFrame:
    """One row per Monday over belts, supply, prices, macro, risk and market.

    Sources are (series, date, value) rows, as ``read_series`` and
    ``belt_series`` give them. Qualified names lose their prefix here.
    """
    plain = [s.filter(F.col("series") != ANNUAL_PRODUCTION)
             .select(F.regexp_replace("series", r"^[a-z_]+\.", "").alias("series"),
                     F.col("date").cast("date").alias("date"), "value")
             for s in sources]
    return merge_weekly(plain, start, end, predictor_methods(), target, names)
