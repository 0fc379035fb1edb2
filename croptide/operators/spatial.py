"""Cells to regions: mask, reduce, label, pivot, belt."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croptide.constants import (
    BELT_MAX_INDICES,
    BELT_MIN_INDICES,
    BELT_STATES,
    CELL,
    INDEX_NAMES,
)
from croptide.session import pin_small, pin_within, stage_path

MAX_REGIONS = 10_000
# A mask of up to this many runs (16 bytes each) is pinned; a larger one is joined.
MASK_PIN_ROWS = 1_000_000
# Longitude positions per tile of a mask that is joined.
TILE = 64


def grid_cells(df: DataFrame) -> DataFrame:
    """The distinct cells of a cube."""
    return df.select("lat_i", "lon_i", "lat", "lon").distinct()


def region_mask(cells: DataFrame, regions: DataFrame, band: float = 1.0) -> DataFrame:
    """(lat_i, lon_i, region) for the cells whose centre lies in a region.

    A scan-line join instead of testing every cell against every polygon: ring
    edges meet the latitude rows they cross (an equi-join on latitude bands of
    ``band`` degrees), consecutive crossings of a row bound the inside spans,
    and cells meet the spans of their own row. Even-odd counting makes parts and
    holes of a region work alike; edges are half-open; where regions overlap the
    lowest number wins. Cells in no region are absent.
    """
    n = F.size("ring")
    edges = (
        regions.filter(n >= 3)
        .select("region", F.explode(F.transform(
            F.sequence(F.lit(1), n),
            lambda k: F.struct(
                F.element_at("ring", k).alias("a"),
                F.element_at("ring", F.pmod(k, n) + 1).alias("b")))).alias("e"))
        .select("region", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"),
                F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))
        .filter("y1 <> y2")
        .withColumns({"lo": F.least("y1", "y2"), "hi": F.greatest("y1", "y2")})
    )

    def band_of(c: str) -> Column:
        return F.floor(F.col(c) / F.lit(float(band)))

    banded = edges.withColumn("band", F.explode(F.sequence(band_of("lo"), band_of("hi"))))
    # The latitude axis is the small side here, whatever the outlines weigh.
    rows = pin_small(cells.select("lat_i", "lat").distinct()
                     .withColumn("band", band_of("lat")))
    crossings = (
        banded.join(rows, "band")
        .filter("lat >= lo AND lat < hi")
        .select("lat_i", "region", (
            F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1"))
            / (F.col("y2") - F.col("y1"))).alias("x"))
    )
    along = Window.partitionBy("lat_i", "region").orderBy("x")
    spans = (
        crossings
        .select("lat_i", "region", F.col("x").alias("west"),
                F.lead("x").over(along).alias("east"),
                F.row_number().over(along).alias("nth"))
        .filter("nth % 2 = 1 AND west < east")
    )
    c, s = cells.alias("c"), spans.alias("s")
    inside = ((F.col("c.lat_i") == F.col("s.lat_i"))
              & (F.col("c.lon") >= F.col("s.west")) & (F.col("c.lon") < F.col("s.east")))
    return (c.join(s, inside).groupBy("c.lat_i", "c.lon_i")
            .agg(F.min("region").alias("region")))


def _stable_order(cell: Sequence[str]) -> Column:
    """Row-major position of a cell as one number (keeps hash aggregation)."""
    lat_i, lon_i = (F.col(c).cast("long") for c in cell)
    return F.shiftleft(lat_i, 32) + lon_i


def _reducer(method: str, cell: Sequence[str]):
    position = _stable_order(cell)

    def known(c: Column) -> Column:
        return F.when(c.isNotNull(), position)

    methods = {
        "mean": F.avg,
        "max": F.max,
        "min": F.min,
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
        "std": F.stddev_pop,
        "var": F.var_pop,
        "first": lambda c: F.min_by(c, known(c)),
        "last": lambda c: F.max_by(c, known(c)),
    }
    if method not in methods:
        raise ValueError(
            f"unknown method {method!r}; one of {sorted([*methods, 'median'])}")
    return methods[method]


def mask_runs(mask: DataFrame) -> DataFrame:
    """A mask as (lat_i, region, first, last): runs of consecutive ``lon_i``."""
    along = Window.partitionBy("lat_i", "region").orderBy("lon_i")
    return (mask.select(*CELL, "region").distinct()
            .withColumn("_run", F.col("lon_i") - F.row_number().over(along))
            .groupBy("lat_i", "region", "_run")
            .agg(F.min("lon_i").alias("first"), F.max("lon_i").alias("last")).drop("_run"))


def _in_regions(cells: DataFrame, runs: DataFrame) -> DataFrame:
    """The rows of ``cells`` with each region that a run of theirs lies in.

    Runs that are too many to be pinned are cut at multiples of ``TILE``, so that
    the join has as many keys as rows of the grid times tiles, not rows alone.
    """
    pinned = pin_within(runs, MASK_PIN_ROWS)
    if pinned is None:
        first, last = (F.floor(F.col(c) / TILE) for c in ("first", "last"))
        start = F.col("tile") * TILE
        runs = runs.withColumn("tile", F.explode(F.sequence(first, last))).select(
            "lat_i", "tile", "region", F.greatest("first", start).alias("first"),
            F.least("last", start + TILE - 1).alias("last")).hint("merge")
    c, m = cells.alias("c"), (runs if pinned is None else pinned).alias("m")
    inside = (F.col("c.lat_i") == F.col("m.lat_i")) & F.col("c.lon_i").between(
        F.col("m.first"), F.col("m.last"))
    if pinned is None:
        inside &= F.floor(F.col("c.lon_i") / TILE) == F.col("m.tile")
    return c.join(m, inside).select("c.*", "m.region")


def regional_aggregate(df: DataFrame, mask: DataFrame, method: str = "mean",
                       variables: Iterable[str] = INDEX_NAMES,
                       date: str = "date") -> DataFrame:
    """(date, region, variables…): unweighted, missing values skipped.

    The mask becomes runs of neighbouring cells, far fewer than cells, which are
    pinned when a count shows them to be few enough; so a finer grid does not
    shuffle the cube; beyond that both are dealt by row and tile of longitudes. The
    groups combine map-side, so a region that holds most
    cells shuffles one row per day and task. That holds for the exact median too,
    which counts equal values first.
    """
    names = [v for v in variables if v in df.columns]
    inside = _in_regions(df.select(date, *CELL, *names), mask_runs(mask))
    if method == "median":
        return _regional_median(inside, names, date)
    reduce_ = _reducer(method, CELL)
    return inside.groupBy(date, "region").agg(
        *(reduce_(F.col(v)).cast("double").alias(v) for v in names))


def _regional_median(inside: DataFrame, names: Sequence[str], date: str) -> DataFrame:
    """Exact medians without a buffer of all cells of a region and day.

    Equal values are counted map-side; a running count over the distinct values,
    in order, finds the middle one or two. A window streams its rows, so no group
    has to fit in memory.
    """
    if not names:
        return inside.select(date, "region").distinct()
    values = F.array(*(F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("x"))
                       for v in names))
    counted = (inside.select(date, "region", F.inline(values))
               .groupBy(date, "region", "variable", "x").agg(F.count(F.lit(1)).alias("n")))
    group = Window.partitionBy(date, "region", "variable")
    known = F.when(F.col("x").isNotNull(), F.col("n")).otherwise(0)
    upto = F.sum(known).over(group.orderBy(F.col("x").asc_nulls_first())
                             .rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.select("*", upto.alias("upto"), F.sum(known).over(group).alias("total"))
    lower = F.floor((F.col("total") + 1) / 2)
    upper = F.floor(F.col("total") / 2) + 1

    def at(place):
        held = (F.col("upto") - F.col("n") < place) & (F.col("upto") >= place)
        return F.max(F.when(F.col("x").isNotNull() & held, F.col("x")))

    middle = placed.groupBy(date, "region", "variable").agg(
        ((at(lower) + at(upper)) / 2).alias("median"))
    return middle.groupBy(date, "region").agg(
        *(F.max(F.when(F.col("variable") == v, F.col("median"))).alias(v) for v in names))


def label_regions(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Add ``region_abbr``; numbers without a name become ``Unk_{number}``."""
    names = pin_small(regions.groupBy("region")
                      .agg(F.min("region_abbr").alias("region_abbr")), MAX_REGIONS)
    return (df.join(names, "region", "left")
            .withColumn("region_abbr", F.coalesce(
                "region_abbr", F.concat(F.lit("Unk_"), F.col("region").cast("string")))))


def select_regions(df: DataFrame, abbrs: Iterable[str] | None) -> DataFrame:
    """Keep the named regions; an empty or absent list keeps all."""
    abbrs = list(abbrs or ())
    return df.filter(F.col("region_abbr").isin(abbrs)) if abbrs else df


def region_labels(df: DataFrame, most: int | None = None) -> list[str]:
    """The distinct labels, sorted; more than ``most`` can't become columns.

    ``regional_aggregate`` with ``label_regions`` gives the same values as rows,
    for any number.
    """
    most = most or MAX_REGIONS
    rows = df.select("region_abbr").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} regions cannot become columns")
    return sorted(r[0] for r in rows)


def pivot_regions(df: DataFrame, variables: Iterable[str] = INDEX_NAMES,
                  abbrs: Sequence[str] | None = None, date: str = "date") -> DataFrame:
    """One row per day with columns ``{variable}_{abbr}``.

    With a list of regions no extra pass is needed; without one the rows, one per
    day and region, are written as a stage that both the list and the pivot read.
    Rows of other regions still hold their day in place, so a list that matches
    nothing leaves the days without values, and an empty list leaves the days
    alone.
    """
    names = [v for v in variables if v in df.columns]
    if abbrs is None:
        path = stage_path(df.sparkSession, "regional")
        df.select(date, "region_abbr", *names).write.parquet(path)
        df = df.sparkSession.read.parquet(path)
        abbrs = region_labels(df)
    if not abbrs or not names:
        return df.select(date).distinct()
    # Spark names pivoted columns {abbr}_{variable}, or {abbr} for one variable.
    wide = (df.groupBy(date).pivot("region_abbr", list(abbrs))
            .agg(*(F.max(v).alias(v) for v in names)))
    return wide.select(date, *(
        F.col(f"`{a}`" if len(names) == 1 else f"`{a}_{v}`").alias(f"{v}_{a}")
        for v in names for a in abbrs))


def belt_aggregate(df: DataFrame, regions: Sequence[str] = BELT_STATES,
                   variables: Iterable[str] = INDEX_NAMES,
                   date: str = "date") -> DataFrame:
    """(date, variable, Belt_Mean, Belt_Std, Belt_Min, Belt_Max) over a set of regions.

    Deviation is the sample one (NULL for a single region). Minimum is kept for
    SPI and soil moisture, maximum for heatwave and GDD, as NULL elsewhere.
    """
    names = [v for v in variables if v in df.columns]
    none = F.lit(None).cast("double")
    belts = [F.struct(
        F.lit(v).alias("variable"),
        F.avg(v).alias("Belt_Mean"),
        F.stddev_samp(v).alias("Belt_Std"),
        (F.min(v) if v in BELT_MIN_INDICES else none).cast("double").alias("Belt_Min"),
        (F.max(v) if v in BELT_MAX_INDICES else none).cast("double").alias("Belt_Max"),
    ) for v in names]
    return (select_regions(df, regions).groupBy(date)
            .agg(F.array(*belts).alias("belt"))
            .select(date, F.inline("belt")))
