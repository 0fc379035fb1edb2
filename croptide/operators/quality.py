"""Input diagnostics and output verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.constants import CUBE_COORDS, INDEX_NAMES
from croptide.operators.normalize import find_coords, find_time
from croptide.operators.profile import GridProfile, profile_grids, profile_points
from croptide.session import local_table

REPORT = "dataset string, check string, severity string, detail string"


def coordinate_columns(df: DataFrame, expected_time: str = "valid_time"
                       ) -> tuple[str | None, str | None, str | None]:
    """The (time, lat, lon) columns of an input, None where there is none."""
    try:
        time = find_time(df.columns, expected_time)
    except ValueError:
        time = None
    found = find_coords(df.columns)
    return time, found["latitude"], found["longitude"]


def diagnose(spark: SparkSession, inputs: Mapping[str, DataFrame | None],
             expected_time: str = "valid_time",
             profiles: Mapping[str, GridProfile] | None = None) -> DataFrame:
    """(dataset, check, severity, detail) over all inputs.

    Severity is info, warning or critical; each finding is its own row. Units are
    those in a column's metadata (``{"units": "K"}``). A missing
    input is critical and ends the report, as nothing after it can run. All facts
    come from one pass over the coordinates of all inputs, or from ``profiles``.
    """
    absent = [name for name, df in inputs.items() if df is None]
    if absent:
        return local_table(spark, [(n, "input", "critical", "missing") for n in absent],
                           REPORT)
    columns = {n: coordinate_columns(df, expected_time) for n, df in inputs.items()}
    profiles = profiles or profile_grids(inputs, columns)

    report, kinds, reference = [], {}, None
    for name, df in inputs.items():
        (time, lat, lon), seen = columns[name], profiles[name]
        report.append((name, "rows", "info" if seen.rows else "warning", str(seen.rows)))
        if time is None:
            report.append((name, "time", "critical", "no time column"))
        else:
            kinds[name] = df.schema[time].dataType.simpleString()
            report.append((name, "time", "info" if time == expected_time else "warning",
                           time))
            if seen.days:
                report.append((name, "range", "info", f"{seen.days[0]} .. {seen.days[-1]}"))
            if seen.missing_times:
                report.append((name, "missing_time", "critical", str(seen.missing_times)))
        for c in df.columns:
            if c not in columns[name] and c not in CUBE_COORDS:
                units = df.schema[c].metadata.get("units")
                report.append((name, "units", "info" if units else "warning",
                               f"{c}: {units or 'not stated'}"))
        if seen.missing_places:
            report.append((name, "missing_place", "critical", str(seen.missing_places)))
        if lat is None or lon is None:
            report.append((name, "grid", "warning", "no latitude/longitude columns"))
            continue
        grid = (*seen.size, lat, lon)
        reference = reference or grid
        report.append((name, "grid", "info" if grid == reference else "warning",
                       f"{grid[0]} x {grid[1]} ({lat}, {lon})"))
    # All dates are proleptic Gregorian here; what can differ is the time type.
    if len(set(kinds.values())) > 1:
        for name, kind in kinds.items():
            report.append((name, "calendar", "warning", kind))
    return local_table(spark, report, REPORT)


def has_critical(report: DataFrame) -> bool:
    return not report.filter("severity = 'critical'").isEmpty()


def store_shape(df: DataFrame, date: str = "date", lat: str = "lat_i", lon: str = "lon_i"
                ) -> tuple[int, int, int]:
    """Numbers of days, latitudes and longitudes of a store, by counted axes."""
    found = profile_points({"store": df}, {"store": (date, lat, lon)})["store"]
    return len(found.days), *found.size


def verify_store(df: DataFrame, expected: Sequence[str] = INDEX_NAMES,
                 shape: bool = False) -> DataFrame:
    """One row per expected or present variable: type, counts, range, a sample.

    All variables are reduced in one pass; the sample is the value of the first
    cell on the first day. ``shape`` adds days, latitudes and longitudes of the
    store (null for a variable that is not there) and how many of their products
    have no row at all, at the price of a pass over the coordinates.
    """
    coords = {*CUBE_COORDS, "year"}
    present = [c for c in df.columns if c not in coords]
    at = F.struct(*(c for c in ("date", "lat_i", "lon_i") if c in df.columns))
    number = "double"

    def facts(c: str):
        if c not in present:
            return F.struct(
                F.lit(c).alias("variable"), F.lit(False).alias("present"),
                F.lit(None).cast("string").alias("data_type"),
                F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_null"),
                *(F.lit(None).cast(number).alias(a) for a in ("min", "max", "sample")))
        x = F.col(f"`{c}`")
        return F.struct(
            F.lit(c).alias("variable"), F.lit(True).alias("present"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.count(x).alias("n"), F.count_if(x.isNull()).alias("n_null"),
            F.min(x).cast(number).alias("min"), F.max(x).cast(number).alias("max"),
            F.min_by(x, at).cast(number).alias("sample"))

    names = list(dict.fromkeys([*expected, *present]))
    report = df.agg(F.array(*(facts(c) for c in names)).alias("v")).select(F.inline("v"))
    if not shape:
        return report
    sides = store_shape(df)
    here = F.col("present")
    return report.select(
        "*", *(F.when(here, F.lit(n).cast("long")).alias(c)
               for c, n in zip(("days", "lats", "lons"), sides, strict=True)),
        F.when(here, F.lit(prod(sides)) - F.col("n") - F.col("n_null")).alias("n_absent"))
