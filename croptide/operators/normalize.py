"""Names, time axes and units: from any weather grid to the engine's columns."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croptide.constants import CUBE_COORDS, VARIABLE_ALIASES
from croptide.functions.climate import null_if_nan

COORD_COLUMNS = ("latitude", "longitude")
_EXACT = {"latitude": ("lat", "latitude"), "longitude": ("lon", "longitude")}
_SUBSTRING = {"latitude": ("lat",), "longitude": ("lon", "long")}


def find_time(columns: Sequence[str], expected: str,
              hints: Iterable[str] = ("time",)) -> str:
    """The expected name if present, else the first name holding a hint."""
    if expected in columns:
        return expected
    hints = tuple(hints)
    for c in columns:
        if any(h in c.lower() for h in hints):
            return c
    raise ValueError(f"no time column among {list(columns)}")


def normalize_time(df: DataFrame, expected: str = "valid_time",
                   hints: Iterable[str] = ("time",)) -> DataFrame:
    """Rename the time column to ``expected``."""
    found = find_time(df.columns, expected, hints)
    return df if found == expected else df.withColumnRenamed(found, expected)


def find_coords(columns: Sequence[str], mode: str = "exact") -> dict[str, str | None]:
    """Which columns hold latitude and longitude (None when absent)."""
    if mode == "exact":
        return {want: next((c for c in columns if c.lower() in names), None)
                for want, names in _EXACT.items()}
    if mode == "substring":
        return {want: want if want in columns else
                next((c for c in columns if any(h in c.lower() for h in hints)), None)
                for want, hints in _SUBSTRING.items()}
    raise ValueError(f"mode must be 'exact' or 'substring', not {mode!r}")


def normalize_coords(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Rename the spatial columns to ``latitude`` and ``longitude``.

    ``exact`` accepts lat/latitude and lon/longitude in any case; ``substring``
    takes the first column whose name contains lat, lon or long.
    """
    found = find_coords(df.columns, mode)
    missing = [want for want, have in found.items() if have is None]
    if missing:
        raise ValueError(f"no {' or '.join(missing)} column among {df.columns}")
    for want, have in found.items():
        if have != want:
            df = df.withColumnRenamed(have, want)
    return df


def pick_variable(df: DataFrame, key: str,
                  coords: Sequence[str] = ("valid_time", *COORD_COLUMNS)) -> DataFrame:
    """Coordinates plus the one data column that stands for ``key``."""
    known = set(coords) | set(CUBE_COORDS) | {"year"}
    data = [c for c in df.columns if c not in known]
    if not data:
        raise ValueError(f"no data column for {key!r} among {df.columns}")
    name = next((a for a in VARIABLE_ALIASES.get(key, (key,)) if a in data), None)
    if name is None:
        name = data[0]
        warnings.warn(f"no known column for {key!r}; using {name!r}", stacklevel=2)
    return df.select(*(c for c in coords if c in df.columns),
                     F.col(f"`{name}`").alias(key))


def validate_time(df: DataFrame, time: str = "valid_time") -> DataFrame:
    """Raise when a timestamp is missing.

    Rows need no sorting here: windows order their own partitions and sinks sort
    what they write. The check reads one column and stops at the first NULL.
    """
    if df.filter(F.col(time).isNull()).select(time).limit(1).count():
        raise ValueError(f"missing timestamps in {time!r}")
    return df


def needs_wrap(low: float | None, high: float | None) -> bool:
    return low is not None and low >= 0 and high > 180


def wrap_longitude(df: DataFrame, lon: str = "longitude",
                   bounds: tuple[float | None, float | None] | None = None) -> DataFrame:
    """0…360 longitudes to −180…180 (180 itself becomes −180).

    Grids already in range are returned unchanged. The range is taken from
    ``bounds`` or from one min/max aggregate over the longitude column alone.
    """
    low, high = bounds or df.agg(F.min(lon), F.max(lon)).first()
    if not needs_wrap(low, high):
        return df
    return df.withColumn(lon, F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0)


def to_utc_date(df: DataFrame, column: str, tz: str | None = None,
                name: str = "Date") -> DataFrame:
    """A UTC instant named ``Date``.

    Zone-less values are taken as UTC, or as local time in ``tz``; values that
    already are instants keep their moment. The session zone plays no part.
    """
    c = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        instant = c
    else:
        wall = c if isinstance(kind, T.TimestampNTZType) else c.cast("timestamp_ntz")
        second = F.expr(f"extract(SECOND FROM CAST(`{column}` AS TIMESTAMP_NTZ))")
        instant = F.make_timestamp_ltz(
            F.year(wall), F.month(wall), F.dayofmonth(wall), F.hour(wall),
            F.minute(wall), second, F.lit(tz or "UTC"))
    return df.withColumn(column, instant).withColumnRenamed(column, name)


def intervals_to_seconds(df: DataFrame, roots: Sequence[str]) -> DataFrame:
    """Columns named ``{root}_…``: intervals to seconds, text to numbers.

    Numeric columns stay as they are, text that is no number (NaN too) becomes NULL, and a
    root without columns is skipped.
    """
    prefixes = tuple(f"{r}_" for r in roots)
    changed = {}
    for field in df.schema.fields:
        if not prefixes or not field.name.startswith(prefixes):
            continue
        if isinstance(field.dataType, T.DayTimeIntervalType):
            changed[field.name] = F.expr(
                f"CAST(CAST(CAST(`{field.name}` AS INTERVAL SECOND) "
                "AS DECIMAL(20, 6)) AS DOUBLE)")
        elif not isinstance(field.dataType, T.NumericType):
            changed[field.name] = null_if_nan(F.col(f"`{field.name}`").try_cast("double"))
    return df.withColumns(changed) if changed else df
