"""Axes as tables, for inputs with more coordinates than the driver should hold.

Stations, model points and very fine grids can have millions of distinct
latitudes. Their positions are numbered by ranges (``number_rows``) and looked up
by a join, so that no axis passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.operators.numbering import number_rows


@dataclass(frozen=True)
class AxisTables:
    """``(lat_i, lat)`` and ``(lon_i, lon)``: sorted distinct values and their places."""

    lats: DataFrame
    lons: DataFrame


def _numbered(values: DataFrame, axis: str) -> DataFrame:
    return number_rows(values.select(axis), axis, name="_place").select(
        F.col("_place").cast("int").alias(f"{axis}_i"), axis)


def common_axes(grids: Sequence[DataFrame], lat: str = "latitude", lon: str = "longitude"
                ) -> AxisTables:
    """Axes of inputs that lie on the same places.

    Values are equal or different; nothing is rounded here. Inputs with
    different values on an axis would have to be regridded, which needs axes
    that the driver can hold, so they are an error.
    """
    every, tables = (1 << len(grids)) - 1, []
    for axis, column in (("lat", lat), ("lon", lon)):
        seen = reduce(DataFrame.unionByName, (
            g.select(F.col(column).cast("double").alias(axis), F.lit(1 << k).alias("_input"))
            for k, g in enumerate(grids))).where(F.col(axis).isNotNull())
        values = seen.groupBy(axis).agg(F.bit_or("_input").alias("_inputs"))
        # Raised inside the value that is numbered, so that it costs no pass.
        same = F.when(F.col("_inputs") == every, F.col(axis)).otherwise(F.raise_error(F.concat(
            F.lit(f"not all inputs have {column} "), F.col(axis).cast("string"),
            F.lit("; their axes are too long to be regridded"))).cast("double"))
        tables.append(_numbered(values.select(same.alias(axis)), axis))
    return AxisTables(*tables)


def place_cells(df: DataFrame, axes: AxisTables, lat: str = "latitude",
                lon: str = "longitude") -> DataFrame:
    """``index_cells`` by a lookup: adds ``lat_i``/``lon_i`` and calls the axes lat, lon.

    The axis tables have one row per value; a latitude with very many rows makes
    a skewed partition of the input's side only, which adaptive execution splits.
    """
    rest = [c for c in df.columns if c not in (lat, lon)]
    placed = df.select(*(F.col(f"`{c}`") for c in rest), F.col(lat).cast("double").alias("lat"),
                       F.col(lon).cast("double").alias("lon"))
    return placed.join(axes.lats, "lat").join(axes.lons, "lon").select(
        *(F.col(f"`{c}`") for c in rest), "lat_i", "lon_i", "lat", "lon")
