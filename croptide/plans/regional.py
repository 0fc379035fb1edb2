"""Index store to a wide daily table per region."""

from __future__ import annotations

import logging
import traceback
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.constants import CELL, CUBE_COORDS
from croptide.operators.align import cells_of, index_cells
from croptide.operators.axes import common_axes
from croptide.operators.normalize import (
    find_time,
    intervals_to_seconds,
    needs_wrap,
    normalize_coords,
    to_utc_date,
    wrap_longitude,
)
from croptide.operators.profile import AxisTooLarge, GridAxes, grid_axes
from croptide.operators.spatial import (
    MASK_PIN_ROWS,
    grid_cells,
    label_regions,
    pivot_regions,
    region_labels,
    region_mask,
    regional_aggregate,
)
from croptide.session import pin_small
from croptide.sinks import write_features
from croptide.sources import read_index_store, read_regions

log = logging.getLogger(__name__)


def _placed(df: DataFrame, max_axis: int | None) -> tuple[DataFrame, DataFrame]:
    """The store with wrapped longitudes and positions, and all its cells."""
    try:
        axes = grid_axes(df, max_axis=max_axis)
    except AxisTooLarge:
        df = wrap_longitude(df)
        placed = index_cells(df, common_axes([df]))
        return placed, grid_cells(placed)
    bounds = (axes.lons[0], axes.lons[-1]) if axes.lons else (None, None)
    if needs_wrap(*bounds):
        df = wrap_longitude(df, bounds=bounds)
        # 0 and 360 are one meridian; rows of both belong to its cells.
        axes = GridAxes(axes.lats, tuple(sorted(
            {(x + 180.0) % 360.0 - 180.0 for x in axes.lons})))
    return index_cells(df, axes), cells_of(df.sparkSession, axes)


def regional_features(df: DataFrame, regions: DataFrame, method: str = "mean",
                      key_regions: Sequence[str] | None = None,
                      interval_roots: Sequence[str] | None = None,
                      time_col: str = "time", max_axis: int | None = None) -> DataFrame:
    """Wide daily features ``{variable}_{abbr}`` with a UTC ``Date``.

    The store is read once for its axes and once for its values; everything
    after the regional aggregate has one row per day and region. The names of the
    columns come from the mask, so nothing has to run to learn them. A store with
    more than ``max_axis`` values on an axis keeps its axes as tables.
    """
    time = find_time(df.columns, time_col, ("time", "day", "date"))
    df = normalize_coords(df.drop(*CELL, "year"), "substring")
    df, cells = _placed(df, max_axis)
    variables = [c for c in df.columns if c not in {*CUBE_COORDS, time}]
    # Intervals are numbers from here on, as no reducer but first/last takes them.
    if interval_roots:
        renamed = df.withColumnsRenamed({v: f"{v}_" for v in interval_roots if v in variables})
        df = intervals_to_seconds(renamed, interval_roots).withColumnsRenamed(
            {f"{v}_": v for v in interval_roots})
    mask = pin_small(region_mask(cells, regions), MASK_PIN_ROWS)
    rows = label_regions(
        regional_aggregate(df, mask, method, variables, date=time), regions)
    abbrs = region_labels(label_regions(mask.select("region").distinct(), regions))
    if key_regions:
        abbrs = [a for a in abbrs if a in set(key_regions)]
        if not abbrs:
            log.warning("no data for the key regions %s", list(key_regions))
    return to_utc_date(pivot_regions(rows, variables, abbrs, date=time), time)


def process_regions_daily(spark: SparkSession, store_path: str, regions_path: str,
                          output_dir: str, output_base: str, time_col: str = "time",
                          method: str = "mean",
                          key_regions: Sequence[str] | None = None,
                          interval_roots: Sequence[str] | None = None,
                          save_parquet: bool = True, save_csv: bool = False,
                          max_axis: int | None = None) -> dict:
    """The whole job; a failure becomes a status instead of an exception."""
    try:
        wide = regional_features(
            read_index_store(spark, store_path, time_col),
            read_regions(spark, regions_path), method, key_regions, interval_roots,
            time_col, max_axis)
        return write_features(wide, output_dir, output_base, save_parquet, save_csv, "Date")
    except Exception as e:
        log.error("regional job failed: %s", e)
        return {"status": "error", "message": f"regional job failed: {e}",
                "output_parquet_path": None, "output_csv_path": None,
                "error_details": traceback.format_exc()}
