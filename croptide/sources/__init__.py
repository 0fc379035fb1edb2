"""Readers: weather grids, index stores, periodic series, regions."""

from croptide.sources.grids import read_grid, read_index_store
from croptide.sources.regions import read_regions
from croptide.sources.series import SERIES_KINDS, read_series

__all__ = ["SERIES_KINDS", "read_grid", "read_index_store", "read_regions",
           "read_series"]
