"""What the axes of the inputs look like, from one pass over each.

Diagnostics, time alignment and the choice of a target grid all ask for the same
three axes. They are small (thousands of values) however large the grid is, so
one aggregate over all inputs fetches them with their sizes checked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_AXIS = 100_000
EPOCH = date(1970, 1, 1)


@dataclass(frozen=True)
class GridAxes:
    """Sorted distinct latitudes and longitudes of one grid."""

    lats: tuple[float, ...]
    lons: tuple[float, ...]

    @property
    def cells(self) -> int:
        return len(self.lats) * len(self.lons)

    def same_as(self, other: GridAxes) -> bool:
        """Whether both have the same nodes, up to rounding noise."""
        return all(
            len(a) == len(b) and all(abs(x - y) <= tolerance(b) for x, y in zip(a, b, strict=True))
            for a, b in ((self.lats, other.lats), (self.lons, other.lons)))


def tolerance(axis: Sequence[float]) -> float:
    """How far two values of one axis may lie apart and still be one node.

    A thousandth of the smallest step, which is more than FLOAT rounding of
    degrees on any grid coarser than 0.05; a single node has a fixed allowance.
    """
    steps = [b - a for a, b in pairwise(axis)]
    return 1e-3 * min(steps) if steps else 1e-5


class AxisTooLarge(ValueError):
    """An axis has more values than may pass through the driver."""


@dataclass(frozen=True)
class GridProfile:
    """Axes, row count and rows without a time or a place of one input.

    ``axes`` is None where only their lengths, ``shape``, are known.
    """

    axes: GridAxes | None
    days: tuple[date, ...]
    rows: int
    missing_times: int
    missing_places: int = 0
    shape: tuple[int, int] | None = None

    @property
    def size(self) -> tuple[int, int]:
        """Numbers of latitudes and longitudes."""
        return self.shape or (len(self.axes.lats), len(self.axes.lons))


def _axis_counts(grids: Mapping[str, DataFrame],
                 columns: Mapping[str, tuple[str | None, str | None, str | None]]) -> DataFrame:
    """``(input, axis, v, n)``: rows by every value of every axis.

    One pass per input (grouping sets) with map-side combining.
    """
    def axes_of(name: str, df: DataFrame) -> DataFrame:
        time, lat, lon = columns[name]
        values = {
            "t": F.unix_date(F.col(f"`{time}`").cast("date")).cast("double") if time else None,
            "y": F.col(f"`{lat}`").cast("double") if lat else None,
            "x": F.col(f"`{lon}`").cast("double") if lon else None,
        }
        axes = [a for a, v in values.items() if v is not None]
        counted = (df.select(*(values[a].alias(a) for a in axes))
                   .groupingSets([[a] for a in axes], *axes)
                   .agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n")))
        # In the grouping id, the one axis a row was grouped by has a zero bit.
        every = (1 << len(axes)) - 1
        axis, v = F.lit(None), F.lit(None).cast("double")
        for i, a in enumerate(axes):
            mine = F.col("g") == every ^ (1 << (len(axes) - 1 - i))
            axis, v = F.when(mine, F.lit(a)).otherwise(axis), F.when(mine, F.col(a)).otherwise(v)
        return counted.select(F.lit(name).alias("input"), axis.alias("axis"),
                              v.alias("v"), "n")

    return reduce(DataFrame.unionByName, (axes_of(n, g) for n, g in grids.items()))


def _days(values) -> tuple[date, ...]:
    return tuple(EPOCH + timedelta(days=int(d)) for d in sorted(values))


def profile_points(grids: Mapping[str, DataFrame],
                   columns: Mapping[str, tuple[str | None, str | None, str | None]],
                   max_axis: int | None = None) -> dict[str, GridProfile]:
    """Profiles without the places: only the days and the lengths of the axes are fetched."""
    counts, max_axis = _axis_counts(grids, columns), max_axis or MAX_AXIS
    facts = {(r["input"], r["axis"]): r for r in counts.groupBy("input", "axis").agg(
        F.count("v").alias("values"), F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
    ).collect()}
    bound = max(max_axis, MAX_AXIS) * len(grids)
    found = counts.where("axis = 't' AND v IS NOT NULL").select("input", "v").limit(
        bound + 1).collect()
    if len(found) > bound:
        raise AxisTooLarge(f"the inputs have more than {bound} days")

    def fact(name: str, axis: str, what: str) -> int:
        return facts[name, axis][what] if (name, axis) in facts else 0

    return {n: GridProfile(
        None, _days(r["v"] for r in found if r["input"] == n),
        max(fact(n, a, "rows") for a in "tyx"), fact(n, "t", "missing"),
        max(fact(n, a, "missing") for a in "yx"), (fact(n, "y", "values"), fact(n, "x", "values")))
        for n in grids}


def profile_grids(grids: Mapping[str, DataFrame],
                  columns: Mapping[str, tuple[str | None, str | None, str | None]],
                  max_axis: int | None = None) -> dict[str, GridProfile]:
    """Profiles of all inputs; ``columns`` names their (time, lat, lon).

    The shuffles carry axis values only; all inputs run as one job. Axes pass
    through the driver, so more than ``max_axis`` (default: ``MAX_AXIS``) values on
    one raise ``AxisTooLarge``; ``profile_points`` does without them.
    """
    counts, max_axis = _axis_counts(grids, columns), max_axis or MAX_AXIS
    bound = 3 * (max_axis + 1) * len(grids)
    found = counts.limit(bound + 1).toArrow().to_pylist()
    values: dict[tuple[str, str], list[float]] = {}
    rows, missing, nowhere = (dict.fromkeys(grids, 0) for _ in range(3))
    first = {n: next(a for a, c in zip("tyx", columns[n], strict=True) if c)
             for n in grids}
    for r in found:
        if r["axis"] == first[r["input"]]:
            rows[r["input"]] += r["n"]
        if r["axis"] == "t" and r["v"] is None:
            missing[r["input"]] += r["n"]
        elif r["v"] is None:
            nowhere[r["input"]] = max(nowhere[r["input"]], r["n"])
        if r["v"] is not None:
            values.setdefault((r["input"], r["axis"]), []).append(r["v"])
    if len(found) > bound or any(len(v) > max_axis for v in values.values()):
        raise AxisTooLarge(f"an input has more than {max_axis} values on one axis: not a grid")

    def axis(name: str, a: str) -> tuple[float, ...]:
        return tuple(sorted(values.get((name, a), ())))

    return {n: GridProfile(
        GridAxes(axis(n, "y"), axis(n, "x")),
        _days(axis(n, "t")), rows[n], missing[n],
        nowhere[n])
        for n in grids}


def grid_axes(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
              max_axis: int | None = None) -> GridAxes:
    """The spatial axes of one grid."""
    return profile_grids({"grid": df}, {"grid": (None, lat, lon)}, max_axis)["grid"].axes
