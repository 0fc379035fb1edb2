"""Cubes, common time axis, common grid, and the seven-variable table.

A cube is a long DataFrame (date, lat_i, lon_i, lat, lon, value) with one row per
cell and day. Its axes are small (a few thousand values), its product is not:
only axes are ever pinned on the driver or broadcast.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from datetime import date as Date
from functools import reduce
from math import floor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.constants import CELL, CUBE_COORDS
from croptide.operators.axes import AxisTables, place_cells
from croptide.operators.profile import GridAxes, grid_axes, tolerance
from croptide.session import local_table, pin_small


def _axis_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A broadcast axis table; its length is bounded by MAX_AXIS."""
    return local_table(spark, rows, schema)


def index_cells(df: DataFrame, axes: GridAxes | AxisTables, lat: str = "latitude",
                lon: str = "longitude") -> DataFrame:
    """Add integer axis positions ``lat_i``/``lon_i`` and call the axes lat, lon.

    Later joins use the integers, never floating-point coordinates.
    """
    if isinstance(axes, AxisTables):
        return place_cells(df, axes, lat, lon)
    rest = [c for c in df.columns if c not in (lat, lon)]
    df = _with_position(df, lat, axes.lats, "lat_i")
    df = _with_position(df, lon, axes.lons, "lon_i")
    return df.select(*(F.col(f"`{c}`") for c in rest), "lat_i", "lon_i",
                     F.col(lat).cast("double").alias("lat"),
                     F.col(lon).cast("double").alias("lon"))


def _with_position(df: DataFrame, column: str, axis: Sequence[float],
                   name: str) -> DataFrame:
    """Add the position of a coordinate on its axis; values off the axis go.

    An evenly spaced axis needs no lookup: its position is arithmetic, checked
    here on every axis value with the very operations Spark will run. Any other
    axis is looked up by equality, which is safe because the axis was read from
    the same column.
    """
    value = F.col(column).cast("double")
    if len(axis) > 1:
        first, step = axis[0], (axis[-1] - axis[0]) / (len(axis) - 1)
        if all(floor((v - first) / step + 0.5) == i for i, v in enumerate(axis)):
            position = F.floor((value - F.lit(first)) / F.lit(step) + F.lit(0.5))
            return df.filter(value.isNotNull()).withColumn(name, position.cast("int"))
    table = local_table(df.sparkSession, [(v, i) for i, v in enumerate(axis)],
                        f"_at double, {name} int")
    return df.join(table, value == F.col("_at")).drop("_at")


def with_coordinates(df: DataFrame, axes: GridAxes) -> DataFrame:
    """Attach ``lat``/``lon`` to axis positions."""
    spark = df.sparkSession
    y = local_table(spark, list(enumerate(axes.lats)), "lat_i int, lat double")
    x = local_table(spark, list(enumerate(axes.lons)), "lon_i int, lon double")
    return df.join(y, "lat_i").join(x, "lon_i")


def cells_of(spark: SparkSession, axes: GridAxes) -> DataFrame:
    """All cells of a grid (lat_i, lon_i, lat, lon), numbered from its axes alone.

    A range has an exact size, so a join against it is planned on facts.
    """
    n = max(len(axes.lons), 1)
    cells = spark.range(axes.cells).select(
        F.floor(F.col("id") / n).cast("int").alias("lat_i"),
        (F.col("id") % n).cast("int").alias("lon_i"))
    return with_coordinates(cells, axes).select("lat_i", "lon_i", "lat", "lon")


def to_cube(df: DataFrame, key: str, axes: GridAxes | AxisTables | None = None,
            time: str = "valid_time") -> DataFrame:
    """A normalised grid (one data column ``key``) as a cube."""
    axes = axes or grid_axes(df)
    return index_cells(df, axes).select(
        F.col(time).cast("date").alias("date"), *CUBE_COORDS[1:],
        F.col(key).cast("double").alias("value"))


def align_time(dfs: Sequence[DataFrame], date: str = "date",
               days: Sequence[Sequence[Date]] | None = None) -> list[DataFrame]:
    """Keep only the times that every input has; space plays no part.

    Without ``days`` the common time axis is evaluated once and semi-joined into
    every input, as a broadcast when its size allows. With the (bounded) time
    axes of a profile no pass is needed, and inputs that hold no other days are
    returned as they are.
    """
    if days is None:
        axes = [df.select(date).distinct() for df in dfs]
        common = pin_small(reduce(DataFrame.intersect, axes))
        if common.isEmpty():
            raise ValueError("the inputs have no time in common")
        return [df.join(common, date, "left_semi") for df in dfs]
    shared = sorted(set(days[0]).intersection(*days[1:]))
    if not shared:
        raise ValueError("the inputs have no time in common")
    common = day_table(dfs[0].sparkSession, shared, date)
    return [df if len(own) == len(shared) else df.join(common, date, "left_semi")
            for df, own in zip(dfs, days, strict=True)]


def day_table(spark: SparkSession, days: Sequence[Date], date: str = "date") -> DataFrame:
    """A broadcast table of days; its length is bounded by MAX_AXIS."""
    return _axis_table(spark, [(d,) for d in days], f"{date} date")


def choose_target_grid(grids: Sequence[GridAxes]) -> int:
    """Position of the grid with the most cells; the first one wins ties."""
    best = max(range(len(grids)), key=lambda i: grids[i].cells, default=None)
    if best is None or grids[best].cells == 0:
        raise ValueError("no input has a spatial grid")
    return best


def _brackets(source: Sequence[float], target: Sequence[float]) -> list[tuple]:
    """(target position, target value, source interval, weight of its upper end).

    Interval k spans source k … k+1. A target outside the source range gets
    interval −1 and no weight. A target within rounding noise of a source node
    (the edges included) lies on it.
    """
    out = []
    near = tolerance(source)
    for i, t in enumerate(target):
        at = bisect_right(source, t)
        node = min(range(max(at - 1, 0), min(at + 1, len(source))),
                   key=lambda n: abs(source[n] - t), default=None)
        if node is not None and abs(source[node] - t) <= near:
            out.append((i, t, node, 0.0))
            continue
        if not source or t < source[0] or t > source[-1]:
            out.append((i, t, -1, None))
            continue
        k = at - 1
        out.append((i, t, k, (t - source[k]) / (source[k + 1] - source[k])))
    return out


def _corner_table(spark: SparkSession, brackets: Sequence[tuple],
                  name: str) -> DataFrame:
    """Which intervals a source line serves, and as which end (0 low, 1 high)."""
    rows = set()
    for _, _, k, w in brackets:
        if k >= 0:
            rows.add((k, k, 0))
            if w > 0:
                rows.add((k + 1, k, 1))
    return _axis_table(spark, sorted(rows), f"_{name} int, p{name} int, end_{name} int")


def _target_table(spark: SparkSession, brackets: Sequence[tuple], name: str,
                  axis: str) -> DataFrame:
    return _axis_table(spark, [(k, i, float(t), w) for i, t, k, w in brackets],
                       f"p{name} int, {axis}_i int, {axis} double, w{name} double")


def snap_cells(df: DataFrame, source: GridAxes, target: GridAxes, value: str = "value"
               ) -> DataFrame:
    """A cube whose axes equal the target's up to rounding, with the target's."""
    placed = _with_position(df.select("date", "lat", "lon", value), "lat", source.lats, "lat_i")
    placed = _with_position(placed, "lon", source.lons, "lon_i").drop("lat", "lon")
    return with_coordinates(placed, target).select(*CUBE_COORDS, F.col(value))


def _complete(placed: DataFrame, days: DataFrame, by: Sequence[tuple], bx: Sequence[tuple],
               wanted: int) -> DataFrame | None:
    """The rectangles that have a corner on every day, or None when all ``wanted`` have.

    A source cell with as many rows as there are days is a corner on all of them.
    Only cells and their counts are shuffled.
    """
    spark = placed.sparkSession
    counted = (placed.join(days, "date", "left_semi").groupBy("_y", "_x")
               .agg(F.count(F.lit(1)).alias("n")))
    full = (counted.where(F.col("n") >= days.count())
            .join(_corner_table(spark, by, "y"), "_y").join(_corner_table(spark, bx, "x"), "_x")
            .select("py", "px").distinct())
    full = pin_small(full)
    return None if full.count() == wanted else full


def regrid_bilinear(df: DataFrame, target: GridAxes, source: GridAxes | None = None,
                    days: DataFrame | None = None, value: str = "value") -> DataFrame:
    """Bilinear interpolation of a cube onto another grid.

    Every source row is sent to the (at most four) source rectangles it is a
    corner of; one shuffle collects the corners of each rectangle and day; each
    rectangle is then spread over the target cells inside it by two broadcast
    axis joins. The shuffle therefore grows with the *source* grid, which is
    never larger than the target the engine picks. Rectangles that have no corner
    on some day are found from the cells' counts; only these are added, as empty
    ones, so that a source without gaps shuffles nothing but its own rows.

    Targets outside the source range, or with a missing corner of non-zero
    weight, are NULL. A cell-day that occurs twice is an error. A grid that
    already has the target's coordinates is returned unchanged, one that has them
    up to rounding takes the target's values. Giving ``source`` and ``days``
    saves a pass each.
    """
    source = source or grid_axes(df, "lat", "lon")
    if source == target:
        return df.select(*CUBE_COORDS, F.col(value))
    if source.same_as(target):
        return snap_cells(df, source, target, value)
    spark = df.sparkSession
    by, bx = _brackets(source.lats, target.lats), _brackets(source.lons, target.lons)

    placed = _with_position(df.select("date", "lat", "lon", value), "lat", source.lats, "_y")
    placed = _with_position(placed, "lon", source.lons, "_x")
    corners = (
        placed.join(_corner_table(spark, by, "y"), "_y")
        .join(_corner_table(spark, bx, "x"), "_x")
        .select("date", "py", "px", (F.col("end_y") * 2 + F.col("end_x")).alias("corner"),
                F.col(value).alias("v"))
    )
    days = df.select("date").distinct() if days is None else days
    inner_y, inner_x = ([k for k in sorted({k for _, _, k, _ in b}) if k >= 0] for b in (by, bx))

    def rectangles(ys: Sequence[int], xs: Sequence[int]) -> DataFrame:
        """Some rectangles on every day."""
        return (days.select("date", F.explode(F.lit(list(ys)).cast("array<int>")).alias("py"))
                .select("date", "py", F.explode(F.lit(list(xs)).cast("array<int>")).alias("px")))

    complete = _complete(placed, days, by, bx, len(inner_y) * len(inner_x))
    if complete is not None:
        # A gap in the source becomes NULL cells instead of absent ones.
        corners = corners.unionByName(
            rectangles(inner_y, inner_x).join(complete, ["py", "px"], "left_anti")
            .select("date", "py", "px", F.lit(None).cast("int").alias("corner"),
                    F.lit(None).cast("double").alias("v")))

    def corner(k: int):
        mine = F.col("corner") == k
        repeated = F.raise_error(F.concat(F.lit("duplicate grid rows on "),
                                          F.col("date").cast("string"))).cast("double")
        return F.when(F.count_if(mine) > 1, repeated).otherwise(
            F.max(F.when(mine, F.col("v")))).alias(f"v{k}")

    patches = corners.groupBy("date", "py", "px").agg(*(corner(k) for k in range(4)))
    # What lies outside the source has no corner to wait for.
    for ys, xs in (([-1], [-1, *inner_x]), (inner_y, [-1])):
        if any(k in ys for _, _, k, _ in by) and any(k in xs for _, _, k, _ in bx):
            patches = patches.unionByName(rectangles(ys, xs).select(
                "*", *(F.lit(None).cast("double").alias(f"v{k}") for k in range(4))))

    wy, wx = F.col("wy"), F.col("wx")
    weights = [(1 - wy) * (1 - wx), (1 - wy) * wx, wy * (1 - wx), wy * wx]
    blend = reduce(lambda a, b: a + b, (
        F.when(w > 0, w * F.col(f"v{k}")).otherwise(F.lit(0.0))
        for k, w in enumerate(weights)))
    return (
        patches
        .join(_target_table(spark, by, "y", "lat"), "py")
        .join(_target_table(spark, bx, "x", "lon"), "px")
        .select(*CUBE_COORDS,
                F.when((F.col("py") >= 0) & (F.col("px") >= 0), blend).alias(value))
    )


def assemble(cubes: Mapping[str, DataFrame], essential: Sequence[str] | None = None,
             axes: GridAxes | None = None) -> DataFrame:
    """Line the variables up on (date, cell): one wide row where all are present.

    One shuffle for all inputs instead of a chain of joins. It is by cell only,
    which also serves the grouping by (date, cell) and every later window over a
    cell, so the whole index run adds no other exchange. Partitions hold whole
    cells, whose size is bounded by the days on record; a cell-day that occurs
    twice in one input is an error. With ``axes`` the coordinates stay out of the
    shuffle and are attached afterwards.
    """
    missing = [k for k in (essential or cubes) if cubes.get(k) is None]
    if missing:
        raise ValueError(f"essential inputs missing: {missing}")
    names = list(cubes)
    carried = [] if axes else ["lat", "lon"]
    rows = reduce(DataFrame.unionByName, (
        df.select("date", *CELL, *carried, F.lit(k).alias("_input"), "value")
        for k, df in enumerate(cubes.values())))
    at = F.col("_input")
    full = (
        rows.repartition(*CELL)
        .groupBy("date", *CELL)
        .agg(
            *(F.min(c).alias(c) for c in carried),
            F.bit_or(F.expr("shiftleft(1, _input)")).alias("_seen"),
            F.count(F.lit(1)).alias("_rows"),
            *(F.max(F.when(at == k, F.col("value"))).alias(name)
              for k, name in enumerate(names)),
        )
        .filter(F.col("_seen") == (1 << len(names)) - 1)
    )
    # Checked inside the date column so that it costs no extra pass.
    date = F.when(
        F.col("_rows") > len(names),
        F.raise_error(F.concat(F.lit("duplicate grid rows on "),
                               F.col("date").cast("string"))).cast("date"),
    ).otherwise(F.col("date"))
    if axes:
        full = with_coordinates(full, axes)
    return full.select(date.alias("date"), *CUBE_COORDS[1:], *names)
