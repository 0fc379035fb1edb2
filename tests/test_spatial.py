import math
import random
import statistics

import pytest
from helpers import day
from pyspark.sql import functions as F

from croptide.operators import spatial
from croptide.operators.align import cells_of
from croptide.operators.profile import GridAxes

RING = "region int, region_abbr string, ring array<struct<x:double,y:double>>"


def outlines(spark, *rows):
    return spark.createDataFrame([(n, a, [tuple(map(float, p)) for p in r])
                                  for n, a, r in rows], RING)


def inside(rings, x, y):
    """Even-odd rule with half-open edges, over all rings of a region."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if min(y1, y2) <= y < max(y1, y2):
                odd ^= x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x
    return odd


def masked(df):
    return {(r["lat_i"], r["lon_i"]): r["region"] for r in df.collect()}


def brute_mask(rows, axes):
    out = {}
    for i, y in enumerate(axes.lats):
        for j, x in enumerate(axes.lons):
            for n in sorted({n for n, _, _ in rows}):
                if inside([r for m, _, r in rows if m == n], x, y):
                    out[i, j] = n
                    break
    return out


def test_mask_edges_are_half_open_and_lowest_number_wins(spark):
    square = [(0, 0), (2, 0), (2, 2), (0, 2)]
    shifted = [(1, 0), (4, 0), (4, 2), (1, 2), (1, 0)]  # closed ring
    rows = [(7, "A", square), (3, "B", shifted)]
    axes = GridAxes((0.0, 1.0, 2.0), (0.0, 1.0, 2.0, 3.0, 4.0))
    got = masked(spatial.region_mask(cells_of(spark, axes), outlines(spark, *rows)))
    row = {0: 7, 1: 3, 2: 3, 3: 3}
    assert got == {(i, j): n for i in (0, 1) for j, n in row.items()}
    assert got == brute_mask(rows, axes)


def test_mask_parts_and_holes(spark):
    outer = [(0, 0), (10, 0), (10, 10), (0, 10)]
    hole = [(3, 3), (7, 3), (7, 7), (3, 7)]
    island = [(20, 1), (25, 1), (25, 4), (20, 4)]
    rows = [(1, "A", outer), (1, "A", hole), (1, "A", island)]
    axes = GridAxes(tuple(float(i) for i in range(-1, 12)), tuple(float(i) for i in range(-1, 27)))
    got = masked(spatial.region_mask(cells_of(spark, axes), outlines(spark, *rows)))
    assert got == brute_mask(rows, axes)
    assert (6, 6) not in got and (3, 22) in got


def test_mask_random_polygons_match_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for n in range(6):
        cx, cy, k = rnd.uniform(-20, 20), rnd.uniform(-12, 12), rnd.randint(3, 25)
        ring = [(cx + rnd.uniform(2, 9) * math.cos(2 * math.pi * i / k),
                 cy + rnd.uniform(2, 9) * math.sin(2 * math.pi * i / k)) for i in range(k)]
        rows.append((n, f"R{n}", ring))
    axes = GridAxes(tuple(i * 0.7 - 14 for i in range(40)),
                    tuple(i * 0.9 - 25 for i in range(56)))
    for band in (1.0, 5.0):
        got = masked(spatial.region_mask(cells_of(spark, axes), outlines(spark, *rows), band))
        assert got == brute_mask(rows, axes) and len(got) > 200


def regional(spark, method, values):
    df = spark.createDataFrame(
        [(day(0), 0, j, v) for j, v in enumerate(values)],
        "date date, lat_i int, lon_i int, GDD double")
    mask = spark.createDataFrame(
        [(0, j, 1) for j in range(len(values))] + [(9, 9, 2)],
        "lat_i int, lon_i int, region int")
    rows = spatial.regional_aggregate(df, mask, method).collect()
    assert [r["region"] for r in rows] == [1]
    return rows[0]["GDD"]


def test_reducers_skip_missing(spark):
    v = [None, 4.0, 1.0, None, 10.0, None]
    known = [x for x in v if x is not None]
    want = {"mean": 5.0, "max": 10.0, "min": 1.0, "sum": 15.0, "median": 4.0, "first": 4.0,
            "last": 10.0, "std": statistics.pstdev(known), "var": statistics.pvariance(known)}
    for method, w in want.items():
        assert regional(spark, method, v) == pytest.approx(w), method
    assert regional(spark, "mean", [None, None]) is None
    assert regional(spark, "sum", [None, None]) == 0.0
    with pytest.raises(ValueError, match="unknown method"):
        regional(spark, "mode", v)


def test_cells_outside_every_region_are_dropped(spark):
    df = spark.createDataFrame([(day(0), 0, 0, 1.0), (day(0), 5, 5, 100.0)],
                               "date date, lat_i int, lon_i int, GDD double")
    mask = spark.createDataFrame([(0, 0, 1)], "lat_i int, lon_i int, region int")
    assert [r["GDD"] for r in spatial.regional_aggregate(df, mask).collect()] == [1.0]


def test_large_mask_is_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(spatial, "MASK_PIN_ROWS", 2)
    df = spark.createDataFrame([(day(0), 0, j, float(j)) for j in range(8)],
                               "date date, lat_i int, lon_i int, GDD double")

    def result(cells):
        mask = spark.createDataFrame([(0, j, 1) for j in cells],
                                     "lat_i int, lon_i int, region int")
        out = spatial.regional_aggregate(df, mask)
        return out.first()["GDD"], out._jdf.queryExecution().executedPlan().toString()

    total, plan = result(range(0, 8, 2))  # four runs
    assert total == 3.0 and "SortMergeJoin" in plan and "Broadcast" not in plan
    total, plan = result(range(6))  # six cells in one run: the cube stays in place
    assert total == 2.5 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def long_rows(spark):
    return spark.createDataFrame(
        [(day(0), 1, 1.0, 10.0), (day(0), 2, 2.0, None), (day(1), 2, 3.0, 30.0),
         (day(1), 5, 4.0, 40.0)], "date date, region int, GDD double, SPI double")


def names(spark):
    return outlines(spark, (1, "KS", [(0, 0)]), (2, "ND", [(0, 0)]), (2, "ND", [(1, 1)]))


def test_labels(spark):
    rows = spatial.label_regions(long_rows(spark), names(spark))
    assert sorted(r["region_abbr"] for r in rows.collect()) == ["KS", "ND", "ND", "Unk_5"]


def test_selection_and_pivot(spark):
    rows = spatial.label_regions(long_rows(spark), names(spark))
    assert spatial.select_regions(rows, []).count() == 4
    assert spatial.select_regions(rows, None).count() == 4
    assert spatial.select_regions(rows, ["ND", "XX"]).count() == 2
    wide = spatial.pivot_regions(rows).orderBy("date")
    assert wide.columns == ["date", "GDD_KS", "GDD_ND", "GDD_Unk_5",
                            "SPI_KS", "SPI_ND", "SPI_Unk_5"]
    assert [tuple(r)[1:] for r in wide.collect()] == [
        (1.0, 2.0, None, 10.0, None, None), (None, 3.0, 4.0, None, 30.0, 40.0)]
    one = spatial.pivot_regions(rows, ["GDD"], ["KS"]).orderBy("date")
    assert [tuple(r)[1:] for r in one.collect()] == [(1.0,), (None,)]
    none = spatial.pivot_regions(rows, abbrs=[])
    assert none.columns == ["date"] and none.count() == 2
    unmatched = spatial.pivot_regions(rows, ["GDD"], ["XX"])
    assert [r["GDD_XX"] for r in unmatched.collect()] == [None, None]


def test_belt(spark):
    rows = spark.createDataFrame(
        [(day(0), "KS", 1.0, 5.0, 9.0), (day(0), "ND", 3.0, 1.0, 8.0),
         (day(0), "CA", 99.0, 99.0, 99.0), (day(1), "KS", 2.0, None, 7.0)],
        "date date, region_abbr string, GDD double, SPI double, WindSpeed double")
    got = {(r["date"], r["variable"]): tuple(r)[2:]
           for r in spatial.belt_aggregate(rows).collect()}
    assert got[day(0), "GDD"] == (2.0, pytest.approx(math.sqrt(2)), None, 3.0)
    assert got[day(0), "SPI"] == (3.0, pytest.approx(math.sqrt(8)), 1.0, None)
    assert got[day(0), "WindSpeed"][2:] == (None, None)
    assert got[day(1), "GDD"] == (2.0, None, None, 2.0)
    assert got[day(1), "SPI"] == (None, None, None, None)


def test_grid_cells(spark):
    df = cells_of(spark, GridAxes((0.0, 1.0), (0.0,)))
    twice = df.unionByName(df).withColumn("date", F.lit(day(0)))
    assert spatial.grid_cells(twice).count() == 2


@pytest.mark.parametrize("method", ["mean", "median", "sum"])
def test_mask_that_is_joined_in_tiles(spark, monkeypatch, method):
    """Runs longer than tiles and many regions in a row; also left of the first tile."""
    rng = random.Random(8)
    monkeypatch.setattr(spatial, "TILE", 4)
    cells = [(y, x) for y in range(-1, 3) for x in range(-9, 30)]
    df = spark.createDataFrame([(day(d), y, x, float(rng.randrange(50))) for d in range(2)
                                for y, x in cells],
                               "date date, lat_i int, lon_i int, GDD double")
    mask = spark.createDataFrame(
        [(y, x, rng.choice([1, 1, 2, 3])) for y, x in cells if x % 11], "lat_i int, lon_i int, region int")
    pinned = spatial.regional_aggregate(df, mask, method, ["GDD"])
    want = sorted(map(tuple, pinned.collect()))
    monkeypatch.setattr(spatial, "MASK_PIN_ROWS", 0)
    tiled = spatial.regional_aggregate(df, mask, method, ["GDD"])
    assert sorted(map(tuple, tiled.collect())) == want
    plan = tiled._jdf.queryExecution().toString()
    assert "SortMergeJoin [lat_i#" in plan
    keys = plan.split("SortMergeJoin [")[1].split("]")[0]
    assert "/ 4" in keys, keys
