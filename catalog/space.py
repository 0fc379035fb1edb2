"""Cells to regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import (
    DENSE,
    GRID,
    INDEX_COLUMNS,
    dense_grid,
    index_sql,
    nation_cells,
    r,
    regions,
    rounded,
    sparse_grid,
)
from croptide.operators import indices, spatial

# Scan-line membership by even-odd counting over the four edges of each strip.
MASK = """
places AS (SELECT DISTINCT lat_i, lon_i, lat, lon FROM {source}),
edges AS (
  SELECT r_regionkey AS region, r_name AS abbr, r_regionkey + x1 AS x1, y1,
         r_regionkey + x2 AS x2, y2
  FROM region CROSS JOIN (VALUES
    (-0.5E0, -0.5E0, 0.5E0, -0.5E0), (0.5E0, -0.5E0, 0.9E0, 4.5E0),
    (0.9E0, 4.5E0, -0.1E0, 4.5E0), (-0.1E0, 4.5E0, -0.5E0, -0.5E0)) AS e(x1, y1, x2, y2)),
hits AS (
  SELECT lat_i, lon_i, region FROM places
  JOIN edges ON lat >= least(y1, y2) AND lat < greatest(y1, y2)
            AND x1 + (lat - y1) * (x2 - x1) / (y2 - y1) > lon
  GROUP BY lat_i, lon_i, region HAVING count(*) % 2 = 1),
mask AS (SELECT lat_i, lon_i, min(region) AS region FROM hits GROUP BY lat_i, lon_i)"""
DENSE_MASK = MASK.format(source="cells")


def q_mask(spark, sf):
    return spatial.region_mask(spatial.grid_cells(sparse_grid(spark, sf)),
                               regions(spark, sf))


def _mask(spark, sf):
    return spatial.region_mask(nation_cells(spark, sf), regions(spark, sf))


def _stat(method):
    def run(spark, sf):
        g = dense_grid(spark, sf)
        out = spatial.regional_aggregate(g, _mask(spark, sf), method,
                                         ("soil", "precip"))
        return out.select("date", "region", *(rounded(c).alias(c)
                                              for c in ("soil", "precip")))
    return run


def _stat_sql(expr: str) -> str:
    return f"""
WITH {DENSE}, {DENSE_MASK}
SELECT date, region, {r(expr.format(c='soil'))} AS soil, {r(expr.format(c='precip'))} AS precip
FROM dense JOIN mask USING (lat_i, lon_i) GROUP BY date, region"""


# Row-major cell order; ties cannot occur.
_AT = "lat_i * 1000 + lon_i"
STATS = {
    "mean": "avg({c})",
    "max": "max({c})",
    "min": "min({c})",
    "sum": "coalesce(sum({c}), 0)",
    "std": "stddev_pop({c})",
    "var": "var_pop({c})",
    "median": "median({c})",
    "first": f"arg_min({{c}}, CASE WHEN {{c}} IS NOT NULL THEN {_AT} END)",
    "last": f"arg_max({{c}}, CASE WHEN {{c}} IS NOT NULL THEN {_AT} END)",
}


def _indices_by_region(spark, sf):
    idx = indices.compute_indices(dense_grid(spark, sf))
    rows = spatial.regional_aggregate(idx, _mask(spark, sf))
    return spatial.label_regions(rows, regions(spark, sf))


REGIONAL = f"""
{DENSE}{index_sql('dense')}, {DENSE_MASK},
reg AS (
  SELECT date, mask.region, r_name AS region_abbr,
         {", ".join(f'avg({chr(34)}{c}{chr(34)}) AS {chr(34)}{c}{chr(34)}' for c in INDEX_COLUMNS)}
  FROM idx JOIN mask USING (lat_i, lon_i) JOIN region ON r_regionkey = mask.region
  GROUP BY date, mask.region, r_name)"""


def q_label(spark, sf):
    g = dense_grid(spark, sf)
    rows = spatial.regional_aggregate(g, _mask(spark, sf), "sum", ("soil",))
    known = regions(spark, sf).filter("region <> 4")
    return spatial.label_regions(rows, known).select(
        "date", "region_abbr", rounded("soil").alias("soil"))


def q_select(spark, sf):
    rows = spatial.select_regions(_indices_by_region(spark, sf), ["ASIA", "EUROPE", "XX"])
    return rows.select("date", "region_abbr", *(rounded(c).alias(c) for c in INDEX_COLUMNS))


def _pivot(variables, abbrs):
    def run(spark, sf):
        rows = _indices_by_region(spark, sf)
        labels = spatial.region_labels(regions(spark, sf)) if abbrs is None else abbrs
        wide = spatial.pivot_regions(rows, variables, labels)
        return wide.select("date", *(rounded(f"`{c}`").alias(c)
                                     for c in wide.columns if c != "date"))
    return run


def _pivot_sql(variables, abbrs) -> str:
    cols = ", ".join(
        f'''{r(f"""max(CASE WHEN region_abbr = '{a}' THEN "{v}" END)""")} AS "{v}_{a}"'''
        for v in variables for a in abbrs)
    return f"WITH {REGIONAL} SELECT date, {cols} FROM reg GROUP BY date"


def q_pivot_none(spark, sf):
    """A list that matches nothing keeps the days and has no feature values."""
    rows = _indices_by_region(spark, sf)
    return spatial.pivot_regions(spatial.select_regions(rows, None), ("GDD",), [])


def q_belt(spark, sf):
    rows = _indices_by_region(spark, sf)
    out = spatial.belt_aggregate(rows, ["AFRICA", "ASIA", "EUROPE", "MIDDLE EAST"])
    return out.select("date", "variable", *(rounded(c).alias(c) for c in (
        "Belt_Mean", "Belt_Std", "Belt_Min", "Belt_Max")))


BELT = REGIONAL + f""",
belt AS (
  {" UNION ALL ".join(f'''
  SELECT date, '{v}' AS variable, avg("{v}") AS "Belt_Mean",
    stddev_samp("{v}") AS "Belt_Std",
    {f'min("{v}")' if v in ("SPI", "SoilMoistureAnomaly") else 'CAST(NULL AS DOUBLE)'} AS "Belt_Min",
    {f'max("{v}")' if v in ("HeatwaveIndex", "GDD") else 'CAST(NULL AS DOUBLE)'} AS "Belt_Max"
  FROM reg WHERE region_abbr IN ('AFRICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') GROUP BY date'''
      for v in INDEX_COLUMNS)})"""

QUERIES = {
    "region_mask": (q_mask, f"WITH {GRID}, {MASK.format(source='grid')} SELECT lat_i, lon_i, region FROM mask"),
    **{("regional_aggregate" if m == "mean" else f"regional_{m}"):
       (_stat(m), _stat_sql(e)) for m, e in STATS.items()},
    "label_regions": (q_label, f"""
WITH {DENSE}, {DENSE_MASK}
SELECT date, CASE WHEN mask.region = 4 THEN 'Unk_4' ELSE r_name END AS region_abbr,
       {r('coalesce(sum(soil), 0)')} AS soil
FROM dense JOIN mask USING (lat_i, lon_i) JOIN region ON r_regionkey = mask.region
GROUP BY date, mask.region, r_name"""),
    "select_regions": (q_select, f"""
WITH {REGIONAL}
SELECT date, region_abbr, {", ".join(f'{r(chr(34) + c + chr(34))} AS "{c}"' for c in INDEX_COLUMNS)}
FROM reg WHERE region_abbr IN ('ASIA', 'EUROPE', 'XX')"""),
    "pivot_regions": (_pivot(INDEX_COLUMNS, None), _pivot_sql(
        INDEX_COLUMNS, ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))),
    "pivot_selected": (_pivot(("GDD",), ["ASIA", "EUROPE"]), _pivot_sql(
        ("GDD",), ("ASIA", "EUROPE"))),
    "pivot_no_region": (q_pivot_none, f"WITH {GRID} SELECT DISTINCT date FROM grid"),
    "belt_aggregate": (q_belt, f"""
WITH {BELT}
SELECT date, variable, {r('"Belt_Mean"')} AS "Belt_Mean", {r('"Belt_Std"')} AS "Belt_Std",
       {r('"Belt_Min"')} AS "Belt_Min", {r('"Belt_Max"')} AS "Belt_Max"
FROM belt"""),
}
