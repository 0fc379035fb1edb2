"""Seven weather grids to one index store."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from croptide.constants import INPUT_FOLDERS
from croptide.operators.align import (
    align_time,
    assemble,
    choose_target_grid,
    day_table,
    regrid_bilinear,
    to_cube,
)
from croptide.operators.axes import common_axes
from croptide.operators.indices import compute_indices
from croptide.operators.normalize import normalize_coords, pick_variable
from croptide.operators.profile import (
    AxisTooLarge,
    GridProfile,
    profile_grids,
    profile_points,
)
from croptide.operators.quality import coordinate_columns, diagnose, has_critical
from croptide.sinks import clear_stages, fingerprint, materialize_stage, write_index_store
from croptide.sources import read_grid

log = logging.getLogger(__name__)


def _stage(key: str, *inputs) -> str:
    """A stage name that changes with whatever the cube is made of."""
    return f"cube_{key}_{fingerprint(*inputs)}"


def profiles_of(grids: Mapping[str, DataFrame], columns: Mapping[str, tuple],
                max_axis: int | None = None) -> dict[str, GridProfile]:
    """Profiles with axes where the driver may hold them, else with their lengths."""
    try:
        return profile_grids(grids, columns, max_axis)
    except AxisTooLarge as e:
        log.info("axes stay tables: %s", e)
        return profile_points(grids, columns, max_axis)


def assemble_inputs(spark: SparkSession, grids: Mapping[str, DataFrame],
                    time_col: str = "valid_time", stage_dir: str | None = None,
                    keep_stages: bool = False, force: bool = False,
                    profiles: Mapping[str, GridProfile] | None = None,
                    made: list[str] | None = None, max_axis: int | None = None) -> DataFrame:
    """Grids of any resolution as one wide table on the finest grid.

    One pass over the coordinates decides everything about axes; inputs that
    already lie on the common days and the target grid are neither joined nor
    regridded. With ``keep_stages`` each regridded cube is written before the
    shuffle that lines the variables up, where a table costs no extra exchange.
    Stages are named by their input's files, the target grid and the days, so
    other inputs never find them; ``made`` collects the names. Inputs with an axis of
    more than ``max_axis`` values have to lie on the same places; their axes stay
    tables and never pass the driver.
    """
    made = [] if made is None else made
    keys = list(grids)
    ready = {k: pick_variable(normalize_coords(g), k, (time_col, "latitude", "longitude"))
             for k, g in grids.items()}
    profiles = profiles or profiles_of(
        ready, dict.fromkeys(keys, (time_col, "latitude", "longitude")), max_axis)
    late = [k for k in keys if profiles[k].missing_times]
    if late:
        raise ValueError(f"missing timestamps in {late}")
    lost = [k for k in keys if profiles[k].missing_places]
    if lost:
        raise ValueError(f"rows without latitude or longitude in {lost}")
    axes = {k: profiles[k].axes for k in keys}
    if None in axes.values():
        tables = common_axes([ready[k] for k in keys])
        return assemble(dict(zip(keys, align_time(
            [to_cube(ready[k], k, tables, time_col) for k in keys],
            days=[profiles[k].days for k in keys]), strict=True)))
    target = axes[keys[choose_target_grid([axes[k] for k in keys])]]
    shared = sorted(set(profiles[keys[0]].days).intersection(
        *(profiles[k].days for k in keys)))
    cubes = dict(zip(keys, align_time(
        [to_cube(ready[k], k, axes[k], time_col) for k in keys],
        days=[profiles[k].days for k in keys]), strict=True))
    aligned = {}
    for k in keys:
        if axes[k].same_as(target):
            aligned[k] = cubes[k]  # cells are numbered alike
            continue

        def moved(k: str = k) -> DataFrame:
            return regrid_bilinear(cubes[k], target, axes[k], day_table(spark, shared))

        if not keep_stages:
            aligned[k] = moved()
            continue
        made.append(_stage(k, ready[k], axes[k], target, shared))
        aligned[k] = materialize_stage(spark, moved, made[-1], stage_dir, force)
    return assemble(aligned, axes=target)


def compute_index_store(spark: SparkSession, base_path: str, save_path: str,
                        time_col: str = "valid_time", force_recompute: bool = False,
                        file_format: str = "parquet", stage_dir: str | None = None,
                        keep_stages: bool = True, stage_assembled: bool = False,
                        max_axis: int | None = None) -> str | None:
    """Read the seven folders below ``base_path`` and write all six indices.

    Returns the store path, or None when the diagnostics find a critical
    problem. A failed run resumes from the stages it finished, which only a run
    over the same files finds; with ``force_recompute`` they are written anew. A
    run that succeeds removes its stages. ``stage_assembled`` keeps the assembled
    table too, so that a failed store write does not line the inputs up again; it
    costs a table of that size and a second exchange by cell. ``max_axis`` is as in
    ``assemble_inputs``.
    """
    stages: list[str] = []
    grids: dict[str, DataFrame | None] = {}
    for key, folder in INPUT_FOLDERS.items():
        try:
            grids[key] = read_grid(spark, f"{base_path}/{folder}", time_col, file_format)
        except FileNotFoundError as e:
            log.error("input %s: %s", key, e)
            grids[key] = None
    profiles = None
    if all(g is not None for g in grids.values()):
        profiles = profiles_of(grids, {
            k: coordinate_columns(g, time_col) for k, g in grids.items()}, max_axis)
    if has_critical(diagnose(spark, grids, time_col, profiles)):
        log.error("critical input problems; no store written")
        return None
    wide = assemble_inputs(spark, grids, time_col, stage_dir, keep_stages,
                           force_recompute, profiles, stages, max_axis)
    if stage_assembled:
        assembled = wide
        stages.append(_stage("assembled", *grids.values()))
        wide = materialize_stage(spark, lambda: assembled, stages[-1], stage_dir,
                                 force_recompute)
    write_index_store(compute_indices(wide), save_path)
    clear_stages(spark, stages, stage_dir)
    return save_path
