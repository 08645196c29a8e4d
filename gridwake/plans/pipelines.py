"""End-to-end plans: the tripline pipeline (cells x time buckets) and the
Mercator pipeline (tile pyramids). ``tripline_pipeline`` and
``mercator_pipeline`` return DataFrames, and the caller decides which ones to
write; ``write_tripline`` and ``write_mercator`` write all outputs in one run
that shares its work."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..config import Grid, Limits, Region
from ..operators.crossings import crossings
from ..operators.paths import TASK_ROWS, segments_anchored, segments_consecutive
from ..operators.sequence import spread
from ..operators.stats import cell_stats, cell_track_ids, cell_track_pairs
from ..operators.tiles import bin_counts, bin_hits, dense_tiles
from ..sinks.writers import write_cell_tables, write_stage, write_tiles
from ..sources.positions import filter_region

PATH_MODES = ("anchored", "consecutive")


def build_segments(points: DataFrame, limits: Limits, path_mode: str,
                   split_seconds: int | str = "auto",
                   zero_time_velocity: float | None = None, task_rows: int | None = None) -> DataFrame:
    if path_mode == "anchored":
        return segments_anchored(points, limits, split_seconds,
                                 -1.0 if zero_time_velocity is None else zero_time_velocity, task_rows=task_rows)
    if path_mode == "consecutive":
        return segments_consecutive(points, limits, split_seconds,
                                    math.inf if zero_time_velocity is None else zero_time_velocity, task_rows=task_rows)
    raise ValueError(f"path_mode must be one of {PATH_MODES}")


@dataclass(frozen=True)
class TriplineOptions:
    limits: Limits = field(default_factory=lambda: Limits(time_s=86400, distance_km=1000))
    grids: tuple[Grid, ...] = (Grid(),)
    temporal_split: str = "hour"
    path_mode: str = "anchored"
    dateline: str = "short_way"
    digits: str = "exact"
    origin_hit: str = "keep"
    split_seconds: int | str = "auto"


def legacy_tripline_options(**overrides) -> TriplineOptions:
    """Settings that reproduce the legacy tripline results, quirks included."""
    base = dict(path_mode="anchored", dateline="literal", digits="reference", origin_hit="drop")
    base.update(overrides)
    return TriplineOptions(**base)


def tripline_pipeline(points: DataFrame, opts: TriplineOptions = TriplineOptions()) -> dict[str, DataFrame]:
    """points -> segments -> crossings -> per-cell count / velocity / direction / ids."""
    seg = build_segments(points, opts.limits, opts.path_mode, opts.split_seconds, task_rows=TASK_ROWS)
    x = _grid_crossings(seg, opts)
    return {"segments": seg, "crossings": x, **_cell_tables(x, opts)}


def _grid_crossings(seg: DataFrame, opts: TriplineOptions) -> DataFrame:
    if opts.dateline == "short_way":
        for grid in opts.grids:
            if min(grid.region.lon_min, grid.region.lon_max) > -360.0 and grid.region.lon_max >= 180.0:
                warnings.warn(f"grid {grid.name!r}: paths routed over the antimeridian reach longitudes below -180; "
                              f"its region begins at {grid.region.lon_min} and clips their crossings", stacklevel=3)
    return crossings(seg, list(opts.grids), temporal_split=opts.temporal_split,
                     dateline=opts.dateline, digits=opts.digits, origin_hit=opts.origin_hit)


def _cell_tables(x: DataFrame, opts: TriplineOptions) -> dict[str, DataFrame]:
    labels = opts.digits == "reference"      # all tables share their keys
    stats = cell_stats(x, label_keys=labels)
    keys = ["grid", "lat_idx", "lon_idx", "lat", "lon", "dt"]
    return {
        "cell_stats": stats,
        "counts": stats.select(*keys, "value"),
        "velocity": stats.select(*keys, "velocity"),
        "direction": stats.select(*keys, "direction"),
        "track_ids": cell_track_ids(x, label_keys=labels),
        "track_pairs": cell_track_pairs(x, label_keys=labels),
    }


def write_tripline(points: DataFrame, base_path: str, opts: TriplineOptions = TriplineOptions()) -> dict[str, str]:
    """Write every table of the tripline pipeline under ``base_path`` in one
    run: segments and crossings are written once and each later table starts
    from what is written. Returns the paths."""
    spark, base = points.sparkSession, base_path.rstrip("/")
    paths = {n: f"{base}/{n}" for n in ("segments", "crossings", "track_pairs", "track_ids")}
    write_stage(build_segments(points, opts.limits, opts.path_mode, opts.split_seconds), paths["segments"])
    seg = spark.read.parquet(paths["segments"])
    write_stage(_grid_crossings(spread(seg, seg.count(), TASK_ROWS, "id", "bdt"), opts), paths["crossings"])
    tables = _cell_tables(spark.read.parquet(paths["crossings"]), opts)
    for name in ("track_pairs", "track_ids"):
        write_stage(tables[name], paths[name])
    return paths | write_cell_tables(tables["cell_stats"], base)


@dataclass(frozen=True)
class MercatorOptions:
    limits: Limits = field(default_factory=lambda: Limits(inclusive=False))
    region: Region = field(default_factory=lambda: Region(-90.0, -180.0, 90.0, 179.999999))
    max_level: int = 1
    path_mode: str = "consecutive"
    plane_offset: int = 0
    precision: str = "exact"
    velocity_decay: float | None = None
    split_seconds: int | str = "auto"


def legacy_mercator_options(**overrides) -> MercatorOptions:
    base = dict(path_mode="consecutive", plane_offset=1, precision="float32")
    base.update(overrides)
    return MercatorOptions(**base)


def mercator_pipeline(points: DataFrame, opts: MercatorOptions = MercatorOptions()) -> dict[str, DataFrame]:
    """points -> region filter -> segments -> bins for levels 1..max -> tiles."""
    opts.region.validate()
    pts = filter_region(points, opts.region)
    seg = build_segments(pts, opts.limits, opts.path_mode, opts.split_seconds)
    hits = bin_hits(seg, opts.max_level, opts.plane_offset, opts.precision,
                    opts.limits.velocity_kmh, opts.velocity_decay)
    counts = bin_counts(hits)
    return {"points": pts, "segments": seg, "bin_hits": hits, "bin_counts": counts,
            "tiles": dense_tiles(counts)}


def write_mercator(points: DataFrame, base_path: str, opts: MercatorOptions = MercatorOptions(), name: str = "tiles",
                   description: str = "") -> dict[str, str]:
    """Write the segments, the sparse bin counts and the dense tile sets under
    ``base_path`` in one run, each from the one before it. Returns the paths."""
    spark, base = points.sparkSession, base_path.rstrip("/")
    paths = {n: f"{base}/{n}" for n in ("segments", "bin_counts", "tiles")}
    opts.region.validate()
    write_stage(build_segments(filter_region(points, opts.region), opts.limits, opts.path_mode, opts.split_seconds),
                paths["segments"])
    hits = bin_hits(spark.read.parquet(paths["segments"]), opts.max_level, opts.plane_offset, opts.precision,
                    opts.limits.velocity_kmh, opts.velocity_decay)
    write_stage(bin_counts(hits), paths["bin_counts"])
    write_tiles(dense_tiles(spark.read.parquet(paths["bin_counts"])), paths["tiles"], name, description)
    return paths
