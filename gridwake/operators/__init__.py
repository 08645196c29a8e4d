"""DataFrame -> DataFrame operators (lazy; no actions)."""

from .crossings import crossings, filter_segments_region, grid_index
from .paths import count_segments, segments_anchored, segments_consecutive
from .stats import (cell_counts, cell_direction, cell_stats, cell_track_id_parts, cell_track_ids,
                    cell_track_pairs, cell_velocity)
from .tiles import bin_counts, bin_hits, dense_tiles, plane_points, plane_to_bin, raster_plane

__all__ = [
    "crossings", "filter_segments_region", "grid_index", "cell_track_id_parts", "count_segments", "segments_anchored",
    "segments_consecutive", "cell_counts", "cell_direction", "cell_stats", "cell_track_ids",
    "cell_track_pairs", "cell_velocity", "bin_counts", "bin_hits", "dense_tiles",
    "plane_points", "plane_to_bin", "raster_plane",
]
