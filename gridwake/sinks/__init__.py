"""Sinks: stage tables, published versions, tab-separated count export, tile sets."""

from .published import publish, read_published
from .tile_sets import describe_tile_set, merge_tile_set, read_tile_counts
from .writers import (export_counts, read_counts, write_cell_tables, write_positions, write_stage,
                      write_tiles)

__all__ = ["describe_tile_set", "export_counts", "merge_tile_set", "publish", "read_counts", "read_published",
           "read_tile_counts", "write_cell_tables", "write_positions", "write_stage", "write_tiles"]
