"""Sources: raw logs, tables, delimited text, pluggable readers."""

from .events import points_from_events, read_event_points
from .positions import (POINTS_SCHEMA, clean_fields, filter_region, normalise_positions,
                        parse_text_lines, points_from_table, points_from_text, read_points,
                        read_position_log, store_positions, to_points)

__all__ = [
    "POINTS_SCHEMA", "clean_fields", "filter_region", "normalise_positions", "parse_text_lines",
    "points_from_events", "points_from_table", "points_from_text", "read_event_points",
    "read_points", "read_position_log", "store_positions", "to_points",
]
