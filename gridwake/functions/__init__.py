"""Native column functions: geodesy, grid and time arithmetic."""

from .geo import (bearing_deg, elapsed_seconds, haversine_km, haversine_m, in_box,
                  mercator_pixel, speed_kmh, tile_of_pixel, wrap_pair)
from .timefn import bucket_start, format_ts, parse_dt, temporal_bucket

__all__ = [
    "bearing_deg", "elapsed_seconds", "haversine_km", "haversine_m", "in_box",
    "mercator_pixel", "speed_kmh", "tile_of_pixel", "wrap_pair",
    "bucket_start", "format_ts", "parse_dt", "temporal_bucket",
]
