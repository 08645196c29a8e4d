"""Geodesy and grid arithmetic as native Spark column expressions.

Functions map Columns to a Column, so the expressions stay inside whole-stage
code generation; ``great_circle_km`` is the one numpy twin, for task code.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EARTH_RADIUS_KM, MERCATOR_MAX_LAT, TILE_BINS


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def wrap_pair(a, b) -> tuple[Column, Column]:
    """If one value is below -90 and the other above 90, move the larger one
    down by 360 (applied to latitudes and longitudes alike)."""
    a, b = _c(a), _c(b)
    b2 = F.when((a < -90) & (b > 90), b - 360.0).otherwise(b)
    a2 = F.when(~((a < -90) & (b > 90)) & (b < -90) & (a > 90), a - 360.0).otherwise(a)
    return a2, b2


def haversine_km(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance ``2R atan2(sqrt(a), sqrt(1-a))`` after wrapping
    both coordinate pairs. ``a`` is clamped to [0, 1] so rounding noise can
    never produce NaN; NaN or infinite coordinates give NaN."""
    la1, la2 = wrap_pair(lat1, lat2)
    lo1, lo2 = wrap_pair(lon1, lon2)
    dlat = F.radians(la2 - la1)
    dlon = F.radians(lo2 - lo1)
    a = (F.sin(dlat / 2) * F.sin(dlat / 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.sin(dlon / 2) * F.sin(dlon / 2))
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    # Spark orders NaN above all numbers, so the clamp turns it into 1; the zero
    # term brings NaN back (and makes it of infinities) at no further cost
    spoiled = (_c(lat1) + _c(lon1) + _c(lat2) + _c(lon2)) * F.lit(0.0)
    return F.lit(float(radius)) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))) + spoiled


def great_circle_km(lat1, lon1, lat2, lon2):
    """Numpy form of the distance for code that runs in tasks. The sines have
    period 360, so no wrapping is needed; NaN and infinities give NaN."""
    with np.errstate(invalid="ignore"):
        phi1, phi2 = np.radians(lat1), np.radians(lat2)
        half_lat, half_lon = (phi2 - phi1) / 2, np.radians(np.subtract(lon2, lon1)) / 2
        chord = np.clip(np.sin(half_lat) ** 2 + np.cos(phi1) * np.cos(phi2) * np.sin(half_lon) ** 2, 0.0, 1.0)
        return 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    return haversine_km(lat1, lon1, lat2, lon2, radius=EARTH_RADIUS_KM * 1000.0)


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial great-circle bearing in degrees, in [0, 360)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    r1, r2 = F.radians(lat1), F.radians(lat2)
    dlon = F.radians(lon2 - lon1)
    b = F.atan2(F.sin(dlon) * F.cos(r2), F.cos(r1) * F.sin(r2) - F.sin(r1) * F.cos(r2) * F.cos(dlon))
    return F.pmod(F.degrees(b) + 360.0, F.lit(360.0))


def elapsed_seconds(t1, t2) -> Column:
    """Signed whole seconds from ``t1`` to ``t2`` (bigint)."""
    return F.unix_timestamp(_c(t2)) - F.unix_timestamp(_c(t1))


def speed_kmh(distance_km, seconds, zero_time: float = -1.0) -> Column:
    """``km / (s / 3600)``; ``zero_time`` when no time passed. The guard also
    keeps ANSI mode from raising on a division by zero."""
    distance_km, seconds = _c(distance_km), _c(seconds)
    return (F.when(seconds == 0, F.lit(float(zero_time)))
            .otherwise(distance_km / (seconds.cast("double") / 3600.0)))


def in_box(lat, lon, lat_min: float, lon_min: float, lat_max: float, lon_max: float,
           tol: float) -> Column:
    lat, lon = _c(lat), _c(lon)
    return (lat.between(min(lat_min, lat_max) - tol, max(lat_min, lat_max) + tol)
            & lon.between(min(lon_min, lon_max) - tol, max(lon_min, lon_max) + tol))


# ---------------------------------------------------------------- Web Mercator

def mercator_pixel(lat, lon, level) -> tuple[Column, Column]:
    """Global bin coordinates of a point at zoom ``level``: x grows east from
    -180, y grows north from the southern clamp latitude. Both are clamped
    to ``[0, 256 * 2^level - 1]``."""
    lat, lon, level = _c(lat), _c(lon), _c(level)
    n = F.pow(F.lit(2.0), level.cast("double")) * float(TILE_BINS)
    phi = F.radians(F.least(F.greatest(lat, F.lit(-MERCATOR_MAX_LAT)), F.lit(MERCATOR_MAX_LAT)))
    fx = (lon + 180.0) / 360.0
    fy = 0.5 + F.log(F.tan(F.lit(math.pi / 4) + phi / 2)) / (2 * math.pi)
    top = n.cast("bigint") - 1
    px = F.least(F.greatest(F.floor(fx * n), F.lit(0)), top)
    py = F.least(F.greatest(F.floor(fy * n), F.lit(0)), top)
    return px, py


def tile_of_pixel(px, py) -> tuple[Column, Column, Column, Column]:
    """(tile_x, tile_y, bin_x, bin_y): tiles count north-up, bins inside a
    tile count from the top row."""
    px, py = _c(px), _c(py)
    return (F.floor(px / TILE_BINS), F.floor(py / TILE_BINS),
            F.pmod(px, F.lit(TILE_BINS)), (TILE_BINS - 1) - F.pmod(py, F.lit(TILE_BINS)))
