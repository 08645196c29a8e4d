"""Parameters of the movement analytics, as plain dataclasses.

Everything here is a plan-time literal: operators turn these values into
Spark column expressions, so Catalyst folds them into the generated code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

# Fixed values that results depend on.
EARTH_RADIUS_KM = 6371.0
COORD_TOLERANCE = 0.0000001          # box tolerance for point-in-region tests
MIN_INTERPOLATION_SPEED = 0.00001    # km/h; slower segments get crossing time = start
MERCATOR_MAX_LAT = 85.05112878       # Web-Mercator latitude clamp
TILE_BINS = 256                      # bins per tile edge
LON_VALID_MAX = 179.999999           # upper longitude bound accepted by Region.validate
TEMPORAL_SPLITS = ("all", "year", "month", "day", "hour", "10min", "minute")
ALL_TIME_LABEL = "9999-01-01 00:00:00"


@dataclass(frozen=True)
class Region:
    """Closed lat/lon box. ``lon_min`` may go below -180 so that paths routed
    the short way over the antimeridian stay inside the box."""

    lat_min: float = -90.0
    lon_min: float = -180.0
    lat_max: float = 90.0
    lon_max: float = 180.0

    def validate(self, lon_upper: float = LON_VALID_MAX) -> "Region":
        """Range check of the box (raises ``ValueError``), used by the tile
        pipeline where coordinates must be real longitudes."""
        for v in (self.lat_min, self.lat_max):
            if v < -90 or v > 90:
                raise ValueError(f"region latitudes {self.lat_min}, {self.lat_max} leave [-90, 90]")
        for v in (self.lon_min, self.lon_max):
            if v < -180 or v > lon_upper:
                raise ValueError(f"region longitudes {self.lon_min}, {self.lon_max} leave [-180, {lon_upper}]")
        return self


@dataclass(frozen=True)
class Grid:
    """A tripline grid over a region: horizontal lines every ``res_lat``
    degrees, vertical lines every ``res_lon`` degrees."""

    res_lat: float = 0.1
    res_lon: float = 0.1
    region: Region = field(default_factory=lambda: Region(-90.0, -360.0, 90.0, 180.0))
    name: str = "grid"

    @property
    def lat_index_min(self) -> int:
        return int(math.floor(self.region.lat_min / self.res_lat))

    @property
    def lat_index_max(self) -> int:
        return int(math.ceil(self.region.lat_max / self.res_lat))

    @property
    def lon_index_min(self) -> int:
        return int(math.floor(self.region.lon_min / self.res_lon))

    @property
    def lon_index_max(self) -> int:
        return int(math.ceil(self.region.lon_max / self.res_lon))

    @property
    def lon_wrap_cells(self) -> int:
        """Number of longitude cells in 360 degrees."""
        return int(round(360.0 / self.res_lon))


@dataclass(frozen=True)
class Limits:
    """Connection limits for path building.

    ``time_s``: largest gap between the two ends of a segment (seconds).
    ``distance_km``: largest segment length (km).
    ``velocity_kmh``: consecutive mode only; negative disables it.
    ``inclusive``: keep a pair whose value equals the limit (anchored mode
    defaults to True, consecutive mode to False).
    """

    time_s: float = float(2**31 - 1)
    distance_km: float = float(2**31 - 1) / 1000.0
    velocity_kmh: float = -1.0
    inclusive: bool | None = None


def decimals_of(res: float) -> int:
    """Digits after the decimal point in the shortest repr of ``res``."""
    text = repr(float(res))
    if "e" in text or "E" in text:
        mant, exp = text.lower().split("e")
        frac = mant.split(".")[1] if "." in mant else ""
        frac = frac.rstrip("0")
        return max(0, len(frac) - int(exp))
    frac = text.split(".")[1].rstrip("0")
    return len(frac)


def label_digits(res: float, mode: str = "exact") -> int:
    """Rounding digits for cell-centre labels.

    ``exact``: enough digits to write the centre ``(i + 0.5) * res`` exactly.
    ``reference``: ``-round(ln(res))`` (natural log), the legacy behaviour.
    """
    if mode == "reference":
        return -int(round(math.log(res)))
    if mode != "exact":
        raise ValueError(f"unknown digits mode {mode!r}")
    return decimals_of(res) + 1
