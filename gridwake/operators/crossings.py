"""Tripline crossings: where segments cross the lines of a lat/lon grid.

Line ``k`` of the latitude axis lies at ``k * res_lat`` (a horizontal line
over the region's longitude range); line ``k`` of the longitude axis lies at
``k * res_lon``. A segment crosses a line when its ends are on both sides
(closed: touching counts), it is not parallel to the line, and the crossing
point lies inside the region. Candidate lines come from the segment's
extent, padded by one line on each side and clamped to the grid; the line
on the region's top/right edge is never tested. Each hit is credited to the
cell north of a horizontal line or east of a vertical line and carries the
whole segment's velocity and bearing.

Everything is one native projection + ``explode(sequence(lo, hi))`` +
filter, so the fan-out is pruned by plain arithmetic before any row is
produced. Fused into one generated method with what follows, that is several
times too long for HotSpot to compile, so such stages are generated operator
by operator (see ``small_methods``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import COORD_TOLERANCE, MIN_INTERPOLATION_SPEED, Grid, label_digits
from ..functions.geo import bearing_deg, haversine_km
from ..functions.timefn import bucket_start, temporal_bucket
from ..session import small_methods

DATELINE_MODES = ("short_way", "literal")


def _grids(grid: Grid | Sequence[Grid]) -> list[Grid]:
    grids = [grid] if isinstance(grid, Grid) else list(grid)
    if not grids:
        raise ValueError("at least one grid is needed")
    names = [g.name for g in grids]
    if len(set(names)) != len(names):
        raise ValueError("grid names must be unique")
    return grids


# coarse cells (degrees) that a grid's region is indexed by; a region takes the first size of which it covers few
CELL_SIZES = (0.5, 3.0, 18.0, 108.0, 1000.0)
CELLS_PER_GRID = 16
ROUND_DIGITS = 9          # up to here degrees times 10^digits are whole numbers that a double holds


class _Params:
    """Parameters of the row's grid as columns: plan-time literals for one
    grid, fields of the struct that the grid index brings in for several."""

    def __init__(self, grids: list[Grid], digits: str):
        self.grids, self.digits, self.single = grids, digits, len(grids) == 1
        self.values = [_parameters(g, digits) for g in grids]

    def __getitem__(self, name: str) -> Column:
        return F.lit(self.values[0][name]) if self.single else F.col("_grid")[name]

    def round(self, value: Column, name: str) -> Column:
        """``round`` to the grid's number of digits, which Spark wants as a
        literal: one branch per number that occurs."""
        out = None
        for n in sorted({v[name] for v in self.values}):
            rounded = _round_centre(value, n) if self.digits == "exact" else F.round(value, n)
            if self.single:
                return rounded
            branch = (F.col("_grid")[name] == n, rounded)
            out = F.when(*branch) if out is None else out.when(*branch)
        return out


def _round_centre(value: Column, digits: int) -> Column:
    """``F.round`` for cell centres, which have that many digits but for the
    noise of one product: far from a tie, so whole numbers give the same
    double without a decimal per crossing. Not for very fine steps."""
    if not 0 <= digits <= ROUND_DIGITS:
        return F.round(value, digits)
    return F.floor(value * F.lit(10.0 ** digits) + 0.5) / F.lit(10.0 ** digits)


def _parameters(g: Grid, digits: str) -> dict:
    r = g.region
    return {
        "res_lat": float(g.res_lat), "res_lon": float(g.res_lon),
        "lat_lo": float(min(r.lat_min, r.lat_max)), "lat_hi": float(max(r.lat_min, r.lat_max)),
        "lon_lo": float(min(r.lon_min, r.lon_max)), "lon_hi": float(max(r.lon_min, r.lon_max)),
        "lat_first": g.lat_index_min, "lat_last": g.lat_index_max,
        "lon_first": g.lon_index_min, "lon_last": g.lon_index_max, "wrap": g.lon_wrap_cells,
        "lat_digits": label_digits(g.res_lat, digits), "lon_digits": label_digits(g.res_lon, digits),
    }


def _covering(v: dict) -> list[tuple[int, int, int]]:
    """Coarse cells ``(size number, row, column)`` that hold the region."""
    for level, size in enumerate(CELL_SIZES):
        rows = range(math.floor((v["lat_lo"] - COORD_TOLERANCE) / size), math.floor((v["lat_hi"] + COORD_TOLERANCE) / size) + 1)
        columns = range(math.floor((v["lon_lo"] - COORD_TOLERANCE) / size), math.floor((v["lon_hi"] + COORD_TOLERANCE) / size) + 1)
        if len(rows) * len(columns) <= CELLS_PER_GRID:
            break
    return [(level, y, x) for y in rows for x in columns]


def grid_index(spark: SparkSession, grids: Sequence[Grid], digits: str = "exact") -> DataFrame:
    """One row per grid and coarse cell of its region: ``level, row, column,
    grid, _grid`` (the parameters). At most about ``CELLS_PER_GRID`` rows a
    grid, whatever its size."""
    params = [_parameters(g, digits) for g in grids]
    cells = [(*cell, i) for i, v in enumerate(params) for cell in _covering(v)]
    kinds = {name: pa.float64() if isinstance(value, float) else pa.int64() for name, value in params[0].items()}
    table = pa.table({
        "level": pa.array([c[0] for c in cells], pa.int32()), "row": pa.array([c[1] for c in cells], pa.int64()),
        "column": pa.array([c[2] for c in cells], pa.int64()),
        "grid": pa.array([grids[c[3]].name for c in cells], pa.string()),
        "_grid": pa.array([params[c[3]] for c in cells], pa.struct(list(kinds.items()))),
    })
    return spark.createDataFrame(table)


def _inside(p, lat: str, lon: str) -> Column:
    """Whether a point lies in the closed region, with the tolerance."""
    return (F.col(lat).between(p["lat_lo"] - COORD_TOLERANCE, p["lat_hi"] + COORD_TOLERANCE)
            & F.col(lon).between(p["lon_lo"] - COORD_TOLERANCE, p["lon_hi"] + COORD_TOLERANCE))


def _with_grids(base: DataFrame, p: _Params, through: bool) -> DataFrame:
    """Segments with the grids whose region they touch: column ``grid`` and,
    for several grids, ``_grid``. With several grids both ends look up their
    coarse cells in the grid index by equality, so no segment meets a grid
    that is nowhere near; the second end counts only where the first misses."""
    if p.single:
        region = _parameters(p.grids[0], p.digits)
        touch = _through(region, "alat", "alon", "blat", "blon") if through else (
            _inside(p, "alat", "alon") | _inside(p, "blat", "blon"))
        return base.where(touch).withColumn("grid", F.lit(p.grids[0].name))
    index = grid_index(base.sparkSession, p.grids, p.digits)
    levels = sorted({cell[0] for v in p.values for cell in _covering(v)})
    ends = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col(lat) / CELL_SIZES[level]).alias("row"),
                              F.floor(F.col(lon) / CELL_SIZES[level]).alias("column"), F.lit(second).alias("second"))
                     for level in levels for second, lat, lon in ((False, "alat", "alon"), (True, "blat", "blon"))])
    found = base.withColumn("_end", F.explode(ends)).select("*", "_end.*").drop("_end")
    first, other = _inside(p, "alat", "alon"), _inside(p, "blat", "blon")
    return (found.join(index, ["level", "row", "column"])
            .where(F.when(F.col("second"), other & ~first).otherwise(first))
            .drop("level", "row", "column", "second"))


def _through(r: dict, alat: str, alon: str, blat: str, blon: str) -> Column:
    """Whether the segment, routed the short way, meets the closed region:
    the parts of it inside the latitude and the longitude limits overlap
    (parametric clipping). A route over the antimeridian reaches below -180,
    so it is also tried one turn up."""
    a, b = F.col(alon), F.col(blon)
    over = F.abs(a - b) > 180
    west, east = F.when(over & (a > b), a - 360.0).otherwise(a), F.when(over & ~(a > b), b - 360.0).otherwise(b)

    def part(start: Column, end: Column, lo: float, hi: float) -> tuple[Column, Column]:
        step = F.nullif(end - start, F.lit(0.0))
        one, two = (F.lit(lo) - start) / step, (F.lit(hi) - start) / step
        still = start.between(lo, hi)
        return (F.when(step.isNull(), F.when(still, 0.0).otherwise(2.0)).otherwise(F.least(one, two)),
                F.when(step.isNull(), F.when(still, 1.0).otherwise(-1.0)).otherwise(F.greatest(one, two)))

    tol = COORD_TOLERANCE
    def meets(way: Column) -> Column:
        lon_in, lon_out = part(way["west"], way["east"], r["lon_lo"] - tol, r["lon_hi"] + tol)
        lat_in, lat_out = part(way["alat"], way["blat"], r["lat_lo"] - tol, r["lat_hi"] + tol)
        return F.greatest(F.lit(0.0), lat_in, lon_in) <= F.least(F.lit(1.0), lat_out, lon_out)
    # bound once per row: written out in full, the clipping outgrows a generated method
    ways = F.array(*[F.struct((west + turn).alias("west"), (east + turn).alias("east"), F.col(alat).alias("alat"),
                              F.col(blat).alias("blat")) for turn in (0.0, 360.0)])
    return F.exists(ways, meets)


def filter_segments_region(segments: DataFrame, grid: Grid, through: bool = False) -> DataFrame:
    """Keep segments with at least one end inside the grid's region (closed
    box, 1e-7 tolerance); a segment passing over the whole region with both
    ends outside is dropped. ``through=True`` keeps every segment that meets
    the region, with its ends or on its way (the short way round)."""
    region = _parameters(grid, "exact")
    if through:
        return segments.where(_through(region, "alat", "alon", "blat", "blon"))
    literals = {name: F.lit(value) for name, value in region.items()}
    return segments.where(_inside(literals, "alat", "alon") | _inside(literals, "blat", "blon"))


def _hits(df: DataFrame, p: _Params, axes: Sequence[str], dateline: str) -> DataFrame:
    """All line hits of both axes from one ``explode``. ``df`` has lat1, lon1,
    lat2, lon2 (as given), slon1, slon2 (shifted the short way) and the
    carried columns. Axis code 0 = latitude lines, 1 = longitude lines."""
    lat1, lat2 = F.col("lat1"), F.col("lat2")
    slon1, slon2 = F.col("slon1"), F.col("slon2")
    if dateline == "short_way":
        glon1, glon2 = slon1, slon2
    else:
        glon1, glon2 = F.col("lon1"), F.col("lon2")
    res_lat, res_lon = p["res_lat"], p["res_lon"]

    def bounds(res: Column, lo_v: Column, hi_v: Column, kmin: Column, kmax: Column):
        lo = F.greatest(F.floor((lo_v - res) / res), kmin)
        hi = F.least(F.ceil((hi_v + res) / res), kmax) - 1
        return lo, F.greatest(hi - lo + 1, F.lit(0))

    zero = F.lit(0).cast("bigint")
    lat_lo, n_lat = (bounds(res_lat, F.least(lat1, lat2), F.greatest(lat1, lat2),
                            p["lat_first"], p["lat_last"])
                     if "lat" in axes else (zero, zero))
    # the longitude candidate range always uses the shifted longitudes
    lon_lo, n_lon = (bounds(res_lon, F.least(slon1, slon2), F.greatest(slon1, slon2),
                            p["lon_first"], p["lon_last"])
                     if "lon" in axes else (zero, zero))
    # one integer sequence per segment: positions [0, n_lat) are latitude
    # lines, [n_lat, n_lat + n_lon) longitude lines
    x = (df.select("*", lat_lo.alias("_llo"), n_lat.alias("_nlat"), lon_lo.alias("_olo"),
                   (n_lat + n_lon).alias("_n"))
         .where(F.col("_n") > 0)
         .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("_i")))

    is_lat = F.col("_i") < F.col("_nlat")
    k = F.when(is_lat, F.col("_llo") + F.col("_i")).otherwise(F.col("_olo") + F.col("_i") - F.col("_nlat"))
    x = x.withColumn("_k", k)
    k = F.col("_k")
    line = k.cast("double") * F.when(is_lat, res_lat).otherwise(res_lon)
    x = x.withColumn("_line", line)
    line = F.col("_line")
    hit = F.when(is_lat, (lat1 != lat2) & (line >= F.least(lat1, lat2)) & (line <= F.greatest(lat1, lat2))
                 ).otherwise((glon1 != glon2) & (line >= F.least(glon1, glon2)) & (line <= F.greatest(glon1, glon2)))
    # divisors are non-zero wherever ``hit`` holds; nullif keeps ANSI mode quiet
    cross = F.when(is_lat, glon1 + (line - lat1) / F.nullif(lat2 - lat1, F.lit(0.0)) * (glon2 - glon1)
                   ).otherwise(lat1 + (line - glon1) / F.nullif(glon2 - glon1, F.lit(0.0)) * (lat2 - lat1))
    x = x.where(hit).withColumn("_cross", cross)
    cross = F.col("_cross")
    lim_lo = F.when(is_lat, p["lon_lo"]).otherwise(p["lat_lo"])
    lim_hi = F.when(is_lat, p["lon_hi"]).otherwise(p["lat_hi"])
    x = x.where((cross >= lim_lo) & (cross <= lim_hi))
    return x.select(
        "*",
        F.when(is_lat, F.lit("lat")).otherwise(F.lit("lon")).alias("axis"),
        F.when(is_lat, line).otherwise(cross).alias("cross_lat"),
        F.when(is_lat, cross).otherwise(line).alias("cross_lon"),
        F.when(is_lat, k).otherwise(F.floor(cross / res_lat)).alias("lat_idx"),
        F.when(is_lat, F.floor(cross / res_lon)).otherwise(k).alias("lon_idx"),
    ).drop("_llo", "_nlat", "_olo", "_n", "_i", "_k", "_line", "_cross")


def crossings(segments: DataFrame, grid: Grid | Sequence[Grid] = Grid(),
              temporal_split: str = "hour", dateline: str = "short_way",
              digits: str = "exact", origin_hit: str = "keep",
              with_sign: bool = False, axes: Sequence[str] = ("lat", "lon"), through: bool = False) -> DataFrame:
    """One row per (segment, grid line) crossing.

    Input: segments with ``id, alat, alon, blat, blon, adt, velocity_kmh``.
    Output: ``grid, axis, track_id, lat_idx, lon_idx, lat, lon, cross_lat,
    cross_lon, crossing_ts, dt, bucket_ts, velocity, direction`` (+ ``sign``);
    ``dt`` is the bucket as text, ``bucket_ts`` the same bucket as a timestamp.

    ``dateline``: ``short_way`` routes a segment over the antimeridian when
    its ends are more than 180 degrees apart; ``literal`` only shifts the
    candidate line range and keeps the long-way geometry (legacy result).
    ``digits``: ``exact`` labels cells by ``(idx + 0.5) * res``; ``reference``
    rounds to ``-round(ln(res))`` digits from the crossing point.
    ``origin_hit="drop"`` discards a hit exactly at (0, 0) (legacy).
    ``through=True`` (one grid only) also takes segments that cross the region
    with both ends outside.

    Several grids, up to thousands, are looked up by coarse cells (see
    ``grid_index``) and their parameters travel as columns, so the plan does
    not grow with their number.
    """
    if dateline not in DATELINE_MODES:
        raise ValueError(f"dateline must be one of {DATELINE_MODES}")
    if digits not in ("exact", "reference"):
        raise ValueError("digits must be 'exact' or 'reference'")
    grids = _grids(grid)
    if through and len(grids) > 1:
        raise ValueError("through=True takes one grid at a time")
    p = _Params(grids, digits)
    small_methods(segments.sparkSession)

    lon1, lon2 = F.col("alon"), F.col("blon")
    over = F.abs(lon1 - lon2) > 180
    base = segments.select(
        F.col("id").alias("track_id"), F.col("adt"),
        F.col("velocity_kmh").alias("velocity"),
        bearing_deg("alat", "alon", "blat", "blon").alias("direction"),
        F.col("alat").alias("lat1"), F.col("alon").alias("lon1"),
        F.col("blat").alias("lat2"), F.col("blon").alias("lon2"),
        F.when(over & (lon1 > lon2), lon1 - 360.0).otherwise(lon1).alias("slon1"),
        F.when(over & ~(lon1 > lon2), lon2 - 360.0).otherwise(lon2).alias("slon2"),
        "alat", "alon", "blat", "blon",
    )
    base = _with_grids(base, p, through).drop("alat", "alon", "blat", "blon")

    hits = _hits(base, p, axes, dateline)

    res_lat, res_lon, wrap = p["res_lat"], p["res_lon"], p["wrap"]
    if digits == "exact":
        lat_label = p.round((F.col("lat_idx") + 0.5) * res_lat, "lat_digits")
        lon_label = p.round((F.col("lon_idx") + 0.5) * res_lon, "lon_digits")
    else:
        def half(c: str, res: Column) -> Column:
            return F.col(c) - F.pmod(F.col(c), res) + res * 0.5
        lat_label = p.round(F.when(F.col("axis") == "lat", F.col("cross_lat") + res_lat * 0.5)
                            .otherwise(half("cross_lat", res_lat)), "lat_digits")
        lon_label = p.round(F.when(F.col("axis") == "lon", F.col("cross_lon") + res_lon * 0.5)
                            .otherwise(half("cross_lon", res_lon)), "lon_digits")

    hits = hits.withColumn("lat", lat_label).withColumn("_lon0", lon_label)
    rewrap = F.col("_lon0") < -180
    hits = (hits.withColumn("lon", F.when(rewrap, F.col("_lon0") + 360.0).otherwise(F.col("_lon0")))
            .withColumn("lon_idx", F.when(rewrap, F.col("lon_idx") + wrap).otherwise(F.col("lon_idx"))))
    if origin_hit == "drop":
        hits = hits.where(~((F.col("cross_lat") == 0) & (F.col("cross_lon") == 0)))

    # crossing time: start + distance(start -> cell centre) / velocity
    dist = haversine_km(F.col("lat1"), F.col("slon1"), F.col("lat"), F.col("lon"))
    secs = F.round((dist / F.col("velocity")) * 60 * 60).cast("bigint")
    cts = F.when(F.col("velocity") > MIN_INTERPOLATION_SPEED,
                 F.timestamp_seconds(F.unix_timestamp("adt") + secs)).otherwise(F.col("adt"))
    hits = hits.withColumn("crossing_ts", cts)

    cols = [F.col("grid"), F.col("axis"), F.col("track_id"),
            F.col("lat_idx").cast("bigint").alias("lat_idx"),
            F.col("lon_idx").cast("bigint").alias("lon_idx"),
            F.col("lat"), F.col("lon"), F.col("cross_lat"), F.col("cross_lon"),
            F.col("crossing_ts"), temporal_bucket(F.col("crossing_ts"), temporal_split).alias("dt"),
            bucket_start(F.col("crossing_ts"), temporal_split).alias("bucket_ts"),
            F.col("velocity"), F.col("direction")]
    if with_sign:
        glon1 = F.col("slon1") if dateline == "short_way" else F.col("lon1")
        glon2 = F.col("slon2") if dateline == "short_way" else F.col("lon2")
        south_on_meridian = (glon1 == glon2) & (F.col("lat1") > F.col("lat2"))
        cols.append(F.when(south_on_meridian | (glon1 > glon2), F.lit(-1)).otherwise(F.lit(1)).alias("sign"))
    return hits.select(*cols)

