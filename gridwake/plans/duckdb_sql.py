"""Independent SQL formulations of the registered queries, for checking the
Spark results with DuckDB on the same parquet tables.

Each query restates the operator's rules in plain SQL (window ``lag`` for
the consecutive rule, a recursive CTE for the anchored rule,
``generate_series`` + ``unnest`` for crossings and rasters). Arithmetic is
written in the same order as the Spark expressions and every decimal
literal is cast to DOUBLE, so both engines do the same IEEE operations.
"""

from __future__ import annotations

import math

from ..config import (ALL_TIME_LABEL, COORD_TOLERANCE, MERCATOR_MAX_LAT,
                      MIN_INTERPOLATION_SPEED, TEMPORAL_SPLITS, Grid, label_digits)
from . import catalog as C


def d(x: float) -> str:
    """A DOUBLE literal."""
    if math.isinf(x):
        return "CAST('inf' AS DOUBLE)" if x > 0 else "CAST('-inf' AS DOUBLE)"
    return f"CAST({float(x)!r} AS DOUBLE)"


def r6(x: str) -> str:
    return f"(CASE WHEN abs({x}) < 1e12 THEN floor(({x}) * 1e6 + 0.5) / 1e6 ELSE ({x}) END)"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _wrap(a: str, b: str) -> tuple[str, str]:
    b2 = f"(CASE WHEN ({a} < -90 AND {b} > 90) THEN {b} - {d(360)} ELSE {b} END)"
    a2 = f"(CASE WHEN (NOT ({a} < -90 AND {b} > 90)) AND {b} < -90 AND {a} > 90 THEN {a} - {d(360)} ELSE {a} END)"
    return a2, b2


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    la1, la2 = _wrap(lat1, lat2)
    lo1, lo2 = _wrap(lon1, lon2)
    dlat = f"radians({la2} - {la1})"
    dlon = f"radians({lo2} - {lo1})"
    a = (f"(sin({dlat} / 2) * sin({dlat} / 2) + cos(radians({la1})) * cos(radians({la2}))"
         f" * sin({dlon} / 2) * sin({dlon} / 2))")
    a = f"least(greatest({a}, {d(0)}), {d(1)})"
    return f"({d(6371.0)} * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def hav_nan(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The distance, NaN where a coordinate is NaN (the engine orders NaN
    above all numbers, so comparisons alone would not show it)."""
    bad = " OR ".join(f"isnan({c})" for c in (lat1, lon1, lat2, lon2))
    return f"(CASE WHEN {bad} THEN CAST('nan' AS DOUBLE) ELSE {hav(lat1, lon1, lat2, lon2)} END)"


def bearing(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    r1, r2 = f"radians({lat1})", f"radians({lat2})"
    dl = f"radians({lon2} - {lon1})"
    b = f"atan2(sin({dl}) * cos({r2}), cos({r1}) * sin({r2}) - sin({r1}) * cos({r2}) * cos({dl}))"
    x = f"(degrees({b}) + {d(360)})"
    return f"(CASE WHEN ({x} % {d(360)}) < 0 THEN (({x} % {d(360)}) + {d(360)}) % {d(360)} ELSE {x} % {d(360)} END)"


def pmod(x: str, n: float) -> str:
    return f"(CASE WHEN ({x} % {d(n)}) < 0 THEN (({x} % {d(n)}) + {d(n)}) % {d(n)} ELSE {x} % {d(n)} END)"


def bucket(t: str, split: str) -> str:
    name = split.lower()
    if name == "all":
        return f"(CASE WHEN {t} IS NOT NULL THEN '{ALL_TIME_LABEL}' END)"
    if name in ("year", "month", "day", "hour", "minute"):
        return ts(f"date_trunc('{name}', {t})")
    if name == "10min":
        return ts(f"(date_trunc('hour', {t}) + to_minutes(CAST(floor(minute({t}) / 10) AS BIGINT) * 10))")
    return ts(f"date_trunc('second', {t})")


POINTS = f"""
pts AS (
  SELECT CAST(user_id AS VARCHAR) AS id, date_trunc('second', ts) AS dt, ts AS raw_ts,
         {d(35.0)} + (user_id % 10) * 2 + value / {d(100.0)} AS lat,
         CASE WHEN l >= 180.0 THEN l - {d(360.0)} ELSE l END AS lon
  FROM (SELECT *, {d(-180.0)} + (user_id * 37) % 360
                 + (CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS BIGINT) * 5309 + 137) / {d(100000.0)} AS l
        FROM events) e
)"""


def consecutive(limits, src: str = "pts", name: str = "segc") -> str:
    inc = bool(limits.inclusive)
    lt = "<=" if inc else "<"
    vel = (f" AND velocity_kmh {lt} {d(limits.velocity_kmh)}" if limits.velocity_kmh >= 0 else "")
    return f"""
{name}_pair AS (
  SELECT id, lag(dt) OVER w AS adt, lag(lat) OVER w AS alat, lag(lon) OVER w AS alon,
         dt AS bdt, lat AS blat, lon AS blon
  FROM {src} WINDOW w AS (PARTITION BY id ORDER BY dt, lat, lon)
),
{name}_m AS (
  SELECT *, CAST(epoch(bdt) - epoch(adt) AS DOUBLE) AS time_s, {hav('alat', 'alon', 'blat', 'blon')} AS distance_km
  FROM {name}_pair WHERE adt IS NOT NULL
),
{name}_v AS (
  SELECT *, CASE WHEN time_s = 0 THEN {d(math.inf)} ELSE distance_km / (time_s / {d(3600.0)}) END AS velocity_kmh
  FROM {name}_m
),
{name} AS (
  SELECT id, alat, alon, blat, blon, adt, bdt, time_s, distance_km, velocity_kmh FROM {name}_v
  WHERE distance_km > 0 AND distance_km {lt} {d(limits.distance_km)} AND time_s {lt} {d(limits.time_s)}{vel}
)"""


def anchored(limits, src: str = "pts", name: str = "sega") -> str:
    inc = True if limits.inclusive is None else bool(limits.inclusive)
    le = "<=" if inc else "<"
    return f"""
{name}_o AS (
  SELECT id, dt, lat, lon, row_number() OVER (PARTITION BY id ORDER BY dt, lat, lon) AS rn FROM {src}
),
{name}_chain AS (
  SELECT id, rn, dt, lat, lon, CAST(NULL AS TIMESTAMP) AS adt, CAST(NULL AS DOUBLE) AS alat,
         CAST(NULL AS DOUBLE) AS alon
  FROM {name}_o WHERE rn = 1
  UNION ALL
  SELECT c.id, n.rn, n.dt, n.lat, n.lon, c.dt, c.lat, c.lon
  FROM {name}_chain c JOIN LATERAL (
    SELECT o.rn, o.dt, o.lat, o.lon FROM {name}_o o
    WHERE o.id = c.id AND o.rn > c.rn AND {hav('c.lat', 'c.lon', 'o.lat', 'o.lon')} {le} {d(limits.distance_km)}
    ORDER BY o.rn LIMIT 1) n ON TRUE
  WHERE CAST(epoch(n.dt) - epoch(c.dt) AS DOUBLE) {le} {d(limits.time_s)}
),
{name}_m AS (
  SELECT id, alat, alon, lat AS blat, lon AS blon, adt, dt AS bdt,
         CAST(epoch(dt) - epoch(adt) AS DOUBLE) AS time_s, {hav('alat', 'alon', 'lat', 'lon')} AS distance_km
  FROM {name}_chain WHERE adt IS NOT NULL AND abs(alat - lat) + abs(alon - lon) > 0
),
{name} AS (
  SELECT *, CASE WHEN time_s = 0 THEN {d(-1.0)} ELSE distance_km / (time_s / {d(3600.0)}) END AS velocity_kmh
  FROM {name}_m
)"""


def _region_ok(g: Grid) -> str:
    r, t = g.region, COORD_TOLERANCE
    la0, la1 = min(r.lat_min, r.lat_max) - t, max(r.lat_min, r.lat_max) + t
    lo0, lo1 = min(r.lon_min, r.lon_max) - t, max(r.lon_min, r.lon_max) + t
    return (f"((alat BETWEEN {d(la0)} AND {d(la1)} AND alon BETWEEN {d(lo0)} AND {d(lo1)}) OR "
            f"(blat BETWEEN {d(la0)} AND {d(la1)} AND blon BETWEEN {d(lo0)} AND {d(lo1)}))")


def crossings(seg: str, g: Grid, name: str, split: str = "hour", dateline: str = "short_way",
              digits: str = "exact", origin_hit: str = "keep", axes=("lat", "lon")) -> str:
    """CTE ``name`` with one row per crossing (same columns as the Spark operator)."""
    g1, g2 = ("slon1", "slon2") if dateline == "short_way" else ("lon1", "lon2")
    rl, rn = d(g.res_lat), d(g.res_lon)
    parts = []
    if "lat" in axes:
        parts.append(f"""
  SELECT b.*, 'lat' AS axis, k, CAST(k AS DOUBLE) * {rl} AS line FROM (
    SELECT *, greatest(CAST(floor((least(lat1, lat2) - {rl}) / {rl}) AS BIGINT), {g.lat_index_min}) AS lo,
              least(CAST(ceil((greatest(lat1, lat2) + {rl}) / {rl}) AS BIGINT), {g.lat_index_max}) - 1 AS hi
    FROM {name}_b) b, generate_series(b.lo, b.hi) AS s(k) WHERE b.lo <= b.hi""")
    if "lon" in axes:
        parts.append(f"""
  SELECT b.*, 'lon' AS axis, k, CAST(k AS DOUBLE) * {rn} AS line FROM (
    SELECT *, greatest(CAST(floor((least(slon1, slon2) - {rn}) / {rn}) AS BIGINT), {g.lon_index_min}) AS lo,
              least(CAST(ceil((greatest(slon1, slon2) + {rn}) / {rn}) AS BIGINT), {g.lon_index_max}) - 1 AS hi
    FROM {name}_b) b, generate_series(b.lo, b.hi) AS s(k) WHERE b.lo <= b.hi""")
    cand = " UNION ALL ".join(parts)
    r = g.region
    lon_lo, lon_hi = d(min(r.lon_min, r.lon_max)), d(max(r.lon_min, r.lon_max))
    lat_lo, lat_hi = d(min(r.lat_min, r.lat_max)), d(max(r.lat_min, r.lat_max))
    if digits == "exact":
        dl, dn = label_digits(g.res_lat), label_digits(g.res_lon)
        lat_lab = f"round((lat_idx + {d(0.5)}) * {rl}, {dl})"
        lon_lab = f"round((lon_idx + {d(0.5)}) * {rn}, {dn})"
    else:
        dl, dn = label_digits(g.res_lat, "reference"), label_digits(g.res_lon, "reference")
        hl, hn = d(g.res_lat * 0.5), d(g.res_lon * 0.5)
        lat_lab = (f"(CASE WHEN axis = 'lat' THEN round(cross_lat + {hl}, {dl}) "
                   f"ELSE round(cross_lat - {pmod('cross_lat', g.res_lat)} + {hl}, {dl}) END)")
        lon_lab = (f"(CASE WHEN axis = 'lon' THEN round(cross_lon + {hn}, {dn}) "
                   f"ELSE round(cross_lon - {pmod('cross_lon', g.res_lon)} + {hn}, {dn}) END)")
    origin = " AND NOT (cross_lat = 0 AND cross_lon = 0)" if origin_hit == "drop" else ""
    dist = hav("lat1", "slon1", "lat", "lon")
    return f"""
{name}_b AS (
  SELECT id AS track_id, adt, velocity_kmh AS velocity, {bearing('alat', 'alon', 'blat', 'blon')} AS direction,
         alat AS lat1, alon AS lon1, blat AS lat2, blon AS lon2,
         CASE WHEN abs(alon - blon) > 180 AND alon > blon THEN alon - {d(360)} ELSE alon END AS slon1,
         CASE WHEN abs(alon - blon) > 180 AND NOT (alon > blon) THEN blon - {d(360)} ELSE blon END AS slon2
  FROM {seg} WHERE {_region_ok(g)}
),
{name}_c AS ({cand}
),
{name}_h AS (
  SELECT *, CASE WHEN axis = 'lat' THEN {g1} + (line - lat1) / (lat2 - lat1) * ({g2} - {g1})
                 ELSE lat1 + (line - {g1}) / ({g2} - {g1}) * (lat2 - lat1) END AS crs
  FROM {name}_c
  WHERE CASE WHEN axis = 'lat' THEN lat1 <> lat2 AND line >= least(lat1, lat2) AND line <= greatest(lat1, lat2)
             ELSE {g1} <> {g2} AND line >= least({g1}, {g2}) AND line <= greatest({g1}, {g2}) END
),
{name}_i AS (
  SELECT track_id, adt, velocity, direction, lat1, slon1, lon1, lon2, slon2, lat2, axis,
         CASE WHEN axis = 'lat' THEN line ELSE crs END AS cross_lat,
         CASE WHEN axis = 'lat' THEN crs ELSE line END AS cross_lon,
         CASE WHEN axis = 'lat' THEN k ELSE CAST(floor(crs / {rl}) AS BIGINT) END AS lat_idx,
         CASE WHEN axis = 'lat' THEN CAST(floor(crs / {rn}) AS BIGINT) ELSE k END AS lon_idx
  FROM {name}_h
  WHERE CASE WHEN axis = 'lat' THEN crs >= {lon_lo} AND crs <= {lon_hi} ELSE crs >= {lat_lo} AND crs <= {lat_hi} END
),
{name}_l AS (
  SELECT *, {lat_lab} AS lat, {lon_lab} AS lon0 FROM {name}_i
),
{name}_w AS (
  SELECT *, CASE WHEN lon0 < -180 THEN lon0 + {d(360)} ELSE lon0 END AS lon,
         CASE WHEN lon0 < -180 THEN lon_idx + {g.lon_wrap_cells} ELSE lon_idx END AS lon_idx2
  FROM {name}_l WHERE TRUE{origin}
),
{name}_t AS (
  SELECT *, CASE WHEN velocity > {d(MIN_INTERPOLATION_SPEED)}
                 THEN adt + to_seconds(CAST(round(({dist} / velocity) * 60 * 60) AS BIGINT)) ELSE adt END AS crossing_ts
  FROM {name}_w
),
{name} AS (
  SELECT '{g.name}' AS grid, axis, track_id, lat_idx, lon_idx2 AS lon_idx, lat, lon, cross_lat, cross_lon,
         crossing_ts, {bucket('crossing_ts', split)} AS dt, velocity, direction,
         CASE WHEN ({g1} = {g2} AND lat1 > lat2) OR {g1} > {g2} THEN -1 ELSE 1 END AS sign
  FROM {name}_t
)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(c.strip("\n") for c in ctes)


SEG_OUT = (f"id, alat, alon, blat, blon, {ts('adt')} AS adt, {ts('bdt')} AS bdt, time_s, "
           f"{r6('distance_km')} AS distance_km, {r6('velocity_kmh')} AS velocity_kmh")


def crossing_out(x: str, sign: bool = False) -> str:
    s = ", sign" if sign else ""
    return (f"SELECT grid, track_id, axis, lat_idx, lon_idx, lat, lon, {r6('cross_lat')} AS cross_lat, "
            f"{r6('cross_lon')} AS cross_lon, {ts('crossing_ts')} AS crossing_ts, dt, {r6('velocity')} AS velocity, "
            f"{r6('direction')} AS direction{s} FROM {x}")


def cells(x: str, name: str = "cells") -> str:
    return f"""
{name} AS (
  SELECT grid, lat_idx, lon_idx, any_value(lat) AS lat, any_value(lon) AS lon, dt, count(*) AS value,
         avg(velocity) AS velocity, CAST(trunc(avg(direction)) AS INTEGER) AS direction
  FROM {x} GROUP BY grid, lat_idx, lon_idx, dt
)"""


def mercator_pixel(lat: str, lon: str, level: str) -> tuple[str, str]:
    n = f"(pow({d(2.0)}, CAST({level} AS DOUBLE)) * {d(256.0)})"
    phi = f"radians(least(greatest({lat}, {d(-MERCATOR_MAX_LAT)}), {d(MERCATOR_MAX_LAT)}))"
    fx = f"(({lon} + {d(180.0)}) / {d(360.0)})"
    fy = f"({d(0.5)} + ln(tan({d(math.pi / 4)} + {phi} / 2)) / {d(2 * math.pi)})"
    top = f"(CAST({n} AS BIGINT) - 1)"
    px = f"least(greatest(CAST(floor({fx} * {n}) AS BIGINT), 0), {top})"
    py = f"least(greatest(CAST(floor({fy} * {n}) AS BIGINT), 0), {top})"
    return px, py


def raster(seg: str, levels: str, name: str, plane_offset: int = 0, precision: str = "exact",
           decay: tuple[float, float] | None = None) -> str:
    ax, ay = mercator_pixel("alat", "alon", "level")
    bx, by = mercator_pixel("blat", "blon", "level")
    where = ""
    if decay is not None:
        dec, lim = decay
        where = f" WHERE velocity_kmh < pow({d(dec)}, level - 1) * {d(lim)}"
    if precision == "exact":
        yline = "((s - x1) * (y2 - y1) + y1 * (x2 - x1)) // (x2 - x1)"
    else:
        rise, run = "CAST(y2 - y1 AS FLOAT)", "CAST(x2 - x1 AS FLOAT)"
        b = (f"CAST(CAST(y1 AS FLOAT) - CAST(CAST(CAST(x1 AS FLOAT) * {rise} AS FLOAT) / {run} AS FLOAT) AS FLOAT)")
        yline = (f"CAST(trunc(CAST(CAST(CAST(CAST(s AS FLOAT) * {rise} AS FLOAT) / {run} AS FLOAT) + {b} AS FLOAT)) AS BIGINT)")
    return f"""
{name}_p AS (
  SELECT level, CAST(pow({d(2.0)}, CAST(level AS DOUBLE)) * 256 AS BIGINT) AS world,
         {ax} AS x1, {ay} + {plane_offset} AS y1, {bx} AS x2, {by} + {plane_offset} AS y2
  FROM (SELECT s.*, lv.level FROM {seg} s, ({levels}) lv(level)){where}
),
{name}_w AS (
  SELECT level, world,
    CASE WHEN abs(x1 - x2) > world * 0.5 AND x1 > x2 THEN x1 - world ELSE x1 END AS x1,
    CASE WHEN abs(y1 - y2) > world * 0.5 AND y1 > y2 THEN y1 - world ELSE y1 END AS y1,
    CASE WHEN abs(x1 - x2) > world * 0.5 AND NOT (x1 > x2) THEN x2 - world ELSE x2 END AS x2,
    CASE WHEN abs(y1 - y2) > world * 0.5 AND NOT (y1 > y2) THEN y2 - world ELSE y2 END AS y2
  FROM {name}_p
),
{name}_e AS (
  SELECT level, world, x1, y1, x2, y2, s
  FROM {name}_w, generate_series(CASE WHEN x2 = x1 THEN least(y1, y2) ELSE least(x1, x2) END,
                                 CASE WHEN x2 = x1 THEN greatest(y1, y2) ELSE greatest(x1, x2) END) AS g(s)
),
{name}_xy AS (
  SELECT level, world, CASE WHEN x2 = x1 THEN x1 ELSE s END AS x,
         CASE WHEN x2 = x1 THEN s ELSE {yline} END AS y
  FROM {name}_e
),
{name} AS (
  SELECT CAST(level AS INTEGER) AS level,
         CAST(floor((CASE WHEN x < 0 THEN x + world ELSE x END) / 256.0) AS BIGINT) AS tile_x,
         CAST(floor((CASE WHEN y < 0 THEN y + world ELSE y END) / 256.0) AS BIGINT) AS tile_y,
         CAST((CASE WHEN x < 0 THEN x + world ELSE x END) % 256 AS BIGINT) AS bin_x,
         CAST(255 - (CASE WHEN y < 0 THEN y + world ELSE y END) % 256 AS BIGINT) AS bin_y
  FROM {name}_xy
)"""


def _levels(n: int) -> str:
    return f"SELECT * FROM generate_series(1, {n})"


def build() -> dict[str, str]:
    Q: dict[str, str] = {}
    segc = consecutive(C.LIMITS_CONSECUTIVE)
    base_c = [POINTS, segc]

    Q["normalise_positions"] = with_(POINTS) + f" SELECT id, {ts('date_trunc(\'minute\', dt)')} AS dt, lat, lon FROM pts"
    Q["text_points"] = with_(POINTS) + f" SELECT id, {ts('dt')} AS dt, lat, lon FROM pts"
    r, t = C.POINT_REGION, COORD_TOLERANCE
    Q["region_points"] = with_(POINTS) + (
        f" SELECT id, {ts('dt')} AS dt, lat, lon FROM pts WHERE lat BETWEEN {d(r.lat_min - t)} AND {d(r.lat_max + t)}"
        f" AND lon BETWEEN {d(r.lon_min - t)} AND {d(r.lon_max + t)}")
    Q["segments_consecutive"] = with_(*base_c) + f" SELECT {SEG_OUT} FROM segc"
    Q["segments_velocity"] = with_(POINTS, consecutive(C.LIMITS_VELOCITY, name="segv")) + f" SELECT {SEG_OUT} FROM segv"
    sega = anchored(C.LIMITS_ANCHORED)
    Q["segments_anchored"] = with_(POINTS, sega) + f" SELECT {SEG_OUT} FROM sega"
    Q["segments_region"] = with_(*base_c) + f" SELECT {SEG_OUT} FROM segc WHERE {_region_ok(Grid(1.0, 1.0, C.SEGMENT_REGION))}"
    Q["segment_bearing"] = with_(*base_c) + (
        f" SELECT id, {ts('adt')} AS adt, {ts('bdt')} AS bdt, {r6(bearing('alat', 'alon', 'blat', 'blon'))} AS bearing FROM segc")
    Q["segment_count_by_id"] = with_(*base_c) + " SELECT id, count(*) AS n_segments FROM segc GROUP BY id"
    Q["segment_count"] = with_(POINTS, sega) + " SELECT count(*) AS n_segments FROM sega"

    fine = crossings("segc", C.GRID_FINE, "xf")
    Q["crossings_lat"] = with_(*base_c, crossings("segc", C.GRID_FINE, "xl", axes=("lat",))) + " " + crossing_out("xl")
    Q["crossings_lon"] = with_(*base_c, crossings("segc", C.GRID_FINE, "xo", axes=("lon",))) + " " + crossing_out("xo")
    Q["crossings_all"] = with_(*base_c, fine) + " " + crossing_out("xf", sign=True)
    Q["crossings_short_way"] = with_(*base_c, crossings("segc", C.GRID_COARSE, "xs", split="day")) + " " + crossing_out("xs")
    Q["crossings_literal"] = with_(*base_c, crossings("segc", C.GRID_COARSE, "xq", split="day", dateline="literal",
                                                      digits="reference", origin_hit="drop")) + " " + crossing_out("xq")
    Q["crossing_time"] = with_(POINTS, sega, crossings("sega", C.GRID_COARSE, "xt", split="minute")) + (
        f" SELECT track_id, axis, lat_idx, lon_idx, {ts('crossing_ts')} AS crossing_ts, dt FROM xt")
    bcols = ", ".join(f"{bucket('dt', s)} AS b_{s}" for s in TEMPORAL_SPLITS)
    Q["temporal_buckets"] = with_(POINTS) + (
        f" SELECT id, {ts('dt')} AS dt, {bcols}, {bucket('dt', 'Hour')} AS b_hour_mixed_case, "
        f"{bucket('dt', 'week')} AS b_other FROM pts")

    cell_ctes = [*base_c, fine, cells("xf")]
    out = "lat_idx, lon_idx, lat, lon, dt"
    Q["cell_counts"] = with_(*cell_ctes) + f" SELECT {out}, value FROM cells"
    Q["cell_velocity"] = with_(*cell_ctes) + f" SELECT {out}, {r6('velocity')} AS velocity FROM cells"
    Q["cell_direction"] = with_(*cell_ctes) + f" SELECT {out}, direction FROM cells"
    Q["cell_stats"] = with_(*cell_ctes) + f" SELECT {out}, value, {r6('velocity')} AS velocity, direction FROM cells"
    Q["cell_track_ids"] = with_(*base_c, fine) + (
        f" SELECT lat_idx, lon_idx, any_value(lat) AS lat, any_value(lon) AS lon, dt,"
        f" count(DISTINCT track_id) AS n_tracks, string_agg(DISTINCT track_id, ',' ORDER BY track_id) AS ids"
        f" FROM xf GROUP BY grid, lat_idx, lon_idx, dt")
    g1, g2 = C.MULTI_GRIDS
    Q["multi_grid_counts"] = with_(*base_c, crossings("segc", g1, "xm1", split="day"),
                                   crossings("segc", g2, "xm2", split="day"),
                                   "xm AS (SELECT * FROM xm1 UNION ALL SELECT * FROM xm2)", cells("xm", "mcells")) + (
        f" SELECT grid, {out}, value FROM mcells")

    Q["cell_track_id_parts"] = with_(*base_c, crossings("segc", C.GRID_COARSE, "xa", split="all"), """
tk AS (SELECT grid, lat_idx, lon_idx, any_value(lat) AS lat, any_value(lon) AS lon, dt, track_id
       FROM xa GROUP BY grid, lat_idx, lon_idx, dt, track_id)""", """
tn AS (SELECT *, (row_number() OVER (PARTITION BY lat_idx, lon_idx, dt ORDER BY track_id) - 1) // 7 AS part,
              count(*) OVER (PARTITION BY lat_idx, lon_idx, dt) AS n_tracks FROM tk)""") + (
        " SELECT lat_idx, lon_idx, min(lat) AS lat, min(lon) AS lon, dt, part, (n_tracks + 6) // 7 AS n_parts, n_tracks,"
        " string_agg(track_id, ',' ORDER BY track_id) AS ids FROM tn GROUP BY lat_idx, lon_idx, dt, part, n_tracks")
    # crossings of many grids in one statement: the limits of a segment's grid stand in columns
    many = f"""
mg AS (
  SELECT 'g' || i AS grid, {d(34)} + (i % 50) * {d(0.4)} AS la0, {d(34)} + (i % 50) * {d(0.4)} + {d(2)} AS la1,
         {d(-180)} + (i // 50) * {d(9)} AS lo0, least({d(-180)} + (i // 50) * {d(9)} + {d(4)}, {d(180)}) AS lo1,
         CASE WHEN i % 2 = 1 THEN {d(0.5)} ELSE {d(0.25)} END AS res FROM range(2000) r(i)
)""" + f""",
mb AS (
  SELECT s.id AS track_id, s.adt, s.velocity_kmh AS velocity, s.alat AS lat1, s.alon AS lon1, s.blat AS lat2, s.blon AS lon2,
         CASE WHEN abs(alon - blon) > 180 AND alon > blon THEN alon - {d(360)} ELSE alon END AS g1,
         CASE WHEN abs(alon - blon) > 180 AND NOT (alon > blon) THEN blon - {d(360)} ELSE blon END AS g2, mg.*
  FROM segc s JOIN mg ON (alat BETWEEN la0 - {d(COORD_TOLERANCE)} AND la1 + {d(COORD_TOLERANCE)}
                          AND alon BETWEEN lo0 - {d(COORD_TOLERANCE)} AND lo1 + {d(COORD_TOLERANCE)})
                      OR (blat BETWEEN la0 - {d(COORD_TOLERANCE)} AND la1 + {d(COORD_TOLERANCE)}
                          AND blon BETWEEN lo0 - {d(COORD_TOLERANCE)} AND lo1 + {d(COORD_TOLERANCE)})
)""" + f""",
mk AS (
  SELECT b.*, 'lat' AS axis, k, CAST(k AS DOUBLE) * res AS line FROM (
    SELECT *, greatest(CAST(floor((least(lat1, lat2) - res) / res) AS BIGINT), CAST(floor(la0 / res) AS BIGINT)) AS lo,
           least(CAST(ceil((greatest(lat1, lat2) + res) / res) AS BIGINT), CAST(ceil(la1 / res) AS BIGINT)) - 1 AS hi FROM mb) b,
    generate_series(b.lo, b.hi) AS s(k) WHERE b.lo <= b.hi
  UNION ALL
  SELECT b.*, 'lon' AS axis, k, CAST(k AS DOUBLE) * res AS line FROM (
    SELECT *, greatest(CAST(floor((least(g1, g2) - res) / res) AS BIGINT), CAST(floor(lo0 / res) AS BIGINT)) AS lo,
           least(CAST(ceil((greatest(g1, g2) + res) / res) AS BIGINT), CAST(ceil(lo1 / res) AS BIGINT)) - 1 AS hi FROM mb) b,
    generate_series(b.lo, b.hi) AS s(k) WHERE b.lo <= b.hi
)""" + f""",
mh AS (
  SELECT *, CASE WHEN axis = 'lat' THEN g1 + (line - lat1) / (lat2 - lat1) * (g2 - g1)
                 ELSE lat1 + (line - g1) / (g2 - g1) * (lat2 - lat1) END AS crs
  FROM mk WHERE CASE WHEN axis = 'lat' THEN lat1 <> lat2 AND line >= least(lat1, lat2) AND line <= greatest(lat1, lat2)
                     ELSE g1 <> g2 AND line >= least(g1, g2) AND line <= greatest(g1, g2) END
)""" + f""",
mi AS (
  SELECT *, CASE WHEN axis = 'lat' THEN k ELSE CAST(floor(crs / res) AS BIGINT) END AS lat_idx,
         CASE WHEN axis = 'lat' THEN CAST(floor(crs / res) AS BIGINT) ELSE k END AS lon_idx0
  FROM mh WHERE CASE WHEN axis = 'lat' THEN crs >= lo0 AND crs <= lo1 ELSE crs >= la0 AND crs <= la1 END
)""" + f""",
ml AS (
  SELECT *, CASE WHEN res = 0.5 THEN round((lat_idx + {d(0.5)}) * res, {label_digits(0.5)})
                 ELSE round((lat_idx + {d(0.5)}) * res, {label_digits(0.25)}) END AS lat,
         CASE WHEN res = 0.5 THEN round((lon_idx0 + {d(0.5)}) * res, {label_digits(0.5)})
              ELSE round((lon_idx0 + {d(0.5)}) * res, {label_digits(0.25)}) END AS lon0 FROM mi
)""" + f""",
mw AS (
  SELECT *, CASE WHEN lon0 < -180 THEN lon0 + {d(360)} ELSE lon0 END AS lon,
         CASE WHEN lon0 < -180 THEN lon_idx0 + CAST(round({d(360)} / res) AS BIGINT) ELSE lon_idx0 END AS lon_idx FROM ml
)""" + f""",
mt AS (
  SELECT *, CASE WHEN velocity > {d(MIN_INTERPOLATION_SPEED)}
                 THEN adt + to_seconds(CAST(round(({hav('lat1', 'g1', 'lat', 'lon')} / velocity) * 60 * 60) AS BIGINT))
                 ELSE adt END AS crossing_ts FROM mw
)"""
    Q["multi_grid_index"] = with_(*base_c, many) + (
        f" SELECT grid, lat_idx, lon_idx, any_value(lat) AS lat, any_value(lon) AS lon, {bucket('crossing_ts', 'day')} AS dt,"
        f" count(*) AS value FROM mt GROUP BY grid, lat_idx, lon_idx, {bucket('crossing_ts', 'day')}")
    # the point of the segment nearest to the region's middle line, by its share of the way
    r, t = C.THROUGH_REGION, COORD_TOLERANCE
    share = """SELECT *, CASE WHEN {a} = {b} THEN CASE WHEN {a} BETWEEN {lo} AND {hi} THEN {zero} ELSE {two} END
                 ELSE least(({lo} - {a}) / ({b} - {a}), ({hi} - {a}) / ({b} - {a})) END AS {n}_in,
       CASE WHEN {a} = {b} THEN CASE WHEN {a} BETWEEN {lo} AND {hi} THEN {one} ELSE {less} END
            ELSE greatest(({lo} - {a}) / ({b} - {a}), ({hi} - {a}) / ({b} - {a})) END AS {n}_out FROM {src}"""
    numbers = dict(zero=d(0), one=d(1), two=d(2), less=d(-1))
    Q["segments_through_region"] = with_(*base_c, f"""
tr0 AS (
  SELECT s.*, CASE WHEN abs(alon - blon) > 180 AND alon > blon THEN alon - {d(360)} ELSE alon END + turn AS w,
         CASE WHEN abs(alon - blon) > 180 AND NOT (alon > blon) THEN blon - {d(360)} ELSE blon END + turn AS e
  FROM segc s, (VALUES ({d(0)}), ({d(360)})) v(turn)
)""", "tr1 AS (" + share.format(a="alat", b="blat", lo=d(r.lat_min - t), hi=d(r.lat_max + t), n="y", src="tr0", **numbers) + ")",
        "tr2 AS (" + share.format(a="w", b="e", lo=d(r.lon_min - t), hi=d(r.lon_max + t), n="x", src="tr1", **numbers) + ")") + (
        f" SELECT DISTINCT {SEG_OUT} FROM tr2 WHERE greatest({d(0)}, y_in, x_in) <= least({d(1)}, y_out, x_out)")

    px, py = mercator_pixel("lat", "lon", "level")
    Q["mercator_bins"] = with_(POINTS, f"mp AS (SELECT id, dt, level, {px} AS px, {py} AS py FROM pts, "
                                       f"({_levels(C.MAX_LEVEL)}) lv(level))") + (
        f" SELECT id, {ts('dt')} AS dt, CAST(level AS INTEGER) AS level, px, py, CAST(floor(px / 256.0) AS BIGINT) AS tile_x,"
        f" CAST(floor(py / 256.0) AS BIGINT) AS tile_y, px % 256 AS bin_x, 255 - py % 256 AS bin_y FROM mp")
    rast = raster("segc", _levels(C.MAX_LEVEL), "bh")
    Q["bin_hits"] = with_(*base_c, rast) + " SELECT * FROM bh"
    counts = "SELECT level, tile_x, tile_y, bin_x, bin_y, count(*) AS value FROM bh GROUP BY ALL"
    Q["bin_counts"] = with_(*base_c, rast) + " " + counts
    Q["bin_counts_pyramid"] = with_(*base_c, rast, f"bc AS ({counts})") + (
        " SELECT level, tile_x, tile_y, count(*) AS n_bins, sum(value) AS hits FROM bc GROUP BY ALL")
    Q["bin_counts_decay"] = with_(*base_c, raster("segc", _levels(3), "bd", decay=(0.5, 500.0))) + (
        " SELECT level, tile_x, tile_y, bin_x, bin_y, count(*) AS value FROM bd GROUP BY ALL")
    Q["dense_tiles_summary"] = with_(*base_c, rast, f"bc AS ({counts})") + (
        " SELECT level, tile_x, tile_y, CAST(65536 AS BIGINT) AS n_slots, CAST(sum(value) AS DOUBLE) AS total,"
        " count(*) AS nonzero, CAST(sum(value * (bin_x + bin_y * 256 + 1)) AS DOUBLE) AS checksum FROM bc GROUP BY ALL")

    pipe_x = crossings("sega", C.GRID_FINE, "xp", split="hour", dateline="literal", digits="reference",
                       origin_hit="drop")
    Q["pipeline_tripline"] = with_(POINTS, sega, pipe_x) + " SELECT lat, lon, dt, count(*) AS value FROM xp GROUP BY lat, lon, dt"
    mr = C.legacy_mercator_options().region
    t = COORD_TOLERANCE
    mpts = (f"mpts AS (SELECT * FROM pts WHERE lat BETWEEN {d(mr.lat_min - t)} AND {d(mr.lat_max + t)} "
            f"AND lon BETWEEN {d(mr.lon_min - t)} AND {d(mr.lon_max + t)})")
    Q["pipeline_mercator"] = with_(POINTS, mpts, consecutive(C.LIMITS_CONSECUTIVE, src="mpts", name="segm"),
                                   raster("segm", _levels(C.MAX_LEVEL), "pm", plane_offset=1, precision="float32")) + (
        " SELECT level, tile_x, tile_y, bin_x, bin_y, count(*) AS value FROM pm GROUP BY ALL")

    Q["segment_count_consecutive"] = with_(*base_c) + " SELECT count(*) AS n_segments FROM segc"
    # round trips give the rows back
    Q["text_points_unpadded"] = Q["text_round_trip"] = Q["text_points"]
    Q["log_round_trip"] = Q["normalise_positions"]
    Q["table_points"] = with_(POINTS.replace("ts AS raw_ts", "event_id")) + (
        f" SELECT id, {ts('dt')} AS dt, CASE WHEN event_id % 50 = 0 THEN NULL ELSE lat END AS lat, lon FROM pts")
    Q["count_export_round_trip"] = with_(*cell_ctes) + (
        " SELECT lat AS latitude, lon AS longitude, value AS n, dt FROM cells")
    Q["stage_round_trip"] = Q["segments_consecutive"]
    Q["published_partitions"] = with_(POINTS) + (
        f" SELECT id, {ts('dt')} AS dt, CASE WHEN day(dt) % 3 = 0 THEN lat + {d(1)} ELSE lat END AS lat, lon,"
        " CAST(day(dt) AS INTEGER) AS day FROM pts")
    Q["reject_counts"] = """
WITH r AS (SELECT CASE WHEN event_id % 43 = 0 THEN 'id' WHEN event_id % 37 = 0 THEN 'time'
                       WHEN event_id % 50 = 0 THEN 'latitude' WHEN event_id % 41 = 0 THEN 'longitude' ELSE 'good' END AS reason
           FROM events)
SELECT v.reason, count(r.reason) AS observed, count(r.reason) AS stored
FROM (VALUES ('good'), ('id'), ('time'), ('latitude'), ('longitude')) v(reason) LEFT JOIN r ON r.reason = v.reason
GROUP BY v.reason"""
    Q["tile_set_merged"] = with_(*base_c, rast, f"bc AS ({counts})") + (
        " SELECT level, 'hits' AS name, 'all paths' AS description,"
        " count(DISTINCT (tile_x, tile_y)) AS n_tiles, count(*) AS n_bins, CAST(sum(value) AS BIGINT) AS total,"
        " max(value) AS maximum, min(tile_x) AS min_tile_x, max(tile_x) AS max_tile_x,"
        " min(tile_y) AS min_tile_y, max(tile_y) AS max_tile_y FROM bc GROUP BY level")
    Q["tiles_round_trip"] = with_(*base_c, raster("segc", _levels(2), "bt")) + (
        " SELECT level, tile_x, tile_y, 'hits' AS name, 'all paths' AS description,"
        " CAST(count(*) AS DOUBLE) AS total FROM bt GROUP BY level, tile_x, tile_y")
    Q["cell_track_pairs"] = with_(*base_c, fine) + (
        " SELECT lat_idx, lon_idx, any_value(lat) AS lat, any_value(lon) AS lon, dt, track_id,"
        " count(*) AS n_crossings FROM xf GROUP BY grid, lat_idx, lon_idx, dt, track_id")

    pairs = "ipts AS (SELECT CAST(CAST(id AS BIGINT) // 2 AS VARCHAR) AS id, dt, lat, lon FROM pts)"
    Q["segments_anchored_interleaved"] = with_(POINTS, pairs, anchored(C.LIMITS_ANCHORED, src="ipts", name="segi")) + (
        f" SELECT {SEG_OUT} FROM segi")
    sparse = f"""spts AS (
  SELECT CAST(CAST(id AS BIGINT) // 10 AS VARCHAR) AS id, dt,
         CASE WHEN day(dt) BETWEEN 4 AND 27 AND CAST(id AS BIGINT) % 10 <> 0 THEN lat - {d(70)} ELSE lat END AS lat, lon
  FROM pts)"""
    Q["segments_anchored_sparse"] = with_(POINTS, sparse, anchored(C.LIMITS_SPARSE, src="spts", name="segs")) + (
        f" SELECT {SEG_OUT} FROM segs")
    same = ("upts AS (SELECT CAST(CAST(id AS BIGINT) // 50 AS VARCHAR) AS id, date_trunc('day', dt) AS dt, lat, lon"
            " FROM pts)")
    Q["segments_same_second"] = with_(POINTS, same, consecutive(C.LIMITS_DAYS, src="upts", name="segu")) + (
        f" SELECT {SEG_OUT.rsplit(', ', 1)[0]} FROM segu")
    Q["segments_stored"] = Q["segments_consecutive"]
    nan, k = "CAST('nan' AS DOUBLE)", "event_id"
    dirty = POINTS.replace("ts AS raw_ts", k).replace("pts AS", "raw AS") + f""",
dpts AS (
  SELECT id, CASE WHEN {k} % 109 <> 0 THEN dt END AS dt,
         CASE WHEN {k} % 97 = 0 THEN {nan} WHEN {k} % 103 = 0 THEN {{inf}} WHEN {k} % 107 = 0 THEN NULL ELSE lat END AS lat,
         CASE WHEN {k} % 101 = 0 THEN {nan} WHEN {k} % 113 = 0 THEN NULL ELSE lon END AS lon FROM raw
)"""
    good = "gpts AS (SELECT * FROM dpts WHERE dt IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL)"
    # an infinite coordinate spoils its pairs like NaN
    Q["segments_dirty_consecutive"] = with_(dirty.replace("{inf}", nan), good, """
pr AS (
  SELECT id, lag(dt) OVER w AS adt, lag(lat) OVER w AS alat, lag(lon) OVER w AS alon, dt AS bdt, lat AS blat, lon AS blon
  FROM gpts WINDOW w AS (PARTITION BY id ORDER BY dt, lat, lon)
)""", f"""
ms AS (SELECT *, CAST(epoch(bdt) - epoch(adt) AS DOUBLE) AS time_s, {hav_nan('alat', 'alon', 'blat', 'blon')} AS distance_km
       FROM pr WHERE adt IS NOT NULL)""", f"""
sd AS (SELECT *, CASE WHEN time_s = 0 THEN {d(math.inf)} ELSE distance_km / (time_s / {d(3600.0)}) END AS velocity_kmh
       FROM ms WHERE NOT isnan(distance_km) AND distance_km > 0 AND distance_km < {d(C.Limits().distance_km)}
       AND time_s < {d(86400)})""") + f" SELECT {SEG_OUT} FROM sd"
    # infinite counts as missing; NaN is never far and never moves; an id whose first row is bad has no track
    lim = C.LIMITS_ANCHORED
    reach = hav_nan("c.lat", "c.lon", "o.lat", "o.lon")
    Q["segments_dirty_anchored"] = with_(dirty.replace("{inf}", "NULL"), """
fr AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY dt, lat NULLS FIRST, lon NULLS FIRST) AS rn FROM dpts WHERE dt IS NOT NULL
)""", f"""
ch AS (
  SELECT id, rn, dt, lat, lon, CAST(NULL AS TIMESTAMP) AS adt, CAST(NULL AS DOUBLE) AS alat, CAST(NULL AS DOUBLE) AS alon
  FROM fr WHERE rn = 1 AND lat IS NOT NULL AND lon IS NOT NULL
  UNION ALL
  SELECT c.id, n.rn, n.dt, n.lat, n.lon, c.dt, c.lat, c.lon
  FROM ch c JOIN LATERAL (
    SELECT o.rn, o.dt, o.lat, o.lon FROM fr o
    WHERE o.id = c.id AND o.rn > c.rn AND o.lat IS NOT NULL AND o.lon IS NOT NULL
      AND (isnan({reach}) OR {reach} <= {d(lim.distance_km)})
    ORDER BY o.rn LIMIT 1) n ON TRUE
  WHERE CAST(epoch(n.dt) - epoch(c.dt) AS DOUBLE) <= {d(lim.time_s)}
)""", f"""
ma AS (
  SELECT id, alat, alon, lat AS blat, lon AS blon, adt, dt AS bdt, CAST(epoch(dt) - epoch(adt) AS DOUBLE) AS time_s,
         {hav_nan('alat', 'alon', 'lat', 'lon')} AS distance_km
  FROM ch WHERE adt IS NOT NULL AND NOT isnan(abs(alat - lat) + abs(alon - lon)) AND abs(alat - lat) + abs(alon - lon) > 0
)""", f"""
sx AS (SELECT *, CASE WHEN time_s = 0 THEN {d(-1.0)} ELSE distance_km / (time_s / {d(3600.0)}) END AS velocity_kmh
       FROM ma)""") + f" SELECT {SEG_OUT} FROM sx"

    tri = with_(POINTS, sega, pipe_x)
    ids = "count(DISTINCT track_id) AS n_tracks, string_agg(DISTINCT track_id, ',' ORDER BY track_id) AS ids"
    Q["pipeline_tripline_ids"] = tri + f" SELECT lat, lon, dt, {ids} FROM xp GROUP BY lat, lon, dt"
    Q["pipeline_tripline_velocity"] = tri + (
        f" SELECT lat, lon, dt, {r6('avg(velocity)')} AS velocity FROM xp GROUP BY lat, lon, dt")
    Q["pipeline_tripline_direction"] = tri + (
        " SELECT lat, lon, dt, CAST(trunc(avg(direction)) AS INTEGER) AS direction FROM xp GROUP BY lat, lon, dt")
    merged = crossings("sega", C.GRID_MERGED, "xg", split="hour", dateline="literal", digits="reference", origin_hit="drop")
    Q["pipeline_tripline_coarse"] = with_(POINTS, sega, merged) + (
        f" SELECT lat, lon, dt, {ids} FROM xg GROUP BY lat, lon, dt")
    Q["pipeline_mercator_tiles"] = with_(POINTS, mpts, consecutive(C.LIMITS_CONSECUTIVE, src="mpts", name="segm"),
                                         raster("segm", _levels(3), "pt", plane_offset=1, precision="float32")) + (
        " SELECT level, tile_x, tile_y, CAST(count(*) AS DOUBLE) AS total FROM pt GROUP BY level, tile_x, tile_y")
    return Q
