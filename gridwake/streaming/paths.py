"""Structured Streaming form of the consecutive path rule and the cell counts.

``stream_segments`` keeps, per id, only the last accepted position as
state (``applyInPandasWithState``), so each micro-batch connects its rows to
the previous batch's last row with the same rules as the batch operator.
Rows older than an id's last processed row are late for path building and
are skipped (counted in the state). ``stream_segments_ordered`` waits for
them: rows are held back in the state until event time has moved on by the
allowed lateness, and then connected in order. ``stream_cell_counts`` aggregates the
crossings of a segment stream per cell and event-time bucket with a
watermark, so finished buckets are emitted and their state dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import Grid, Limits
from ..functions.geo import great_circle_km
from ..operators.crossings import crossings

SEGMENT_DDL = ("id string, alat double, alon double, blat double, blon double, adt timestamp, "
               "bdt timestamp, time_s double, distance_km double, velocity_kmh double")
STATE_DDL = "ts long, lat double, lon double, late long"


def _connector(limits: Limits):
    inclusive = False if limits.inclusive is None else bool(limits.inclusive)
    T, D, V = float(limits.time_s), float(limits.distance_km), float(limits.velocity_kmh)

    def within(x, lim):
        return (x <= lim) if inclusive else (x < lim)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(pdfs), ignore_index=True)
        ts = pdf["dt"].astype("datetime64[us]").astype("int64") // 1_000_000
        pdf = pdf.assign(ts=ts).sort_values(["ts", "lat", "lon"], kind="mergesort")
        late = 0
        if state.exists:
            last_ts, last_lat, last_lon, late = state.get
            keep = (pdf["ts"] > last_ts) | ((pdf["ts"] == last_ts)
                                           & ((pdf["lat"] > last_lat) | ((pdf["lat"] == last_lat) & (pdf["lon"] >= last_lon))))
            late += int((~keep).sum())
            pdf = pdf[keep]
            head = pd.DataFrame({"ts": [last_ts], "lat": [last_lat], "lon": [last_lon]})
            seq = pd.concat([head, pdf[["ts", "lat", "lon"]]], ignore_index=True)
        else:
            seq = pdf[["ts", "lat", "lon"]].reset_index(drop=True)
        if len(seq) == 0:
            return
        a, b = seq.iloc[:-1].reset_index(drop=True), seq.iloc[1:].reset_index(drop=True)
        t = (b["ts"] - a["ts"]).astype("float64").to_numpy()
        d = great_circle_km(a["lat"].to_numpy(), a["lon"].to_numpy(), b["lat"].to_numpy(), b["lon"].to_numpy())
        with np.errstate(divide="ignore", invalid="ignore"):
            v = np.where(t == 0, math.inf, d / (t / 3600.0))
        ok = (d > 0) & within(d, D) & within(t, T)
        if V >= 0:
            ok &= within(v, V)
        last = seq.iloc[-1]
        state.update((int(last["ts"]), float(last["lat"]), float(last["lon"]), int(late)))
        if ok.any():
            yield pd.DataFrame({
                "id": key[0],
                "alat": a["lat"].to_numpy()[ok], "alon": a["lon"].to_numpy()[ok],
                "blat": b["lat"].to_numpy()[ok], "blon": b["lon"].to_numpy()[ok],
                "adt": pd.to_datetime(a["ts"].to_numpy()[ok], unit="s"),
                "bdt": pd.to_datetime(b["ts"].to_numpy()[ok], unit="s"),
                "time_s": t[ok], "distance_km": d[ok], "velocity_kmh": v[ok],
            })
    return fn


def stream_segments(points: DataFrame, limits: Limits = Limits(inclusive=False)) -> DataFrame:
    """Consecutive segments of a streaming ``points`` DataFrame (append mode)."""
    pts = (points.select(F.col("id").cast("string").alias("id"), "dt", "lat", "lon")
           .where(F.col("id").isNotNull() & F.col("dt").isNotNull()
                  & F.col("lat").isNotNull() & F.col("lon").isNotNull()))
    return pts.groupBy("id").applyInPandasWithState(
        _connector(limits), SEGMENT_DDL, STATE_DDL, "append", GroupStateTimeout.NoTimeout)


ORDERED_DDL = f"kind string, {SEGMENT_DDL}"
HELD_DDL = "ts binary, lat binary, lon binary, last_ts long, last_lat double, last_lon double"
# added to event times and taken off again by the watermark's delay, so that Spark itself drops no late row
_AHEAD = "36500 days"


def _pairs(ts: np.ndarray, lat: np.ndarray, lon: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    """Columns of the segments between neighbouring rows."""
    inclusive = bool(limits.inclusive)

    def within(x, limit):
        return x <= limit if inclusive else x < limit
    t = np.diff(ts).astype(float)
    d = great_circle_km(lat[:-1], lon[:-1], lat[1:], lon[1:])
    with np.errstate(divide="ignore", invalid="ignore"):
        v = np.where(t == 0, math.inf, d / (t / 3600.0))
    ok = (d > 0) & within(d, limits.distance_km) & within(t, limits.time_s)
    if limits.velocity_kmh >= 0:
        ok &= within(v, limits.velocity_kmh)
    return {"alat": lat[:-1][ok], "alon": lon[:-1][ok], "blat": lat[1:][ok], "blon": lon[1:][ok],
            "adt": pd.to_datetime(ts[:-1][ok], unit="s"), "bdt": pd.to_datetime(ts[1:][ok], unit="s"),
            "time_s": t[ok], "distance_km": d[ok], "velocity_kmh": v[ok]}


def _orderer(limits: Limits, lateness_s: int):
    columns = [part.split()[0] for part in ORDERED_DDL.split(", ")]
    keep_s = int(min(limits.time_s, 10.0 ** 9)) + 1        # after that an id's last row connects to nothing

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        moved_to = state.getCurrentWatermarkMs() / 1000     # the latest time seen by earlier batches
        release = moved_to - lateness_s
        ts, lat, lon, last = np.zeros(0, np.int64), np.zeros(0), np.zeros(0), None
        if state.exists:
            held = state.get
            ts, lat, lon = (np.frombuffer(bytes(b), kind) for b, kind in zip(held[:3], (np.int64, float, float)))
            last = held[3:] if held[3] is not None else None
        new = [p for p in pdfs if len(p)]
        late = None
        if new:
            pdf = pd.concat(new, ignore_index=True)
            row = [pdf["dt"].astype("datetime64[us]").astype("int64").to_numpy() // 1_000_000,
                   pdf["lat"].to_numpy(float), pdf["lon"].to_numpy(float)]
            behind = row[0] < release
            if last is not None:                            # in order for this id, whatever the others do
                behind &= (row[0] < last[0]) | ((row[0] == last[0]) & ((row[1] < last[1])
                                                                      | ((row[1] == last[1]) & (row[2] < last[2]))))
            late = [c[behind] for c in row]
            ts, lat, lon = (np.concatenate([a, b[~behind]]) for a, b in zip((ts, lat, lon), row))
        order = np.lexsort((lon, lat, ts))
        ts, lat, lon = ts[order], lat[order], lon[order]
        n = int(np.searchsorted(ts, release, side="left"))  # rows nothing earlier may come before any more
        out = []
        if n:
            ready = [c[:n] for c in (ts, lat, lon)]
            if last is not None:
                ready = [np.concatenate([np.array([v], c.dtype), c]) for v, c in zip(last, ready)]
            out.append(pd.DataFrame(_pairs(*ready, limits)).assign(kind="segment"))
            last = (int(ready[0][-1]), float(ready[1][-1]), float(ready[2][-1]))
            ts, lat, lon = ts[n:], lat[n:], lon[n:]
        if late is not None and len(late[0]):
            out.append(pd.DataFrame({"blat": late[1], "blon": late[2], "bdt": pd.to_datetime(late[0], unit="s")})
                       .assign(kind="late"))
        wake = int(ts[0]) + lateness_s + 1 if len(ts) else last[0] + keep_s + lateness_s + 1 if last else None
        if wake is None or not len(ts) and wake <= moved_to:
            state.remove()                                  # an idle id leaves no state behind
        else:
            state.update((ts.tobytes(), lat.tobytes(), lon.tobytes(), *(last or (None, None, None))))
            state.setTimeoutTimestamp(max(wake, int(moved_to) + 1) * 1000)
        for part in out:
            if len(part):
                yield part.assign(id=key[0]).reindex(columns=columns)
    return fn


def stream_segments_ordered(points: DataFrame, limits: Limits = Limits(inclusive=False),
                            lateness_s: int = 86400) -> DataFrame:
    """Consecutive segments of a streaming ``points`` DataFrame whose rows may
    come up to ``lateness_s`` seconds of event time late (append mode).

    A row waits in its id's state until the latest time seen lies
    ``lateness_s`` ahead of it; an event-time timer then releases it, also for
    ids without new rows. Released rows are connected in order, so any arrival
    order within the lateness gives the segments of the batch operator. Rows
    that come later still are given out with ``kind`` ``late`` (their position
    in ``bdt, blat, blon``); segments have ``kind`` ``segment``. The state of an
    id goes when its last row can connect to nothing any more."""
    pts = (points.select(F.col("id").cast("string").alias("id"), "dt", "lat", "lon")
           .where(F.col("id").isNotNull() & F.col("dt").isNotNull()
                  & F.col("lat").isNotNull() & F.col("lon").isNotNull())
           .withColumn("clock", F.col("dt") + F.expr(f"interval {_AHEAD}")).withWatermark("clock", _AHEAD))
    return pts.groupBy("id").applyInPandasWithState(
        _orderer(limits, lateness_s), ORDERED_DDL, HELD_DDL, "append", GroupStateTimeout.EventTimeTimeout)


def stream_cell_counts(segments: DataFrame, grid: Grid = Grid(), bucket: str = "1 hour",
                       watermark: str = "1 day") -> DataFrame:
    """Crossings per cell and event-time window of a segment stream.

    Append mode: a window is emitted once the watermark passes its end."""
    x = crossings(segments, grid, temporal_split="other")
    return (x.withWatermark("crossing_ts", watermark)
            .groupBy("grid", "lat_idx", "lon_idx", F.window("crossing_ts", bucket).alias("w"))
            .agg(F.count(F.lit(1)).alias("value"), F.avg("velocity").alias("velocity"),
                 F.avg("direction").alias("direction"))
            .select("grid", "lat_idx", "lon_idx", F.col("w.start").alias("bucket_start"),
                    F.col("w.end").alias("bucket_end"), "value", "velocity",
                    F.col("direction").cast("int").alias("direction")))


def stream_tripline(points: DataFrame, limits: Limits = Limits(inclusive=False), grid: Grid = Grid(),
                    bucket: str = "1 hour", watermark: str = "1 day") -> DataFrame:
    """Positions stream -> consecutive segments (per-id state) -> crossings ->
    cell counts per event-time window, as one streaming query (append mode:
    a window is emitted once, when the watermark passes its end)."""
    return stream_cell_counts(stream_segments(points, limits), grid, bucket, watermark)
