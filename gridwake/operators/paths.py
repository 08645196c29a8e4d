"""Path building: connect an object's position reports into segments.

Two rules, as modes of one API:

``consecutive``
    Every row becomes the next start. A pair is emitted when it moved and is
    within the time, distance and (optional) velocity limits; limits are
    exclusive unless ``Limits.inclusive``. No time passed: velocity +inf.

``anchored``
    A rejected row does not become the next start: a row too far away
    (distance) is an outlier and the following row is measured from the old
    anchor again; a row too late (time) ends the track for good, because all
    later rows are later still. Unparseable times are ignored, rows with
    non-numeric coordinates are skipped, and an id whose first row has
    non-numeric coordinates emits nothing. Limits are inclusive unless
    ``Limits.inclusive`` is False. No time passed: velocity -1.

Input ``points``: ``id, dt (timestamp), lat (double), lon (double)``; null
``dt``/``lat``/``lon`` mark unparseable fields. Output ``segments``:
``id, alat, alon, blat, blon, adt, bdt, time_s, distance_km, velocity_kmh``.
Rows of an id are ordered by ``(dt, lat, lon)``, so ties are deterministic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Limits
from ..functions.geo import elapsed_seconds, haversine_km, speed_kmh
from ..session import intermediate
from .anchored_chunks import anchored_chunk_segments
from . import sequence
from .sequence import (BUCKET, equi_depth, key_rows, partition_by_bucket, spread, time_bucket, with_previous,
                       with_previous_whole, with_previous_within)

SEGMENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("alat", T.DoubleType()),
    T.StructField("alon", T.DoubleType()),
    T.StructField("blat", T.DoubleType()),
    T.StructField("blon", T.DoubleType()),
    T.StructField("adt", T.TimestampType()),
    T.StructField("bdt", T.TimestampType()),
    T.StructField("time_s", T.DoubleType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("velocity_kmh", T.DoubleType()),
])
SEGMENT_COLUMNS = SEGMENT_SCHEMA.fieldNames()

ORDER = ["dt", "lat", "lon"]
PIECE_ROWS = 2_000_000        # rows of an id that one task follows at once
TASK_ROWS = 50_000            # rows of a task whose segments are cut at every grid line they meet
TAIL_SHARE = 4                # tail copies serve limits up to this fraction of a bucket


def _finite(name: str) -> Column:
    """The coordinate, null where it is infinite."""
    return F.when(~F.abs(F.col(name)).eqNullSafe(F.lit(math.inf)), F.col(name)).alias(name)


def _over(value: Column, limit: float, inclusive: bool) -> Column:
    """True when ``value`` breaks ``limit``; NaN never breaks a limit."""
    broke = value > F.lit(float(limit)) if inclusive else value >= F.lit(float(limit))
    return broke & ~F.isnan(value.cast("double"))


def _within(value: Column, limit: float, inclusive: bool) -> Column:
    ok = value <= F.lit(float(limit)) if inclusive else value < F.lit(float(limit))
    return ok & ~F.isnan(value.cast("double"))


def _segment_projection(prev: str, zero_time_velocity: float) -> list[Column]:
    p = F.col(prev)
    t = elapsed_seconds(p["dt"], F.col("dt")).cast("double")
    d = haversine_km(p["lat"], p["lon"], F.col("lat"), F.col("lon"))
    return [
        F.col("id").cast("string").alias("id"),
        p["lat"].alias("alat"), p["lon"].alias("alon"),
        F.col("lat").alias("blat"), F.col("lon").alias("blon"),
        p["dt"].alias("adt"), F.col("dt").alias("bdt"),
        t.alias("time_s"), d.alias("distance_km"),
        speed_kmh(d, t, zero_time=zero_time_velocity).alias("velocity_kmh"),
    ]


def segments_consecutive(points: DataFrame, limits: Limits = Limits(),
                         split_seconds: int | str = "auto",
                         zero_time_velocity: float = math.inf, target_rows: int | None = None,
                         task_rows: int | None = None) -> DataFrame:
    """Consecutive rule (every row becomes the next start).

    ``split_seconds``: time-bucket width that splits each id over tasks;
    ``"auto"`` splits only ids with more than ``target_rows`` rows (default
    ``sequence.TARGET_ROWS``), into buckets of that many (one small aggregate
    job, a few more if there are such ids). ``task_rows`` (with ``"auto"``)
    bounds the rows that one task pairs, ids being whole unless they are split,
    for segments that many rows are made of at once."""
    inclusive = bool(limits.inclusive) if limits.inclusive is not None else False
    pts = (points.select(F.col("id").cast("string").alias("id"), "dt", "lat", "lon")
           .where(F.col("dt").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()))
    target = target_rows or sequence.TARGET_ROWS
    if split_seconds == "auto":
        top, total = key_rows(pts, "id")
        if top > target:
            paired = with_previous(equi_depth(pts, "id", "dt", ORDER, target), "id", ORDER, [], F.col(BUCKET))
            paired = spread(paired, total, task_rows, "id", "dt") if task_rows else paired
        else:
            paired = with_previous_whole(spread(pts, total, task_rows, "id") if task_rows else pts, "id", ORDER)
    elif limits.time_s * TAIL_SHARE <= (split := int(split_seconds)):
        # pairs further apart than the time limit are never emitted, so each
        # bucket only needs the previous bucket's last time-limit seconds:
        # at most a quarter of the rows is copied, and no join is needed
        paired = with_previous_within(pts, "id", ORDER, F.col("dt"), split, limits.time_s)
    else:
        # buckets follow the rows, not the limit: the last row of the nearest
        # earlier bucket comes from a summary of one row per bucket
        paired = with_previous(pts, "id", ORDER, [], time_bucket(F.col("dt"), split))
    seg = paired.where(F.col("prev").isNotNull()).select(*_segment_projection("prev", zero_time_velocity))
    d, t, v = F.col("distance_km"), F.col("time_s"), F.col("velocity_kmh")
    keep = (d > 0) & ~F.isnan(d) & _within(d, limits.distance_km, inclusive) & _within(t, limits.time_s, inclusive)
    if limits.velocity_kmh >= 0:
        keep = keep & _within(v, limits.velocity_kmh, inclusive)
    return seg.where(keep)


# --------------------------------------------------------------------- anchored

def segments_anchored(points: DataFrame, limits: Limits = Limits(),
                      split_seconds: int | str = "auto",
                      zero_time_velocity: float = -1.0, piece_rows: int | None = None,
                      target_rows: int | None = None, task_rows: int | None = None) -> DataFrame:
    """Anchored rule (a rejected row does not become the next start).

    Plan: pair each good row with the previous good row (skew-safe window).
    Per id, ``cut`` is the first row whose gap to its predecessor breaks the
    time limit - no row from there on can be reached - and ``fd`` the first
    row before ``cut`` whose distance to its predecessor breaks the distance
    limit. Before ``fd`` the anchor is always the previous row, so those
    pairs are final (native fast path). Only the stretch from the row before
    ``fd`` up to ``cut`` needs the sequential rule.

    That stretch is evaluated as transfer maps of chunks (``anchored_chunks``),
    so a hot id is split over many tasks. A chunk is a run of an id's buckets
    with about ``piece_rows`` good rows (default ``PIECE_ROWS``), so sparse
    stretches are not cut up and dense ones are. The annotated
    rows are written once to the intermediate folder; this, the maps and
    ``split_seconds="auto"`` run Spark actions at call time. ``task_rows``
    (with ``"auto"``) spreads the segments as in ``segments_consecutive``.

    Infinite coordinates count as non-numeric; NaN never breaks a limit and
    never counts as movement.
    """
    inclusive = True if limits.inclusive is None else bool(limits.inclusive)
    T_, D_ = float(limits.time_s), float(limits.distance_km)

    pts = (points.select(F.col("id").cast("string").alias("id"), "dt", _finite("lat"), _finite("lon"))
           .where(F.col("dt").isNotNull()))
    good = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    target = target_rows or sequence.TARGET_ROWS
    top, total = key_rows(pts, "id") if split_seconds == "auto" else (0, 0)
    if split_seconds != "auto":
        bucket = time_bucket(F.col("dt"), int(split_seconds))
    elif top > target:
        pts, bucket = equi_depth(pts, "id", "dt", ORDER, target), F.col(BUCKET)
    else:
        bucket = F.lit(0).cast("long")

    pts = partition_by_bucket(pts, "id", bucket)      # the only shuffle of all rows
    # The only sort: one window pass over every row of an (id, bucket), bad
    # rows included, yields the previous good row inside the bucket, whether
    # the row opens the bucket and whether it is the bucket's last good row.
    w = Window.partitionBy("id", BUCKET).orderBy(
        F.col("dt").asc(), F.col("lat").asc_nulls_first(), F.col("lon").asc_nulls_first())
    goodrow = F.when(good, F.struct("dt", "lat", "lon"))
    n_good = F.count(goodrow).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    x = pts.select(
        "id", BUCKET, "dt", "lat", "lon", good.alias("_good"), n_good.alias("_n"),
        F.last(goodrow, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_pg"),
        (F.row_number().over(w) == 1).alias("_head"),
        (good & (F.count(goodrow).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                 == n_good)).alias("_tail"))
    # written once: the summary, the pairing and both outputs read it, so the
    # data is shuffled and sorted once (without it each consumer re-sorts)
    x = intermediate(x, "anchored-annotated")

    # per (id, bucket) summary from the flagged rows only (at most two per bucket):
    # the last good row carried into later buckets, and whether the id's very
    # first row (nulls first) has bad coordinates - then the id emits nothing
    wb = Window.partitionBy("id").orderBy(BUCKET)
    summary = (x.where(F.col("_head") | F.col("_tail"))
               .groupBy("id", BUCKET)
               .agg(F.max(F.when(F.col("_head"), ~F.col("_good"))).alias("_head_bad"),
                    F.max(F.when(F.col("_tail"), F.struct("dt", "lat", "lon"))).alias("_last"), F.max("_n").alias("_n"))
               .select("id", BUCKET,
                       F.floor(F.coalesce(F.sum("_n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                               / F.lit(piece_rows or PIECE_ROWS)).alias("_piece"),
                       F.last("_last", ignorenulls=True)
                       .over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
                       F.first("_head_bad")
                       .over(wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_dead")))

    paired = (x.where(F.col("_good")).drop("_n").join(summary, ["id", BUCKET], "left")
              .withColumn("prev", F.coalesce(F.col("_pg"), F.col("_carry"))))
    p = F.col("prev")
    t = elapsed_seconds(p["dt"], F.col("dt")).cast("double")
    d = haversine_km(p["lat"], p["lon"], F.col("lat"), F.col("lon"))
    me = F.struct(F.col("dt"), F.col("lat"), F.col("lon"))
    paired = (paired.withColumn("_t", t).withColumn("_d", d)
              .withColumn("_late", p.isNotNull() & _over(F.col("_t"), T_, inclusive))
              .withColumn("_far", p.isNotNull() & ~F.col("_late") & _over(F.col("_d"), D_, inclusive)))

    # per (id, bucket) violation summaries, then id-wide minima over the buckets
    viol = (paired.groupBy("id", BUCKET)
            .agg(F.min(F.when(F.col("_late"), me)).alias("_cut"),
                 F.min(F.when(F.col("_far"), F.struct(me.alias("k"), p.alias("anchor")))).alias("_fd")))
    wid = Window.partitionBy("id")
    info = viol.select("id", BUCKET, F.min("_cut").over(wid).alias("cut"), F.min("_fd").over(wid).alias("fd"))
    info = info.select(
        "id", BUCKET, "cut",
        F.when(F.col("cut").isNull() | (F.col("fd.k") < F.col("cut")), F.col("fd")).alias("fd"))

    rows = paired.where(~F.col("_dead")).join(info, ["id", BUCKET], "left")
    before_cut = F.col("cut").isNull() | (me < F.col("cut"))
    before_fd = F.col("fd").isNull() | (me < F.col("fd.k"))

    moved = F.abs(p["lat"] - F.col("lat")) + F.abs(p["lon"] - F.col("lon"))
    fast = (rows.where(p.isNotNull() & before_cut & before_fd & (moved > 0) & ~F.isnan(moved))
            .select(*_segment_projection("prev", zero_time_velocity)))

    slow_in = (rows.where(F.col("fd").isNotNull() & before_cut & (me >= F.col("fd.anchor")))
               .select("id", F.col("_piece").alias("chunk"), F.unix_timestamp("dt").alias("ts"), "lat", "lon",
                       F.col("dt").alias("_dt")))
    out = fast.unionByName(anchored_chunk_segments(slow_in, T_, D_, inclusive, zero_time_velocity))
    return spread(out, total, task_rows, "id", *(["bdt"] if top > target else [])) if task_rows else out


def count_segments(segments: DataFrame, by_id: bool = False) -> DataFrame:
    """Number of segments, overall or per id (lazy; partial aggregation)."""
    if by_id:
        return segments.groupBy("id").agg(F.count(F.lit(1)).alias("n_segments"))
    return segments.agg(F.count(F.lit(1)).alias("n_segments"))
