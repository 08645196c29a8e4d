"""Registered queries: one per operator family, each ``(spark, sf_dir) ->
DataFrame`` over the whole test tables (positions derived from ``events``).

Doubles that come out of trigonometry are rounded to 6 decimals with
``floor(x * 1e6 + 0.5) / 1e6`` so that any engine writing the same
arithmetic produces identical values; timestamps are rendered as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TEMPORAL_SPLITS, Grid, Limits, Region
from ..functions.geo import bearing_deg, mercator_pixel, tile_of_pixel
from ..functions.timefn import format_ts, temporal_bucket
from ..operators.crossings import crossings, filter_segments_region
from ..operators.paths import TASK_ROWS, count_segments, segments_anchored, segments_consecutive
from ..operators.stats import cell_stats, cell_track_id_parts, cell_track_ids, cell_track_pairs
from ..operators.tiles import bin_counts, bin_hits, dense_tiles
from ..session import ensure_checkpoint_dir
from ..sinks.published import publish, read_published
from ..sinks.tile_sets import describe_tile_set, merge_tile_set
from ..sinks.writers import export_counts, read_counts, write_positions, write_stage, write_tiles
from ..sources.events import event_lat, event_lon, events_path, points_from_events
from ..sources.positions import (filter_region, normalise_positions, parse_text_lines, points_from_table,
                                 points_from_text, read_points, read_position_log, store_positions, to_points)
from .pipelines import (legacy_mercator_options, legacy_tripline_options, mercator_pipeline,
                        tripline_pipeline)

# Fixed parameters of the registered queries.
LIMITS_ANCHORED = Limits(time_s=86400, distance_km=300)
LIMITS_CONSECUTIVE = Limits(time_s=86400, distance_km=300, inclusive=False)
LIMITS_VELOCITY = Limits(time_s=86400, distance_km=300, velocity_kmh=60.0, inclusive=False)
WORLD = Region(-90.0, -360.0, 90.0, 180.0)
GRID_FINE = Grid(0.1, 0.1, WORLD, "fine")
GRID_MERGED = Grid(10.0, 10.0, WORLD, "merged")
GRID_COARSE = Grid(1.0, 1.0, WORLD, "coarse")
MULTI_GRIDS = (Grid(0.5, 0.5, WORLD, "half"), Grid(1.0, 1.0, Region(30.0, -200.0, 60.0, 180.0), "band"))
POINT_REGION = Region(38.0, -90.0, 45.0, 90.0)
SEGMENT_REGION = Region(38.0, -120.0, 44.0, 60.0)
THROUGH_REGION = Region(40.2, -200.0, 40.4, -100.0)
MAX_LEVEL = 5

Query = Callable[[SparkSession, str], DataFrame]


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(c) < 1e12, F.floor(c * 1e6 + 0.5) / 1e6).otherwise(c)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_from_events(spark.read.parquet(events_path(sf_dir)))


def _segment_out(seg: DataFrame) -> DataFrame:
    return seg.select("id", "alat", "alon", "blat", "blon",
                      format_ts("adt").alias("adt"), format_ts("bdt").alias("bdt"),
                      "time_s", r6("distance_km").alias("distance_km"),
                      r6("velocity_kmh").alias("velocity_kmh"))


def _crossing_out(x: DataFrame, sign: bool = False) -> DataFrame:
    cols = [F.col("grid"), F.col("track_id"), F.col("axis"), F.col("lat_idx"), F.col("lon_idx"),
            F.col("lat"), F.col("lon"), r6("cross_lat").alias("cross_lat"), r6("cross_lon").alias("cross_lon"),
            format_ts("crossing_ts").alias("crossing_ts"), F.col("dt"),
            r6("velocity").alias("velocity"), r6("direction").alias("direction")]
    if sign:
        cols.append(F.col("sign"))
    return x.select(*cols)


def _consecutive(spark, sf_dir):
    return segments_consecutive(_points(spark, sf_dir), LIMITS_CONSECUTIVE)


def _fine_crossings(spark, sf_dir):
    seg = segments_consecutive(_points(spark, sf_dir), LIMITS_CONSECUTIVE, task_rows=TASK_ROWS)
    return crossings(seg, GRID_FINE, temporal_split="hour")


# ------------------------------------------------------------------- sources

def q_normalise_positions(spark, sf_dir):
    """Raw log text rebuilt from events -> normalise -> clean + parse."""
    ev = spark.read.parquet(events_path(sf_dir))
    pts = points_from_events(ev).withColumn("ts", F.col("dt"))
    raw = pts.select(
        F.lit("1").alias("ais_type"),
        F.concat(F.lit(' "'), F.col("id"), F.lit('" ')).alias("mmsi"),
        F.lit("n").alias("name"), F.lit("i").alias("imo"),
        F.concat(F.lit(" "), F.col("lat").cast("string"), F.lit(" ")).alias("latitude"),
        F.concat(F.lit(" "), F.col("lon").cast("string")).alias("longitude"),
        F.lit("0").alias("speed"), F.lit("0").alias("heading"),
        F.concat(F.lit(" "), F.date_format("ts", "yyMMddHHmm")).alias("time"),
        F.lit("d").alias("dest"), F.lit("e").alias("eta"))
    norm = normalise_positions(raw)
    out = to_points(norm, "mmsi", "dt", "latitude", "longitude", on_error="drop")
    return out.select("id", format_ts("dt").alias("dt"), "lat", "lon")


def q_text_points(spark, sf_dir):
    """Tab-separated lines by position (id 0, datetime 2, lat 4, lon 5)."""
    ev = spark.read.parquet(events_path(sf_dir))
    lines = ev.select(F.concat_ws(
        "\t", F.col("user_id").cast("string"), F.col("event_type"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("props"),
        event_lat().cast("string"), event_lon().cast("string")).alias("value"))
    parsed = parse_text_lines(lines, id_idx=0, lat_idx=4, lon_idx=5, datetime_idx=2)
    return parsed.select("id", format_ts("dt").alias("dt"), "lat", "lon")


def q_region_points(spark, sf_dir):
    return filter_region(_points(spark, sf_dir), POINT_REGION).select(
        "id", format_ts("dt").alias("dt"), "lat", "lon")


def q_text_points_unpadded(spark, sf_dir):
    """Times written without leading zeros, with a blank or a T."""
    ev = spark.read.parquet(events_path(sf_dir))
    part = [F.date_format("ts", p).cast("int").cast("string") for p in ("yyyy", "M", "d", "H", "m", "s")]
    stamp = F.concat(part[0], F.lit("-"), part[1], F.lit("-"), part[2],
                     F.when(F.col("event_id") % 2 == 0, F.lit(" ")).otherwise(F.lit("T")),
                     part[3], F.lit(":"), part[4], F.lit(":"), part[5], F.lit(".5"))
    lines = ev.select(F.concat_ws("\t", F.col("user_id").cast("string"), stamp,
                                  event_lat().cast("string"), event_lon().cast("string")).alias("value"))
    parsed = parse_text_lines(lines, id_idx=0, lat_idx=2, lon_idx=3, datetime_idx=1)
    return parsed.select("id", format_ts("dt").alias("dt"), "lat", "lon")


def _folder(spark, name):
    """A new folder for a query that writes and reads back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_log_round_trip(spark, sf_dir):
    """Raw log files written and read: names hold balanced and unbalanced
    quotes, fields are padded with blanks."""
    pts = _points(spark, sf_dir)
    name = F.when(F.pmod(F.xxhash64("id", "dt"), F.lit(3)) == 0, F.lit('"FOO')).otherwise(F.lit('"a" b'))
    line = F.concat_ws(",", F.lit("1"), F.concat(F.lit(' "'), F.col("id"), F.lit('" ')), name, F.lit("9"),
                       F.col("lat").cast("string"), F.concat(F.lit(" "), F.col("lon").cast("string")),
                       F.lit("0"), F.lit("0"), F.date_format("dt", "yyMMddHHmm"), F.lit('"x'), F.lit(""))
    path = _folder(spark, "position-log")
    pts.select(line.alias("value")).write.text(path)
    out = to_points(normalise_positions(read_position_log(spark, path)), "mmsi", "dt", "latitude", "longitude")
    return out.select("id", format_ts("dt").alias("dt"), "lat", "lon")


def q_text_round_trip(spark, sf_dir):
    """Tab-separated files written, then read through the pluggable reader."""
    path = _folder(spark, "text-points")
    _points(spark, sf_dir).select(F.concat_ws(
        "\t", "id", F.date_format("dt", "yyyy-MM-dd"), F.date_format("dt", "HH:mm:ss.SSS"),
        F.col("lat").cast("string"), F.col("lon").cast("string")).alias("value")).write.text(path)
    out = read_points(spark, points_from_text, path=path, id_idx=0, date_idx=1, time_idx=2, lat_idx=3, lon_idx=4)
    return out.select("id", format_ts("dt").alias("dt"), "lat", "lon")


def q_table_points(spark, sf_dir):
    """Named table with other column names; bad rows become nulls and stay."""
    view = f"position_rows_{uuid.uuid4().hex}"
    ev = spark.read.parquet(events_path(sf_dir))
    bad = F.col("event_id") % 50 == 0
    ev.select(F.col("user_id").alias("ship"), F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                                                       F.lit('"')).alias("seen"),
              F.when(bad, F.lit("n/a")).otherwise(event_lat().cast("string")).alias("y"),
              event_lon().cast("string").alias("x")).createOrReplaceTempView(view)
    out = points_from_table(spark, view, "ship", "seen", "y", "x")
    return out.select("id", format_ts("dt").alias("dt"), "lat", "lon")


# ------------------------------------------------------------------- paths

def dirty_points(spark, sf_dir):
    """Positions with NaN, infinite and missing coordinates and missing times
    in fixed rows."""
    k = F.col("event_id")
    ev = spark.read.parquet(events_path(sf_dir))
    lat = (F.when(k % 97 == 0, F.lit(float("nan"))).when(k % 103 == 0, F.lit(float("inf")))
           .when(k % 107 == 0, F.lit(None)).otherwise(event_lat()))
    lon = F.when(k % 101 == 0, F.lit(float("nan"))).when(k % 113 == 0, F.lit(None)).otherwise(event_lon())
    return ev.select(F.col("user_id").cast("string").alias("id"),
                     F.when(k % 109 != 0, F.date_trunc("second", "ts")).alias("dt"), lat.alias("lat"), lon.alias("lon"))


def q_segments_dirty_consecutive(spark, sf_dir):
    return _segment_out(segments_consecutive(dirty_points(spark, sf_dir), Limits(time_s=86400, inclusive=False)))


def q_segments_dirty_anchored(spark, sf_dir):
    return _segment_out(segments_anchored(dirty_points(spark, sf_dir), LIMITS_ANCHORED))


def q_segments_anchored_interleaved(spark, sf_dir):
    """Two tracks under one id: the anchor follows one of them only."""
    pts = _points(spark, sf_dir).withColumn("id", F.expr("cast(cast(id as bigint) div 2 as string)"))
    return _segment_out(segments_anchored(pts, LIMITS_ANCHORED, split_seconds=86400))


LIMITS_SPARSE = Limits(time_s=60 * 86400, distance_km=300)


def q_segments_anchored_sparse(spark, sf_dir):
    """Ten users share an id and are elsewhere for most of the time: anchors
    have to pass chunk after chunk that they do not touch."""
    pts = _points(spark, sf_dir)
    away = F.dayofmonth("dt").between(4, 27) & (F.col("id").cast("bigint") % 10 != 0)
    pts = pts.select(F.expr("cast(cast(id as bigint) div 10 as string)").alias("id"), "dt",
                     F.when(away, F.col("lat") - 70.0).otherwise(F.col("lat")).alias("lat"), "lon")
    return _segment_out(segments_anchored(pts, LIMITS_SPARSE, split_seconds=3 * 3600, piece_rows=50))


def q_segments_consecutive(spark, sf_dir):
    return _segment_out(_consecutive(spark, sf_dir))


LIMITS_DAYS = Limits(time_s=3 * 86400, distance_km=300, inclusive=False)


def q_segments_same_second(spark, sf_dir):
    """All rows of an id and day carry one time, so ids are split inside it."""
    pts = _points(spark, sf_dir).withColumn("dt", F.date_trunc("day", "dt"))
    pts = pts.withColumn("id", F.expr("cast(cast(id as bigint) div 50 as string)"))
    return _segment_out(segments_consecutive(pts, LIMITS_DAYS, target_rows=20)).drop("velocity_kmh")


def q_segments_stored(spark, sf_dir):
    """Positions stored in buckets by id, then paired where they lie."""
    table = f"positions_{uuid.uuid4().hex}"
    write_positions(_points(spark, sf_dir), table, buckets=8, path=_folder(spark, "positions"))
    return _segment_out(segments_consecutive(spark.read.table(table), LIMITS_CONSECUTIVE))


def q_segments_velocity(spark, sf_dir):
    return _segment_out(segments_consecutive(_points(spark, sf_dir), LIMITS_VELOCITY))


def q_segments_anchored(spark, sf_dir):
    return _segment_out(segments_anchored(_points(spark, sf_dir), LIMITS_ANCHORED))


def q_segments_region(spark, sf_dir):
    return _segment_out(filter_segments_region(_consecutive(spark, sf_dir), Grid(1.0, 1.0, SEGMENT_REGION)))


def q_segment_bearing(spark, sf_dir):
    seg = _consecutive(spark, sf_dir)
    return seg.select("id", format_ts("adt").alias("adt"), format_ts("bdt").alias("bdt"),
                      r6(bearing_deg("alat", "alon", "blat", "blon")).alias("bearing"))


def q_segment_count_by_id(spark, sf_dir):
    return count_segments(_consecutive(spark, sf_dir), by_id=True)


def q_segment_count(spark, sf_dir):
    return count_segments(segments_anchored(_points(spark, sf_dir), LIMITS_ANCHORED))


def q_segment_count_consecutive(spark, sf_dir):
    return count_segments(_consecutive(spark, sf_dir))


# ------------------------------------------------------------------- crossings

def q_crossings_lat(spark, sf_dir):
    return _crossing_out(crossings(_consecutive(spark, sf_dir), GRID_FINE, axes=("lat",)))


def q_crossings_lon(spark, sf_dir):
    return _crossing_out(crossings(_consecutive(spark, sf_dir), GRID_FINE, axes=("lon",)))


def q_crossings_all(spark, sf_dir):
    return _crossing_out(crossings(_consecutive(spark, sf_dir), GRID_FINE, with_sign=True), sign=True)


def q_crossings_short_way(spark, sf_dir):
    return _crossing_out(crossings(_consecutive(spark, sf_dir), GRID_COARSE, temporal_split="day",
                                   dateline="short_way"))


def q_crossings_literal(spark, sf_dir):
    return _crossing_out(crossings(_consecutive(spark, sf_dir), GRID_COARSE, temporal_split="day",
                                   dateline="literal", digits="reference", origin_hit="drop"))


def q_crossing_time(spark, sf_dir):
    x = crossings(segments_anchored(_points(spark, sf_dir), LIMITS_ANCHORED), GRID_COARSE,
                  temporal_split="minute")
    return x.select("track_id", "axis", "lat_idx", "lon_idx", format_ts("crossing_ts").alias("crossing_ts"),
                    "dt")


def q_temporal_buckets(spark, sf_dir):
    pts = _points(spark, sf_dir)
    return pts.select("id", format_ts("dt").alias("dt"),
                      *[temporal_bucket(F.col("dt"), s).alias(f"b_{s}") for s in TEMPORAL_SPLITS],
                      temporal_bucket(F.col("dt"), "Hour").alias("b_hour_mixed_case"),
                      temporal_bucket(F.col("dt"), "week").alias("b_other"))


# ------------------------------------------------------------------- aggregates

def _cells(spark, sf_dir):
    return cell_stats(_fine_crossings(spark, sf_dir))


CELL_OUT = ["lat_idx", "lon_idx", "lat", "lon", "dt"]


def q_cell_counts(spark, sf_dir):
    return _cells(spark, sf_dir).select(*CELL_OUT, "value")


def q_cell_velocity(spark, sf_dir):
    return _cells(spark, sf_dir).select(*CELL_OUT, r6("velocity").alias("velocity"))


def q_cell_direction(spark, sf_dir):
    return _cells(spark, sf_dir).select(*CELL_OUT, "direction")


def q_cell_stats(spark, sf_dir):
    return _cells(spark, sf_dir).select(*CELL_OUT, "value", r6("velocity").alias("velocity"), "direction")


def q_cell_track_ids(spark, sf_dir):
    return cell_track_ids(_fine_crossings(spark, sf_dir)).select(*CELL_OUT, "n_tracks", "ids")


def q_cell_track_id_parts(spark, sf_dir):
    """Id lists per coarse cell over all time, in parts of 7 ids."""
    x = crossings(_consecutive(spark, sf_dir), GRID_COARSE, temporal_split="all")
    return cell_track_id_parts(x, part_size=7).select(*CELL_OUT, "part", "n_parts", "n_tracks", "ids")


def q_cell_track_pairs(spark, sf_dir):
    return cell_track_pairs(_fine_crossings(spark, sf_dir)).select(*CELL_OUT, "track_id", "n_crossings")


def q_count_export_round_trip(spark, sf_dir):
    """Counts exported as tab-separated text with a header, and read back."""
    path = _folder(spark, "count-export")
    export_counts(_cells(spark, sf_dir), path)
    return read_counts(spark, path).withColumnsRenamed({"count": "n", "date": "dt"})


def q_stage_round_trip(spark, sf_dir):
    """A stage written twice over the same target; the second replaces the first."""
    path = _folder(spark, "stage")
    seg = _segment_out(_consecutive(spark, sf_dir))
    write_stage(seg.limit(10), path)
    write_stage(seg, path, partition_by=None)
    return spark.read.parquet(path)


def q_published_partitions(spark, sf_dir):
    """Points published by day of the month, then every third day replaced by
    moved points while reading the folder itself."""
    path = _folder(spark, "published")
    pts = _points(spark, sf_dir).withColumn("day", F.dayofmonth("dt"))
    publish(pts, path, partition_by=["day"])
    moved = read_published(spark, path).where("day % 3 = 0").withColumn("lat", F.col("lat") + 1.0)
    publish(moved, path, partition_by=["day"], touched_only=True)
    return read_published(spark, path).select("id", format_ts("dt").alias("dt"), "lat", "lon", "day")


def q_reject_counts(spark, sf_dir):
    """Rows with a bad id, time or coordinate, counted by reason in the pass
    that stores the good ones."""
    ev, k = spark.read.parquet(events_path(sf_dir)), F.col("event_id")
    raw = ev.select(
        F.when(k % 43 != 0, F.col("user_id").cast("string")).alias("who"),
        F.when(k % 37 == 0, F.lit("2024-02-30 10:00:00")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("at"),
        F.when(k % 50 == 0, F.lit("n/a")).otherwise(event_lat().cast("string")).alias("y"),
        F.when(k % 41 == 0, F.lit("")).otherwise(event_lon().cast("string")).alias("x"))
    good, bad, counts = store_positions(to_points(raw, "who", "at", "y", "x", on_error="mark"), _folder(spark, "positions"))
    found = bad.groupBy("reason").count().unionByName(good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("count")))
    seen = spark.createDataFrame(list(counts.items()), "reason string, observed long")
    return seen.join(found, "reason", "left").select("reason", "observed", F.coalesce("count", F.lit(0)).alias("stored"))


def q_multi_grid_counts(spark, sf_dir):
    x = crossings(_consecutive(spark, sf_dir), list(MULTI_GRIDS), temporal_split="day")
    return cell_stats(x).select("grid", *CELL_OUT, "value")


def many_grids(n: int = 2000) -> list[Grid]:
    """Small grids over the area of the positions, overlapping each other."""
    out = []
    for i in range(n):
        lat, lon = 34.0 + (i % 50) * 0.4, -180.0 + (i // 50) * 9.0
        res = 0.5 if i % 2 else 0.25
        out.append(Grid(res, res, Region(lat, lon, lat + 2.0, min(lon + 4.0, 180.0)), f"g{i}"))
    return out


def q_multi_grid_index(spark, sf_dir):
    """Crossings of 2,000 grids, found through the grid index."""
    x = crossings(_consecutive(spark, sf_dir), many_grids(), temporal_split="day")
    return cell_stats(x).select("grid", *CELL_OUT, "value")


def q_segments_through_region(spark, sf_dir):
    """Segments that meet a narrow region, with or without an end in it."""
    seg = filter_segments_region(_consecutive(spark, sf_dir), Grid(1.0, 1.0, THROUGH_REGION), through=True)
    return _segment_out(seg)


# ------------------------------------------------------------------- tiles

def q_mercator_bins(spark, sf_dir):
    pts = _points(spark, sf_dir).select("id", "dt", "lat", "lon",
                                        F.explode(F.sequence(F.lit(1), F.lit(MAX_LEVEL))).alias("level"))
    px, py = mercator_pixel(F.col("lat"), F.col("lon"), F.col("level"))
    tx, ty, bx, by = tile_of_pixel(px, py)
    return pts.select("id", format_ts("dt").alias("dt"), "level",
                      px.cast("bigint").alias("px"), py.cast("bigint").alias("py"),
                      tx.cast("bigint").alias("tile_x"), ty.cast("bigint").alias("tile_y"),
                      bx.cast("bigint").alias("bin_x"), by.cast("bigint").alias("bin_y"))


def q_bin_hits(spark, sf_dir):
    return bin_hits(_consecutive(spark, sf_dir), MAX_LEVEL)


def q_bin_counts(spark, sf_dir):
    return bin_counts(bin_hits(_consecutive(spark, sf_dir), MAX_LEVEL))


def q_bin_counts_pyramid(spark, sf_dir):
    c = bin_counts(bin_hits(_consecutive(spark, sf_dir), MAX_LEVEL))
    return (c.groupBy("level", "tile_x", "tile_y")
            .agg(F.count(F.lit(1)).alias("n_bins"), F.sum("value").alias("hits")))


def q_bin_counts_decay(spark, sf_dir):
    return bin_counts(bin_hits(_consecutive(spark, sf_dir), 3, velocity_limit=500.0, velocity_decay=0.5))


def q_dense_tiles_summary(spark, sf_dir):
    t = dense_tiles(bin_counts(bin_hits(_consecutive(spark, sf_dir), MAX_LEVEL)))
    weighted = F.aggregate(F.transform("bins", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return t.select("level", "tile_x", "tile_y",
                    F.size("bins").cast("bigint").alias("n_slots"),
                    F.aggregate("bins", F.lit(0.0), lambda a, x: a + x).alias("total"),
                    F.size(F.filter("bins", lambda v: v > 0)).cast("bigint").alias("nonzero"),
                    weighted.alias("checksum"))


def q_tiles_round_trip(spark, sf_dir):
    """Dense tile sets written per level and read back."""
    path = _folder(spark, "tiles")
    write_tiles(dense_tiles(bin_counts(bin_hits(_consecutive(spark, sf_dir), 2))), path, "hits", "all paths")
    t = spark.read.parquet(path)
    return t.select(F.col("level").cast("int").alias("level"), "tile_x", "tile_y", "name", "description",
                    F.aggregate("bins", F.lit(0.0), lambda a, x: a + x).alias("total"))


def q_tile_set_merged(spark, sf_dir):
    """A tile set from two batches of users, described per level."""
    path, seg = _folder(spark, "tile-set"), _consecutive(spark, sf_dir)
    for part in (0, 1):
        batch = seg.where(F.col("id").cast("bigint") % 2 == part)
        merge_tile_set(bin_counts(bin_hits(batch, MAX_LEVEL)), path, "hits", "all paths")
    return describe_tile_set(spark, path)


# ------------------------------------------------------------------- pipelines

def _legacy(spark, sf_dir, grid):
    return tripline_pipeline(_points(spark, sf_dir), legacy_tripline_options(limits=LIMITS_ANCHORED, grids=(grid,)))


def q_pipeline_tripline_ids(spark, sf_dir):
    return _legacy(spark, sf_dir, GRID_FINE)["track_ids"].select("lat", "lon", "dt", "n_tracks", "ids")


def q_pipeline_tripline_velocity(spark, sf_dir):
    return _legacy(spark, sf_dir, GRID_FINE)["velocity"].select("lat", "lon", "dt", r6("velocity").alias("velocity"))


def q_pipeline_tripline_direction(spark, sf_dir):
    return _legacy(spark, sf_dir, GRID_FINE)["direction"].select("lat", "lon", "dt", "direction")


def q_pipeline_tripline_coarse(spark, sf_dir):
    """Coarse rounded labels merge cells: one id list per label and bucket."""
    return _legacy(spark, sf_dir, GRID_MERGED)["track_ids"].select("lat", "lon", "dt", "n_tracks", "ids")


def q_pipeline_mercator_tiles(spark, sf_dir):
    out = mercator_pipeline(_points(spark, sf_dir), legacy_mercator_options(limits=LIMITS_CONSECUTIVE, max_level=3))
    return out["tiles"].select("level", "tile_x", "tile_y",
                               F.aggregate("bins", F.lit(0.0), lambda a, x: a + x).alias("total"))


def q_pipeline_tripline(spark, sf_dir):
    out = tripline_pipeline(_points(spark, sf_dir),
                            legacy_tripline_options(limits=LIMITS_ANCHORED, grids=(GRID_FINE,)))
    return out["counts"].select("lat", "lon", "dt", "value")


def q_pipeline_mercator(spark, sf_dir):
    out = mercator_pipeline(_points(spark, sf_dir),
                            legacy_mercator_options(limits=LIMITS_CONSECUTIVE, max_level=MAX_LEVEL))
    return out["bin_counts"]


QUERIES: dict[str, Query] = {
    "normalise_positions": q_normalise_positions,
    "text_points": q_text_points,
    "region_points": q_region_points,
    "segments_consecutive": q_segments_consecutive,
    "segments_velocity": q_segments_velocity,
    "segments_anchored": q_segments_anchored,
    "segments_region": q_segments_region,
    "segment_bearing": q_segment_bearing,
    "segment_count_by_id": q_segment_count_by_id,
    "segment_count": q_segment_count,
    "crossings_lat": q_crossings_lat,
    "crossings_lon": q_crossings_lon,
    "crossings_all": q_crossings_all,
    "crossings_short_way": q_crossings_short_way,
    "crossings_literal": q_crossings_literal,
    "crossing_time": q_crossing_time,
    "temporal_buckets": q_temporal_buckets,
    "cell_counts": q_cell_counts,
    "cell_velocity": q_cell_velocity,
    "cell_direction": q_cell_direction,
    "cell_stats": q_cell_stats,
    "cell_track_ids": q_cell_track_ids,
    "multi_grid_counts": q_multi_grid_counts,
    "mercator_bins": q_mercator_bins,
    "bin_hits": q_bin_hits,
    "bin_counts": q_bin_counts,
    "bin_counts_pyramid": q_bin_counts_pyramid,
    "bin_counts_decay": q_bin_counts_decay,
    "dense_tiles_summary": q_dense_tiles_summary,
    "pipeline_tripline": q_pipeline_tripline,
    "pipeline_mercator": q_pipeline_mercator,
    "segment_count_consecutive": q_segment_count_consecutive,
    "text_points_unpadded": q_text_points_unpadded,
    "log_round_trip": q_log_round_trip,
    "text_round_trip": q_text_round_trip,
    "table_points": q_table_points,
    "segments_dirty_consecutive": q_segments_dirty_consecutive,
    "segments_dirty_anchored": q_segments_dirty_anchored,
    "segments_anchored_interleaved": q_segments_anchored_interleaved,
    "segments_anchored_sparse": q_segments_anchored_sparse,
    "segments_same_second": q_segments_same_second,
    "segments_stored": q_segments_stored,
    "cell_track_pairs": q_cell_track_pairs,
    "cell_track_id_parts": q_cell_track_id_parts,
    "multi_grid_index": q_multi_grid_index,
    "segments_through_region": q_segments_through_region,
    "count_export_round_trip": q_count_export_round_trip,
    "stage_round_trip": q_stage_round_trip,
    "tiles_round_trip": q_tiles_round_trip,
    "published_partitions": q_published_partitions,
    "reject_counts": q_reject_counts,
    "tile_set_merged": q_tile_set_merged,
    "pipeline_tripline_ids": q_pipeline_tripline_ids,
    "pipeline_tripline_velocity": q_pipeline_tripline_velocity,
    "pipeline_tripline_direction": q_pipeline_tripline_direction,
    "pipeline_tripline_coarse": q_pipeline_tripline_coarse,
    "pipeline_mercator_tiles": q_pipeline_mercator_tiles,
}
