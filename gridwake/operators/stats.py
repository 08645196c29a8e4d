"""Per-cell aggregates of crossings.

Counts, mean velocity and mean bearing share one key, so they are computed
by one ``groupBy`` (partial aggregation before the shuffle, so a hot cell
costs no more than a cold one) and projected into the three tables.
Cells are grouped on integer indices; labels are functions of the indices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import LABEL_FORMAT
from ..session import intermediate
from .sequence import numbered

CELL_KEYS = ["grid", "lat_idx", "lon_idx", "dt"]


def _keyed(crossings: DataFrame) -> tuple[DataFrame, list[str], bool]:
    """Group on the bucket timestamp when present (cheaper than text per
    crossing); the ``dt`` text is then rendered once per group."""
    if "bucket_ts" in crossings.columns:
        return crossings.drop("dt"), ["grid", "lat_idx", "lon_idx", "bucket_ts"], True
    return crossings, CELL_KEYS, False


def _with_dt(df: DataFrame, from_ts: bool) -> DataFrame:
    if not from_ts:
        return df
    return df.withColumn("dt", F.date_format("bucket_ts", LABEL_FORMAT)).drop("bucket_ts")


def _cells(crossings: DataFrame, label_keys: bool) -> tuple[DataFrame, list[str], bool, list]:
    """Frame, group keys, whether ``dt`` is rendered later, and the columns
    that name a cell without being keys. With index keys the labels follow
    from them; with ``label_keys`` (legacy: coarse rounded labels may merge
    cells) the smallest indices stand for the merged ones."""
    x, keys, from_ts = _keyed(crossings)
    if label_keys:
        return x, ["grid", "lat", "lon", keys[-1]], from_ts, [F.min("lat_idx").alias("lat_idx"),
                                                              F.min("lon_idx").alias("lon_idx")]
    return x, keys, from_ts, [F.min("lat").alias("lat"), F.min("lon").alias("lon")]


def cell_stats(crossings: DataFrame, label_keys: bool = False) -> DataFrame:
    """One row per (grid, cell, time bucket): ``value`` (crossings),
    ``velocity`` (mean, -1 sentinels included), ``direction`` (arithmetic
    mean bearing truncated to int, so 359 and 1 give 180).

    ``label_keys=True`` groups on the rounded labels instead of the indices."""
    x, keys, from_ts, extra = _cells(crossings, label_keys)
    out = (x.groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("value"),
                F.avg("velocity").alias("velocity"),
                F.avg("direction").alias("_dir"),
                *extra)
           .withColumn("direction", F.col("_dir").cast("int"))
           .drop("_dir"))
    return _with_dt(out, from_ts)


def cell_counts(crossings: DataFrame) -> DataFrame:
    return cell_stats(crossings).select("grid", "lat_idx", "lon_idx", "lat", "lon", "dt", "value")


def cell_velocity(crossings: DataFrame) -> DataFrame:
    return cell_stats(crossings).select("grid", "lat_idx", "lon_idx", "lat", "lon", "dt", "velocity")


def cell_direction(crossings: DataFrame) -> DataFrame:
    return cell_stats(crossings).select("grid", "lat_idx", "lon_idx", "lat", "lon", "dt", "direction")


def cell_track_ids(crossings: DataFrame, sep: str = ",", label_keys: bool = False) -> DataFrame:
    """Distinct track ids per cell and bucket, sorted and joined by ``sep``.

    One ``groupBy`` with ``collect_set``: duplicates are removed map-side
    (partial aggregation) before the single shuffle. The list is the result
    asked for and one row long: with few large cells or ``temporal_split=
    "all"`` use ``cell_track_id_parts``, which bounds a row, or
    ``cell_track_pairs``, which holds one row per track."""
    x, keys, from_ts, extra = _cells(crossings, label_keys)
    out = (x.groupBy(*keys).agg(F.collect_set("track_id").alias("_ids"), *extra)
           .select("grid", "lat_idx", "lon_idx", "lat", "lon", keys[-1],
                   F.size("_ids").cast("bigint").alias("n_tracks"),
                   F.array_join(F.array_sort("_ids"), sep).alias("ids")))
    return _with_dt(out, from_ts)


def cell_track_pairs(crossings: DataFrame, label_keys: bool = False) -> DataFrame:
    """Long form of the id lists: one row per (cell, bucket, track) with the
    number of crossings; no per-cell collection at all."""
    x, keys, from_ts, extra = _cells(crossings, label_keys)
    out = x.groupBy(*keys, "track_id").agg(F.count(F.lit(1)).alias("n_crossings"), *extra)
    return _with_dt(out, from_ts)


def cell_track_id_parts(crossings: DataFrame, part_size: int = 10_000, sep: str = ",",
                        label_keys: bool = False) -> DataFrame:
    """The id lists of ``cell_track_ids`` in numbered parts of at most
    ``part_size`` ids: ``part`` (from 0), ``n_parts``, ``n_tracks`` (of the
    cell) and ``ids``. Parts follow each other in id order, so a cell's parts
    joined by ``sep`` are its whole list.

    Ids are made distinct with partial aggregation, then sorted by range over
    cells and ids, so a cell with most of the ids is spread over tasks and no
    row holds more than a part. Writes the distinct pairs once."""
    x, keys, from_ts, extra = _cells(crossings, label_keys)
    pairs = intermediate(x.groupBy(*keys, "track_id").agg(*extra), "cell-tracks")
    others = ["lat_idx", "lon_idx", "lat", "lon"]
    placed = numbered(pairs, keys, ["track_id"])
    part = F.floor(F.col("idx") / part_size)
    out = (placed.groupBy(*keys, part.alias("part"))
           .agg(F.array_sort(F.collect_list("track_id")).alias("_ids"), F.max("n").alias("n_tracks"),
                *[F.min(c).alias(c) for c in others if c not in keys])
           .select("grid", *others, keys[-1], "part", F.ceil(F.col("n_tracks") / part_size).alias("n_parts"), "n_tracks",
                   F.array_join("_ids", sep).alias("ids")))
    return _with_dt(out, from_ts)
