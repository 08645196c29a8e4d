"""Tile sets that grow: sparse bin counts with a description beside them.

The counts are published in partitions of ``level`` and ``band`` (``BAND``
tile columns), the description as one row per partition. A new batch is added
to the partitions it touches only; all others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import intermediate, release
from .published import current, publish, read_published

BAND = 8
KEYS = ["level", "band"]


def _paths(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}/counts", f"{path.rstrip('/')}/description"


def merge_tile_set(counts: DataFrame, path: str, name: str = "tiles", description: str = "") -> None:
    """Add sparse counts (``level, tile_x, tile_y, bin_x, bin_y, value``) to
    the tile set in ``path``, which is created if there is none. Bins add up,
    so halves merged one after the other equal the whole."""
    spark, (data, about) = counts.sparkSession, _paths(path)
    bins = ["level", "band", "tile_x", "tile_y", "bin_x", "bin_y"]
    new = intermediate(counts.withColumn("band", F.floor(F.col("tile_x") / BAND))
                       .groupBy(*bins).agg(F.sum("value").cast("bigint").alias("value")), "tiles-new")
    merged = new
    if current(spark, data):
        # partitions without new rows are pruned from the scan
        touched = new.select(*KEYS).distinct()
        old = read_published(spark, data).join(touched, KEYS, "left_semi")
        merged = new.unionByName(old).groupBy(*bins).agg(F.sum("value").cast("bigint").alias("value"))
    publish(merged.select(*bins, "value"), data, partition_by=KEYS, touched_only=True)
    stats = (read_published(spark, data).join(new.select(*KEYS).distinct(), KEYS, "left_semi").groupBy(*KEYS)
             .agg(F.countDistinct("tile_x", "tile_y").alias("n_tiles"), F.count(F.lit(1)).alias("n_bins"),
                  F.sum("value").alias("total"), F.max("value").alias("maximum"),
                  F.min("tile_x").alias("min_tile_x"), F.max("tile_x").alias("max_tile_x"),
                  F.min("tile_y").alias("min_tile_y"), F.max("tile_y").alias("max_tile_y"))
             .withColumn("name", F.lit(name)).withColumn("description", F.lit(description)))
    publish(stats, about, partition_by=KEYS, touched_only=True)
    release(new)


def read_tile_counts(spark: SparkSession, path: str) -> DataFrame:
    """The sparse counts of a tile set."""
    return read_published(spark, _paths(path)[0]).drop("band")


def describe_tile_set(spark: SparkSession, path: str) -> DataFrame:
    """One row per level: name, description, tiles, bins, total, the largest
    bin and the bounds in tiles. Bands hold whole tiles, so their rows add up."""
    rows = read_published(spark, _paths(path)[1])
    return rows.groupBy("level").agg(
        F.max("name").alias("name"), F.max("description").alias("description"), F.sum("n_tiles").alias("n_tiles"),
        F.sum("n_bins").alias("n_bins"), F.sum("total").alias("total"), F.max("maximum").alias("maximum"),
        F.min("min_tile_x").alias("min_tile_x"), F.max("max_tile_x").alias("max_tile_x"),
        F.min("min_tile_y").alias("min_tile_y"), F.max("max_tile_y").alias("max_tile_y"))
