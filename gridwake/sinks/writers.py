"""Writers: each call runs its Spark job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNT_EXPORT_HEADER = ["latitude", "longitude", "count", "date"]


def write_stage(df: DataFrame, target: str, fmt: str = "parquet", as_table: bool = False,
                partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> None:
    """Replace a stage result: a catalog table (``as_table``) or a path.

    The new result is written beside the old one and takes its place when it
    is complete, so a job that fails leaves the old result, and ``df`` may
    read the target. Where readers must not notice the change at all, use
    ``publish``, whose readers go by a manifest."""
    spark, spare = df.sparkSession, uuid.uuid4().hex
    if as_table:
        catalog_name = f"{target}_new_{spare[:8]}"
        writer = df.write.format(fmt).options(**options or {})
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(catalog_name)
        spark.sql(f"drop table if exists {target}")
        spark.sql(f"alter table {catalog_name} rename to {target}")
        return
    path = target.rstrip("/")
    writer = df.write.format(fmt).options(**options or {})
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{path}.new-{spare}")
    place, fresh, old = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
                         for p in (path, f"{path}.new-{spare}", f"{path}.old-{spare}"))
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"{path} could not be moved away; the new result is in {fresh}")
    if not files.rename(fresh, place):
        if had:
            files.rename(old, place)
        raise OSError(f"{fresh} could not be moved to {path}")
    if had:
        files.delete(old, True)


def write_positions(points: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store positions as a catalog table in ``buckets`` by ``id``, sorted by
    ``id, dt, lat, lon``: both path rules read such a table without shuffling
    it, as long as no id needs splitting. Choose ``buckets`` for about the size
    of a partition each; rows are brought together by id first, so that each
    bucket is one file."""
    writer = (points.repartition(buckets, "id").write.mode("overwrite").format("parquet")
              .bucketBy(buckets, "id").sortBy("id", "dt", "lat", "lon"))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def export_counts(counts: DataFrame, path: str) -> None:
    """Cell counts as tab-separated text, ordered by place and date, with one
    header ``latitude longitude count date``: the part files, put together by
    name, are the whole file. Rows are sorted by range over tasks; the header
    is the row that sorts first."""
    keys = ["lat", "lon", "dt", "value"]
    rows = counts.select(F.lit(1).alias("_data"), *keys, *[F.col(c).cast("string").alias(name) for c, name in
                                                           zip(("lat", "lon", "value", "dt"), COUNT_EXPORT_HEADER)])
    header = counts.sparkSession.range(1).select(
        F.lit(0).alias("_data"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in keys],
        *[F.lit(name).alias(name) for name in COUNT_EXPORT_HEADER])
    lines = header.unionByName(rows).orderBy("_data", *keys).select(*COUNT_EXPORT_HEADER)
    write_stage(lines, path, fmt="csv", options={"sep": "\t", "header": "false"})


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``export_counts``: ``latitude, longitude, count, date``."""
    lines = spark.read.text(path).where(F.col("value") != "\t".join(COUNT_EXPORT_HEADER))
    field = F.split("value", "\t", -1)
    return lines.select(F.nullif(field[0], F.lit("")).cast("double").alias("latitude"),
                        F.nullif(field[1], F.lit("")).cast("double").alias("longitude"),
                        F.nullif(field[2], F.lit("")).cast("bigint").alias("count"),
                        F.nullif(field[3], F.lit("")).alias("date"))


def write_tiles(tiles: DataFrame, path: str, name: str = "tiles", description: str = "") -> None:
    """One tile set per level under ``path`` (Parquet, partitioned by level),
    each row ``tile_x, tile_y, bins`` plus the set's name and description."""
    (tiles.withColumn("name", F.lit(name)).withColumn("description", F.lit(description))
     .write.mode("overwrite").partitionBy("level").parquet(path))


def write_cell_tables(cell_stats: DataFrame, base_path: str, fmt: str = "parquet") -> dict[str, str]:
    """Write the per-cell stats once, then the count, velocity and direction
    tables as projections read back from that written table, so the path,
    crossing and aggregation work runs once for all of them. Returns the
    paths written."""
    base = base_path.rstrip("/")
    paths = {name: f"{base}/{name}" for name in ("cell_stats", "counts", "velocity", "direction")}
    write_stage(cell_stats, paths["cell_stats"], fmt=fmt)
    stats = cell_stats.sparkSession.read.format(fmt).load(paths["cell_stats"])
    keys = [c for c in ("grid", "lat_idx", "lon_idx", "lat", "lon", "dt") if c in stats.columns]
    for name, col in (("counts", "value"), ("velocity", "velocity"), ("direction", "direction")):
        write_stage(stats.select(*keys, col), paths[name], fmt=fmt)
    return paths
