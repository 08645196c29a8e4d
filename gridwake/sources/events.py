"""Positions derived from the ``events`` table.

The test tables carry no coordinates, so each event becomes a position
report by plain arithmetic (same order of operations in every engine, all
in double):

    id  = user_id
    dt  = ts truncated to the second
    lat = 35.0 + (user_id % 10) * 2 + value / 100.0
    l   = -180.0 + (user_id * 37) % 360 + (k * 5309 + 137) / 100000.0
    lon = l - 360 if l >= 180 else l          (k = props.k as bigint)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

K_PATTERN = r'"k":\s*(-?\d+)'


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def event_lat() -> Column:
    return F.lit(35.0) + (F.col("user_id") % 10) * 2 + F.col("value") / F.lit(100.0)


def event_lon() -> Column:
    k = F.regexp_extract(F.col("props"), K_PATTERN, 1).cast("bigint")
    raw = F.lit(-180.0) + (F.col("user_id") * 37) % 360 + (k * 5309 + 137) / F.lit(100000.0)
    return F.when(raw >= 180.0, raw - 360.0).otherwise(raw)


def points_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        F.date_trunc("second", F.col("ts")).alias("dt"),
        event_lat().alias("lat"),
        event_lon().alias("lon"),
    )


def read_event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_from_events(spark.read.parquet(events_path(sf_dir)))
