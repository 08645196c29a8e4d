"""Readers that turn raw position data into the ``points`` schema
``id string, dt timestamp, lat double, lon double``.

Unparseable times or coordinates become nulls (never exceptions) unless
``on_error="fail"``, in which case a bad row makes the job fail with a
message naming the row, as the strict legacy reader did.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COORD_TOLERANCE, Region
from ..functions.timefn import parse_dt

POINTS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("dt", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

# Fixed column layout of the raw comma-separated vessel log (all text).
POSITION_LOG_COLUMNS = ["ais_type", "mmsi", "name", "imo", "latitude", "longitude",
                        "speed", "heading", "time", "dest", "eta"]
POSITION_LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in POSITION_LOG_COLUMNS])

UTC_NAMES = {"utc", "etc/utc", "gmt", "z", "zulu", "uct", "etc/gmt", "+00:00", "utc+0", "gmt+0"}

# A reader is any callable (spark, **options) -> points DataFrame.
PointsReader = Callable[..., DataFrame]


def _check_zone(spark: SparkSession) -> None:
    """Times carry no zone and buckets are cut by the clock, so the session
    must not shift them: in a zone with daylight saving, two texts can become
    one instant."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.lower() not in UTC_NAMES:
        warnings.warn(f"spark.sql.session.timeZone is {zone}: times without a zone are read in it; set it to UTC",
                      stacklevel=3)


def read_position_log(spark: SparkSession, path: str) -> DataFrame:
    """Raw comma-delimited log, no header, 11 text columns. Commas alone
    separate fields: a double quote is an ordinary character here
    (``clean_fields`` removes it)."""
    return (spark.read.schema(POSITION_LOG_SCHEMA).option("sep", ",").option("header", False)
            .option("quote", "").option("escape", "").csv(path))


def normalise_positions(log: DataFrame) -> DataFrame:
    """``mmsi, latitude, longitude`` trimmed; compact ``yyMMddHHmm`` time
    text rewritten as ``20yy-MM-dd HH:mm:00`` (``dt`` stays text here)."""
    t = F.trim(F.col("time"))
    dt = F.concat(F.lit("20"), F.substring(t, 1, 2), F.lit("-"), F.substring(t, 3, 2), F.lit("-"),
                  F.substring(t, 5, 2), F.lit(" "), F.substring(t, 7, 2), F.lit(":"),
                  F.substring(t, 9, 2), F.lit(":00"))
    return log.select(F.trim("mmsi").alias("mmsi"), F.trim("latitude").alias("latitude"),
                      F.trim("longitude").alias("longitude"), dt.alias("dt"))


def clean_fields(df: DataFrame, columns: list[str]) -> DataFrame:
    """Remove every double quote from the given text columns and trim them."""
    out = df
    for c in columns:
        out = out.withColumn(c, F.trim(F.regexp_replace(F.col(c).cast("string"), '"', "")))
    return out


def to_points(df: DataFrame, id_col: str, dt_col: str, lat_col: str, lon_col: str,
              on_error: str = "drop") -> DataFrame:
    """Map configured column names to ``points``; text is cleaned (quotes,
    blanks), times parsed by ``parse_dt`` and coordinates by ``try_cast``."""
    _check_zone(df.sparkSession)
    cleaned = clean_fields(df.select(F.col(id_col).alias("id"), F.col(dt_col).alias("_dt"),
                                     F.col(lat_col).alias("_lat"), F.col(lon_col).alias("_lon")),
                           ["id", "_dt", "_lat", "_lon"])
    pts = cleaned.select(
        "id",
        parse_dt(F.col("_dt")).alias("dt"),
        F.col("_lat").try_cast("double").alias("lat"),
        F.col("_lon").try_cast("double").alias("lon"),
        "_dt", "_lat", "_lon",
    )
    return _apply_on_error(pts, on_error)


def _apply_on_error(pts: DataFrame, on_error: str) -> DataFrame:
    if on_error == "keep":
        return pts.select("id", "dt", "lat", "lon")
    bad = F.col("dt").isNull() | F.col("lat").isNull() | F.col("lon").isNull()
    if on_error == "fail":
        msg = F.concat(F.lit("Could not parse position row: "),
                       F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>"))
                                          for c in ("id", "_dt", "_lat", "_lon")]))
        return pts.select("id", F.when(bad, F.raise_error(msg)).otherwise(F.col("dt")).alias("dt"), "lat", "lon")
    if on_error == "mark":
        return pts.select("id", "dt", "lat", "lon", reject_reason().alias("reason"), F.col("_dt").alias("raw_dt"),
                          F.col("_lat").alias("raw_lat"), F.col("_lon").alias("raw_lon"))
    if on_error == "drop":
        return pts.where(~bad).select("id", "dt", "lat", "lon")
    raise ValueError("on_error must be 'drop', 'keep', 'mark' or 'fail'")


# why a row is no position; the first that applies counts
REASONS = ("id", "time", "latitude", "longitude")


def reject_reason() -> Column:
    """The field that spoils a row, null for a good one."""
    out = None
    for reason, c in zip(REASONS, ("id", "dt", "lat", "lon")):
        out = F.when(F.col(c).isNull(), reason) if out is None else out.when(F.col(c).isNull(), reason)
    return out


def store_positions(marked: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write positions read with ``on_error="mark"`` in one pass over the
    source: good rows and, by reason, rejected ones with their raw texts.
    Returns both as frames over what is written, and the number of good rows
    and of rejects per reason, observed while writing."""
    spark = marked.sparkSession
    reason = F.coalesce("reason", F.lit("none"))
    seen = Observation()
    observed = marked.withColumn("reason", reason).observe(
        seen, *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in ("none", *REASONS)])
    observed.write.partitionBy("reason").parquet(path)
    counts = seen.get
    stored = spark.read.schema(observed.schema).parquet(path)
    good = stored.where("reason = 'none'").select("id", "dt", "lat", "lon")
    bad = stored.where("reason <> 'none'").select("id", "reason", "raw_dt", "raw_lat", "raw_lon")
    return good, bad, {"good": counts["none"], **{r: counts[r] for r in REASONS}}


def points_from_table(spark: SparkSession, table: str, id_col: str, dt_col: str, lat_col: str,
                      lon_col: str, on_error: str = "keep") -> DataFrame:
    """``SELECT id, dt, lat, lon FROM table`` with configured column names.
    Default keeps bad rows as nulls so the anchored path rule can apply its
    own bad-row semantics."""
    return to_points(spark.table(table), id_col, dt_col, lat_col, lon_col, on_error)


def parse_text_lines(lines: DataFrame, id_idx: int = 0, lat_idx: int = 1, lon_idx: int = 2,
                     datetime_idx: int = -1, date_idx: int = -1, time_idx: int = -1,
                     sep: str = "\t", on_error: str = "drop") -> DataFrame:
    """Delimited text (column ``value``) picked by position.

    With ``datetime_idx >= 0`` the field holds ``date time`` or
    ``dateTtime`` with an optional fraction; otherwise ``date_idx`` holds
    ``yyyy-MM-dd`` and the first 8 characters of ``time_idx`` hold
    ``HH:mm:ss``. Other columns are ignored."""
    _check_zone(lines.sparkSession)
    tok = F.split(F.trim(F.col("value")), _regex_literal(sep))

    def at(i: int) -> Column:
        return F.try_element_at(tok, F.lit(i + 1))

    if datetime_idx >= 0:
        dt_text = at(datetime_idx)
    elif date_idx >= 0 and time_idx >= 0:
        dt_text = F.concat(at(date_idx), F.lit(" "), F.substring(at(time_idx), 1, 8))
    else:
        raise ValueError("give datetime_idx, or date_idx and time_idx")
    pts = lines.select(
        F.trim(at(id_idx)).alias("id"),
        parse_dt(dt_text).alias("dt"),
        F.trim(at(lat_idx)).try_cast("double").alias("lat"),
        F.trim(at(lon_idx)).try_cast("double").alias("lon"),
        dt_text.alias("_dt"), at(lat_idx).alias("_lat"), at(lon_idx).alias("_lon"),
    )
    return _apply_on_error(pts, on_error)


def points_from_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """Read tab-separated text files and parse them by column position."""
    return parse_text_lines(spark.read.text(path), **options)


def filter_region(points: DataFrame, region: Region, tol: float = COORD_TOLERANCE) -> DataFrame:
    """Keep points inside the closed region box (``tol`` on both axes).
    A plain row predicate, so Catalyst pushes it towards the scan."""
    return points.where(
        F.col("lat").between(min(region.lat_min, region.lat_max) - tol, max(region.lat_min, region.lat_max) + tol)
        & F.col("lon").between(min(region.lon_min, region.lon_max) - tol, max(region.lon_min, region.lon_max) + tol))


def read_points(spark: SparkSession, reader: PointsReader, **options) -> DataFrame:
    """Pluggable source: any callable returning the ``points`` columns."""
    df = reader(spark, **options)
    missing = {"id", "dt", "lat", "lon"} - set(df.columns)
    if missing:
        raise ValueError(f"reader result lacks columns {sorted(missing)}")
    return df.select(F.col("id").cast("string"), F.col("dt").cast("timestamp"),
                     F.col("lat").cast("double"), F.col("lon").cast("double"))


def _regex_literal(sep: str) -> str:
    import re
    return re.escape(sep)
