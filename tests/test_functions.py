import math

from pyspark.sql import functions as F

from gridwake.config import label_digits
from gridwake.functions import bearing_deg, haversine_km, mercator_pixel, temporal_bucket, tile_of_pixel


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_haversine_and_bearing_h1(spark):
    r = one(spark, haversine_km(F.lit(0.05), F.lit(0.05), F.lit(0.05), F.lit(0.25)).alias("d"),
            bearing_deg(F.lit(0.05), F.lit(0.05), F.lit(0.05), F.lit(0.25)).alias("b"))
    assert round(r.d, 6) == 22.238977
    assert round(r.b, 6) == 89.999913


def test_antimeridian_distance_h11(spark):
    r = one(spark, haversine_km(F.lit(0.0), F.lit(179.95), F.lit(0.0), F.lit(-179.95)).alias("d"),
            bearing_deg(F.lit(0.0), F.lit(179.95), F.lit(0.0), F.lit(-179.95)).alias("b"))
    assert round(r.d, 6) == 11.119493
    assert round(r.b, 6) == 90.0


def test_temporal_buckets_h14(spark):
    ts = F.to_timestamp(F.lit("2024-01-01 10:37:12"))
    names = ["all", "year", "month", "day", "hour", "10min", "minute", "other", "HOUR"]
    r = one(spark, *[temporal_bucket(ts, n).alias(f"c{i}") for i, n in enumerate(names)])
    assert list(r) == ["9999-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-01 00:00:00",
                       "2024-01-01 00:00:00", "2024-01-01 10:00:00", "2024-01-01 10:30:00",
                       "2024-01-01 10:37:00", "2024-01-01 10:37:12", "2024-01-01 10:00:00"]


def test_label_digits():
    assert label_digits(0.1, "reference") == 2
    assert label_digits(0.01, "reference") == 5
    assert label_digits(0.001, "reference") == 7
    assert label_digits(1.0, "reference") == 0
    assert label_digits(10.0, "reference") == -2
    assert label_digits(0.1) == 2 and label_digits(0.25) == 3 and label_digits(1.0) == 1


def test_mercator_matches_definition(spark):
    lat, lon, level = 51.5, -0.12, 5
    r = one(spark, *[c.alias(n) for c, n in zip(
        mercator_pixel(F.lit(lat), F.lit(lon), F.lit(level)), ("px", "py"))])
    n = 256 * 2 ** level
    px = math.floor((lon + 180) / 360 * n)
    py = math.floor((0.5 + math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) / (2 * math.pi)) * n)
    assert (r.px, r.py) == (px, py)
    t = one(spark, *[c.alias(n) for c, n in zip(tile_of_pixel(F.lit(px), F.lit(py)), ("tx", "ty", "bx", "by"))])
    assert (t.tx, t.ty, t.bx, t.by) == (px // 256, py // 256, px % 256, 255 - py % 256)


def test_mercator_clamps(spark):
    r = one(spark, *[c.alias(n) for c, n in zip(mercator_pixel(F.lit(89.9), F.lit(180.0), F.lit(1)), ("px", "py"))])
    assert (r.px, r.py) == (511, 511)
