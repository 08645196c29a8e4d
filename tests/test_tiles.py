from pyspark.sql import functions as F

from gridwake.config import Limits
from gridwake.operators.paths import segments_consecutive
from gridwake.operators.tiles import bin_counts, bin_hits, dense_tiles, raster_plane


def line(spark, x1, y1, x2, y2, world=1024, precision="exact"):
    p = spark.createDataFrame([(1, world, x1, y1, x2, y2)],
                              "level int, world long, x1 long, y1 long, x2 long, y2 long")
    return [(r.x, r.y) for r in raster_plane(p, precision).orderBy("x", "y").collect()]


def test_exact_line_h16(spark):
    assert line(spark, 0, 0, 4, 2) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]
    assert line(spark, 0, 0, 4, 2, precision="float32") == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]


def test_steep_line_has_gaps_h17(spark):
    assert line(spark, 0, 0, 1, 9) == [(0, 0), (1, 9)]


def test_vertical_run(spark):
    assert line(spark, 3, 5, 3, 2) == [(3, 2), (3, 3), (3, 4), (3, 5)]


def test_wrapped_line_h18(spark):
    w = 1024
    got = line(spark, 1, 7, w - 2, 7, world=w)
    assert sorted(x % w for x, _ in got) == sorted([w - 2, w - 1, 0, 1])


def test_counts_and_dense_tiles(spark, points):
    p = points([("a", 0, 10.0, 10.0), ("a", 600, 10.5, 12.0), ("a", 1200, 11.0, 13.0),
                ("b", 0, -30.0, 100.0), ("b", 600, -30.2, 101.0)])
    seg = segments_consecutive(p, Limits(time_s=86400, distance_km=1000))
    h = bin_hits(seg, 3)
    c = bin_counts(h)
    assert c.agg(F.sum("value")).first()[0] == h.count()
    t = dense_tiles(c)
    rows = t.collect()
    assert all(len(r.bins) == 65536 for r in rows)
    dense_total = sum(sum(r.bins) for r in rows)
    assert dense_total == h.count()
    # every sparse bin sits at slot bin_x + 256 * bin_y
    sparse = {(r.level, r.tile_x, r.tile_y, r.bin_x + 256 * r.bin_y): r.value for r in c.collect()}
    for r in rows:
        for i, v in enumerate(r.bins):
            if v:
                assert sparse[(r.level, r.tile_x, r.tile_y, i)] == v


def test_plane_offset_moves_one_bin_north(spark, points):
    p = points([("a", 0, 10.0, 10.0), ("a", 600, 10.0, 10.5)])
    seg = segments_consecutive(p)
    a = {(r.tile_x, r.bin_x, r.tile_y * 256 + 255 - r.bin_y) for r in bin_hits(seg, 4).collect()}
    b = {(r.tile_x, r.bin_x, r.tile_y * 256 + 255 - r.bin_y - 1) for r in bin_hits(seg, 4, plane_offset=1).collect()}
    assert a == b
