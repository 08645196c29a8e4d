import datetime
import random
import time

from pyspark.sql import functions as F

from gridwake.config import Grid, Limits, Region
from gridwake.operators.crossings import crossings, filter_segments_region
from gridwake.operators.paths import segments_anchored, segments_consecutive
from gridwake.operators.stats import cell_stats, cell_track_id_parts, cell_track_ids, cell_track_pairs

WORLD = Region(-90.0, -360.0, 90.0, 180.0)


def seg_of(points, rows, anchored=True):
    p = points(rows)
    lim = Limits(time_s=86400, distance_km=1000)
    return segments_anchored(p, lim) if anchored else segments_consecutive(p, lim)


def hits(df):
    return sorted((r.axis, r.lat, r.lon, r.crossing_ts.timestamp()) for r in df.collect())


def test_vertical_hits_h1(points):
    s = seg_of(points, [("a", 0, 0.05, 0.05), ("a", 3600, 0.05, 0.25)])
    x = crossings(s, Grid(0.1, 0.1, WORLD), temporal_split="other")
    assert hits(x) == [("lon", 0.05, 0.15, 1800.0), ("lon", 0.05, 0.25, 3600.0)]


def test_same_cell_no_crossing_h2(points):
    s = seg_of(points, [("a", 0, 0.01, 0.01), ("a", 60, 0.02, 0.02)])
    assert s.count() == 1
    assert crossings(s, Grid(0.1, 0.1, WORLD)).count() == 0


def test_point_on_line_hit_twice_h10(points):
    s = seg_of(points, [("a", 0, -1.0, 0.05), ("a", 3600, 0.0, 0.05), ("a", 7200, 1.0, 0.05)])
    x = crossings(s, Grid(1.0, 1.0, WORLD), axes=("lat",)).collect()
    zero = [r for r in x if r.lat_idx == 0]
    assert len(zero) == 2


def test_antimeridian_modes_h11(points):
    s = seg_of(points, [("a", 0, 0.0, 179.95), ("a", 3600, 0.0, -179.95)])
    short = crossings(s, Grid(0.1, 0.1, WORLD), dateline="short_way").collect()
    assert [(r.lat, r.lon) for r in short] == [(0.05, -179.95)]
    lit = crossings(s, Grid(0.1, 0.1, WORLD), dateline="literal").collect()
    assert [(r.lat, r.lon) for r in lit] == [(0.05, -179.85)]


def test_region_filter_h13(points):
    s = seg_of(points, [("a", 0, 0.5, -1.5), ("a", 3600, 0.5, 1.5)])
    g = Grid(0.1, 0.1, Region(0.0, -1.0, 1.0, 1.0))
    assert filter_segments_region(s, g).count() == 0
    assert crossings(s, g).count() == 0
    assert crossings(s, Grid(0.1, 0.1, WORLD)).count() > 0


def test_arithmetic_mean_bearing_h15(spark):
    x = spark.createDataFrame(
        [("g", 1, 1, "t", 10.0, 359.0, "a"), ("g", 1, 1, "t", 20.0, 1.0, "b")],
        "grid string, lat_idx long, lon_idx long, dt string, velocity double, direction double, track_id string"
    ).withColumn("lat", F.lit(0.15)).withColumn("lon", F.lit(0.15))
    r = cell_stats(x).first()
    assert (r.value, r.velocity, r.direction) == (2, 15.0, 180)
    ids = cell_track_ids(x).first()
    assert (ids.n_tracks, ids.ids) == (2, "a,b")
    assert cell_track_pairs(x).count() == 2


def test_multi_grid_labels(points):
    s = seg_of(points, [("a", 0, 0.05, 0.05), ("a", 3600, 0.05, 2.25)], anchored=False)
    grids = [Grid(0.1, 0.1, WORLD, "fine"), Grid(1.0, 1.0, WORLD, "coarse")]
    x = crossings(s, grids)
    by = {r.grid: r.n for r in x.groupBy("grid").agg(F.count("*").alias("n")).collect()}
    assert by == {"fine": 22, "coarse": 2}


def test_reference_digits_and_origin(points):
    s = seg_of(points, [("a", 0, -0.5, -0.5), ("a", 3600, 0.5, 0.5)])
    keep = crossings(s, Grid(1.0, 1.0, WORLD)).collect()
    drop = crossings(s, Grid(1.0, 1.0, WORLD), origin_hit="drop").collect()
    assert len(keep) == 2 and len(drop) == 0
    ref = crossings(s, Grid(1.0, 1.0, WORLD), digits="reference").collect()
    # labels round half away from zero at 0 digits: both hits at the origin label (1, 1)
    assert sorted((r.lat, r.lon) for r in ref) == [(1.0, 1.0), (1.0, 1.0)]


def test_crossing_sign(points):
    s = seg_of(points, [("a", 0, 0.05, 0.25), ("a", 3600, 0.05, 0.05)])
    x = crossings(s, Grid(0.1, 0.1, WORLD), with_sign=True).collect()
    assert {r.sign for r in x} == {-1}


def _closed_intersect(a, b, c, d):
    """Exact closed-segment intersection test (rational arithmetic)."""
    from fractions import Fraction as Q

    def orient(p, q, r):
        v = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        return (v > 0) - (v < 0)

    def on(p, q, r):
        return min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    a, b, c, d = ([Q(x) for x in p] for p in (a, b, c, d))
    o1, o2, o3, o4 = orient(a, b, c), orient(a, b, d), orient(c, d, a), orient(c, d, b)
    if o1 != o2 and o3 != o4:
        return True
    return ((o1 == 0 and on(a, b, c)) or (o2 == 0 and on(a, b, d))
            or (o3 == 0 and on(c, d, a)) or (o4 == 0 and on(c, d, b)))


def test_crossings_equal_general_intersection(spark):
    import math
    import random
    from datetime import datetime, timezone
    rnd = random.Random(3)
    res = 0.5
    region = Region(-10.0, -10.0, 10.0, 10.0)
    rows, expected = [], set()
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for i in range(300):
        a = (rnd.uniform(-9, 9), rnd.uniform(-9, 9))
        b = (a[0] + rnd.uniform(-3, 3), a[1] + rnd.uniform(-3, 3))
        if rnd.random() < 0.1:
            b = (a[0], b[1])          # parallel to latitude lines
        rows.append((f"s{i}", a[0], a[1], b[0], b[1]))
        lo_k, hi_k = math.floor(region.lat_min / res), math.ceil(region.lat_max / res)
        for k in range(lo_k, hi_k):
            y = k * res
            c, d = (y, region.lon_min), (y, region.lon_max)
            if a[0] != b[0] and _closed_intersect(a, b, c, d):
                expected.add((f"s{i}", "lat", k))
        lo_k, hi_k = math.floor(region.lon_min / res), math.ceil(region.lon_max / res)
        for k in range(lo_k, hi_k):
            x = k * res
            c, d = (region.lat_min, x), (region.lat_max, x)
            if a[1] != b[1] and _closed_intersect(a, b, c, d):
                expected.add((f"s{i}", "lon", k))
    seg = spark.createDataFrame(rows, "id string, alat double, alon double, blat double, blon double") \
        .withColumn("adt", F.lit(t0)).withColumn("velocity_kmh", F.lit(10.0))
    got = crossings(seg, Grid(res, res, region)).collect()
    have = {(r.track_id, r.axis, r.lat_idx if r.axis == "lat" else r.lon_idx) for r in got}
    assert len(got) == len(have)
    assert have == expected


def segments_of(spark, rows):
    return spark.createDataFrame(
        [(f"s{i}", a, b, c, d, datetime.datetime(2024, 1, 1, i % 24), 10.0 + i) for i, (a, b, c, d) in enumerate(rows)],
        "id string, alat double, alon double, blat double, blon double, adt timestamp, velocity_kmh double")


def test_many_grids_equal_one_grid_at_a_time(spark):
    """Grids of all sizes, resolutions and digits, overlapping; segments with
    ends in one, both and neither, over the antimeridian, NaN and infinite."""
    rng = random.Random(11)
    grids = [Grid(), Grid(0.5, 1.0, Region(-10.0, -20.0, 10.0, 20.0), "a"), Grid(3.0, 3.0, Region(-90.0, -360.0, 90.0, 180.0), "b"),
             Grid(0.01, 0.02, Region(1.0, 1.0, 1.3, 1.2), "c"), Grid(0.25, 0.25, Region(5.0, 170.0, 9.0, 180.0), "d")]
    grids += [Grid(0.2, 0.2, Region(x := rng.uniform(-20, 18), y := rng.uniform(-20, 18), x + rng.uniform(0.1, 6), y + rng.uniform(0.1, 6)), f"r{i}")
              for i in range(7)]
    rows = [(rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(-20, 20)) for _ in range(40)]
    rows += [(6.0, 179.0, 7.0, -179.5), (1.1, 1.1, 1.2, 1.15), (0.0, 0.0, 0.0, 1.0), (float("nan"), 1.0, 2.0, 1.5), (5.0, 180.0, 9.0, 170.0)]
    seg = segments_of(spark, rows)
    for digits, some in (("exact", grids), ("reference", grids[:4])):
        alone = None
        for g in some:
            x = crossings(seg, g, digits=digits)
            alone = x if alone is None else alone.unionByName(x)
        together = crossings(seg, some, digits=digits)
        assert together.count() == alone.count() > 1000
        assert together.exceptAll(alone).count() == 0


def test_thousands_of_grids_plan_quickly(spark):
    grids = [Grid(0.1, 0.1, Region(a * 0.4, b * 1.5, a * 0.4 + 0.3, b * 1.5 + 1.0), f"{a}-{b}") for a in range(50) for b in range(40)]
    seg = segments_of(spark, [(0.05, 0.05, 0.25, 0.25), (19.65, 58.6, 19.7, 58.9), (50.0, 50.0, 51.0, 51.0)])
    began = time.time()
    x = crossings(seg, grids)
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert time.time() - began < 10 and len(plan) < 200_000
    assert {r.grid for r in x.select("grid").distinct().collect()} == {"0-0", "49-39"}


def test_segments_through_a_region(spark):
    """Against walking along the segment in small steps."""
    rng = random.Random(2)
    grid = Grid(1.0, 1.0, Region(-5.0, 150.0, 5.0, 179.0))
    west = Grid(1.0, 1.0, Region(-5.0, -200.0, 5.0, -170.0))
    rows = [(rng.uniform(-20, 20), rng.choice([rng.uniform(120, 179.9), rng.uniform(-179.9, -140)]),
             rng.uniform(-20, 20), rng.choice([rng.uniform(120, 179.9), rng.uniform(-179.9, -140)])) for _ in range(300)]
    rows += [(0.0, 140.0, 0.0, 179.5), (6.0, 140.0, 6.0, 179.5), (-9.0, 160.0, 9.0, 160.0), (5.0, 140.0, 5.0, 149.0), (5.0, 150.0, 9.0, 140.0)]
    seg = segments_of(spark, rows)
    for g in (grid, west):
        r = g.region

        def walk(a, b, c, d):
            if abs(b - d) > 180:
                b, d = (b - 360, d) if b > d else (b, d - 360)
            for i in range(4001):
                lat, lon = a + (c - a) * i / 4000, b + (d - b) * i / 4000
                if r.lat_min <= lat <= r.lat_max and any(r.lon_min <= lon + turn <= r.lon_max for turn in (0, 360)):
                    return True
            return False
        got = {x.id for x in filter_segments_region(seg, g, through=True).collect()}
        want = {f"s{i}" for i, row in enumerate(rows) if walk(*row)}
        assert want <= got and len(got - want) <= 2          # the walk may step over a corner
        ends = {x.id for x in filter_segments_region(seg, g).collect()}
        assert ends < got
        through = crossings(seg, g, through=True)
        plain = crossings(seg, g)
        assert plain.exceptAll(through).count() == 0 and through.count() > plain.count()


def test_id_parts_joined_are_the_whole_list(spark):
    rows = [("grid", k % 3, 0, 0.5, 0.5, "2024-01-01 00:00:00", f"t{(k * 7919) % 400}") for k in range(3000)]
    rows += [("grid", 9, 9, 9.5, 9.5, "2024-01-01 00:00:00", None)]
    x = spark.createDataFrame(rows, "grid string, lat_idx long, lon_idx long, lat double, lon double, dt string, track_id string")
    whole = {(r.lat_idx, r.lon_idx): (r.ids, r.n_tracks) for r in cell_track_ids(x.where("track_id is not null")).collect()}
    parts = {}
    for r in cell_track_id_parts(x.where("track_id is not null"), part_size=16).collect():
        assert len(r.ids.split(",")) <= 16
        parts.setdefault((r.lat_idx, r.lon_idx), []).append(r)
    assert set(parts) == set(whole)
    for cell, found in parts.items():
        found.sort(key=lambda r: r.part)
        assert [r.part for r in found] == list(range(found[0].n_parts))
        assert (",".join(r.ids for r in found), found[0].n_tracks) == whole[cell]


def test_cell_centres_round_as_round_does(spark):
    from gridwake.operators.crossings import _round_centre
    idx = spark.range(-4000, 4000).select(F.col("id").alias("k"))
    for res, digits in ((0.1, 2), (0.25, 3), (0.5, 2), (1.0, 1), (10.0, 1), (0.05, 3), (0.003, 4), (0.0007, 5), (1 / 3, 17)):
        value = (F.col("k") + 0.5) * F.lit(res)
        assert idx.where(~_round_centre(value, digits).eqNullSafe(F.round(value, digits))).isEmpty(), res


def test_stages_too_long_for_the_jit_are_not_fused(spark, points):
    from gridwake.session import METHOD_BYTES, METHOD_LIMIT
    spark.conf.unset(METHOD_LIMIT)
    crossings(seg_of(points, [("a", 0, 0.05, 0.05), ("a", 3600, 0.05, 0.25)]), Grid(0.1, 0.1, WORLD))
    assert int(spark.conf.get(METHOD_LIMIT)) == METHOD_BYTES
    spark.conf.set(METHOD_LIMIT, "4000")
    crossings(seg_of(points, [("a", 0, 0.05, 0.05), ("a", 3600, 0.05, 0.25)]), Grid(0.1, 0.1, WORLD))
    assert spark.conf.get(METHOD_LIMIT) == "4000"
    spark.conf.unset(METHOD_LIMIT)
