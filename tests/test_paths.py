import math
import random

import pytest

from gridwake.config import Limits
from gridwake.operators.paths import count_segments, segments_anchored, segments_consecutive

DAY = 86400


@pytest.fixture(autouse=True)
def small_pieces(monkeypatch):
    """Every time bucket is a chunk of its own, so that chunks are exercised."""
    from gridwake.operators import paths
    monkeypatch.setattr(paths, "PIECE_ROWS", 1)


def rows_of(df):
    return sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s, r.velocity_kmh)
                  for r in df.select("id", "alat", "alon", "blat", "blon", "time_s", "velocity_kmh").collect())


def test_gap_ends_anchored_track_h3(points):
    p = points([("a", 0, 0.0, 0.0), ("a", 3600, 0.0, 0.1), ("a", 93600, 0.0, 0.2), ("a", 97200, 0.0, 0.3)])
    lim = Limits(time_s=DAY, distance_km=1000)
    assert segments_anchored(p, lim).count() == 1
    assert segments_consecutive(p, lim).count() == 2


def test_outlier_bridged_h4(points):
    p = points([("a", 0, 0.0, 0.0), ("a", 60, 5.0, 5.0), ("a", 120, 0.0, 0.01)])
    lim = Limits(time_s=DAY, distance_km=100)
    a = segments_anchored(p, lim).collect()
    assert len(a) == 1 and (a[0].alat, a[0].alon, a[0].blat, a[0].blon) == (0.0, 0.0, 0.0, 0.01)
    assert segments_consecutive(p, lim).count() == 0


def test_zero_time_h5(points):
    p = points([("a", 0, 0.0, 0.0), ("a", 0, 0.0, 0.1)])
    a = segments_anchored(p, Limits(time_s=DAY, distance_km=100)).collect()
    assert len(a) == 1 and a[0].velocity_kmh == -1.0
    c = segments_consecutive(p, Limits(time_s=DAY, distance_km=100)).collect()
    assert len(c) == 1 and math.isinf(c[0].velocity_kmh)
    assert segments_consecutive(p, Limits(time_s=DAY, distance_km=100, velocity_kmh=1e9)).count() == 0


def test_stationary_refreshes_clock_h6(points):
    p = points([("a", 0, 1.0, 1.0), ("a", 50000, 1.0, 1.0), ("a", 100000, 1.0, 1.1)])
    a = segments_anchored(p, Limits(time_s=DAY, distance_km=100)).collect()
    assert len(a) == 1 and a[0].time_s == 50000.0 and (a[0].blat, a[0].blon) == (1.0, 1.1)


def test_bad_first_row_kills_id_h7(points):
    p = points([("a", 0, None, 0.0), ("a", 60, 0.0, 0.01), ("a", 120, 0.0, 0.02),
                ("b", 0, 0.0, 0.0), ("b", 60, 0.0, 0.01)])
    a = segments_anchored(p, Limits(time_s=DAY, distance_km=100)).collect()
    assert [r.id for r in a] == ["b"]


def test_bad_middle_rows_bridged_h8_h9(points):
    p = points([("a", 0, 0.0, 0.0), ("a", 60, None, 0.01), ("a", None, 0.0, 0.5), ("a", 120, 0.0, 0.02)])
    a = segments_anchored(p, Limits(time_s=DAY, distance_km=100)).collect()
    assert len(a) == 1 and (a[0].alon, a[0].blon) == (0.0, 0.02)


def test_limit_equality_h12(spark, points):
    p = points([("a", 0, 0.0, 0.0), ("a", 60, 0.0, 0.5)])
    dist = segments_consecutive(p).first().distance_km
    assert segments_anchored(p, Limits(time_s=DAY, distance_km=dist)).count() == 1
    assert segments_consecutive(p, Limits(time_s=DAY, distance_km=dist)).count() == 0
    assert segments_anchored(p, Limits(time_s=60, distance_km=1e9)).count() == 1
    assert segments_consecutive(p, Limits(time_s=60, distance_km=1e9)).count() == 0


def test_count_segments(points):
    p = points([("a", 0, 0.0, 0.0), ("a", 60, 0.0, 0.1), ("b", 0, 1.0, 1.0), ("b", 60, 1.0, 1.1),
                ("b", 120, 1.0, 1.2)])
    seg = segments_consecutive(p)
    assert count_segments(seg).first().n_segments == 3
    assert {r.id: r.n_segments for r in count_segments(seg, by_id=True).collect()} == {"a": 1, "b": 2}


# ----------------------------------------------------------------- property tests

def _hav(a1, o1, a2, o2):
    if a1 < -90 and a2 > 90:
        a2 -= 360
    elif a2 < -90 and a1 > 90:
        a1 -= 360
    if o1 < -90 and o2 > 90:
        o2 -= 360
    elif o2 < -90 and o1 > 90:
        o1 -= 360
    dl, do = math.radians(a2 - a1), math.radians(o2 - o1)
    a = math.sin(dl / 2) ** 2 + math.cos(math.radians(a1)) * math.cos(math.radians(a2)) * math.sin(do / 2) ** 2
    a = min(max(a, 0.0), 1.0)
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def loop_anchored(rows, T, D):
    out = []
    by = {}
    for r in rows:
        if r[1] is not None:
            by.setdefault(r[0], []).append(r)
    for k, rs in by.items():
        rs.sort(key=lambda r: (r[1], r[2] is not None, r[2] or 0.0, r[3] is not None, r[3] or 0.0))
        anchor = rs[0]
        for r in rs[1:]:
            t = r[1] - anchor[1]
            if t > T:
                continue
            if None in (anchor[2], anchor[3], r[2], r[3]):
                continue
            d = _hav(anchor[2], anchor[3], r[2], r[3])
            if d > D:
                continue
            if abs(anchor[2] - r[2]) + abs(anchor[3] - r[3]) > 0:
                out.append((k, anchor[2], anchor[3], r[2], r[3], float(t)))
            anchor = r
    return sorted(out)


def loop_consecutive(rows, T, D):
    out = []
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for k, rs in by.items():
        rs.sort(key=lambda r: (r[1], r[2], r[3]))
        for p, r in zip(rs, rs[1:]):
            t, d = r[1] - p[1], _hav(p[2], p[3], r[2], r[3])
            if 0 < d < D and t < T:
                out.append((k, p[2], p[3], r[2], r[3], float(t)))
    return sorted(out)


def random_tracks(seed, n_ids=25, n_rows=60, bad=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_ids):
        t, lat, lon = rnd.randint(0, 10 ** 6), rnd.uniform(-60, 60), rnd.uniform(-179, 179)
        for _ in range(rnd.randint(1, n_rows)):
            t += rnd.choice([0, 30, 600, 3600, 7200, 30000, 90000]) if rnd.random() < 0.9 else 200000
            if rnd.random() < 0.15:   # outlier
                rows.append((f"id{i}", t, lat + rnd.uniform(-20, 20), lon + rnd.uniform(-20, 20)))
                continue
            if rnd.random() < 0.2:
                lat, lon = lat, lon   # stationary
            else:
                lat += rnd.uniform(-0.5, 0.5)
                lon = ((lon + rnd.uniform(-0.5, 0.5) + 180) % 360) - 180
            r = (f"id{i}", t, lat, lon)
            if bad and rnd.random() < 0.03:
                r = (r[0], None, r[2], r[3]) if rnd.random() < 0.5 else (r[0], r[1], None, r[3])
            rows.append(r)
    return rows


def test_anchored_equals_loop(points):
    T, D = 40000.0, 300.0
    for seed in (1, 2, 3):
        rows = random_tracks(seed)
        got = segments_anchored(points(rows), Limits(time_s=T, distance_km=D), split_seconds=20000)
        g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
        exp = loop_anchored(rows, T, D)
        assert len(g) == len(exp)
        for x, y in zip(g, exp):
            assert x[:5] == y[:5] and x[5] == y[5]


def test_consecutive_equals_loop(points):
    T, D = 40000.0, 300.0
    rows = random_tracks(7, bad=False)
    got = segments_consecutive(points(rows), Limits(time_s=T, distance_km=D), split_seconds=5000)
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_consecutive(rows, T, D)


def test_split_size_does_not_change_result(points):
    rows = random_tracks(11, bad=False)
    a = rows_of(segments_consecutive(points(rows), split_seconds=1000))
    b = rows_of(segments_consecutive(points(rows), split_seconds=10 ** 9))
    assert a == b


def test_auto_split(points):
    """Buckets of a few rows and no buckets at all give the same segments."""
    p = points(random_tracks(13, bad=False))
    whole = rows_of(segments_consecutive(p, split_seconds="auto"))
    assert rows_of(segments_consecutive(p, split_seconds=10 ** 9)) == whole
    assert rows_of(segments_consecutive(p, split_seconds="auto", target_rows=5)) == whole
    limits = Limits(time_s=50000.0, distance_km=60.0)
    assert rows_of(segments_anchored(p, limits, target_rows=5)) == rows_of(segments_anchored(p, limits))


def test_consecutive_tail_copies_equal_loop(points):
    # time limit <= bucket width takes the tail-copy path; small buckets make
    # many pairs straddle a bucket boundary
    rows = random_tracks(17, bad=False)
    for T, split in ((3000.0, 3600), (7200.0, 7200), (600.0, 86400)):
        got = segments_consecutive(points(rows), Limits(time_s=T, distance_km=300.0), split_seconds=split)
        g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
        assert g == loop_consecutive(rows, T, 300.0)


def test_consecutive_tail_copies_inclusive(points):
    p = points([("a", 0, 0.0, 0.0), ("a", 3600, 0.0, 0.1), ("a", 7200, 0.0, 0.2)])
    lim = Limits(time_s=3600, distance_km=100, inclusive=True)
    assert segments_consecutive(p, lim, split_seconds=3600).count() == 2
    lim = Limits(time_s=3600, distance_km=100, inclusive=False)
    assert segments_consecutive(p, lim, split_seconds=3600).count() == 0


def test_anchored_outlier_at_every_chunk_boundary(points):
    # rows every 100 s; the last row of every 1000 s chunk is a far outlier, so
    # every chunk's speculative entry (previous chunk's last row) is wrong
    rows = []
    lat = 0.0
    for i in range(200):
        t = i * 100
        if t % 1000 == 900:
            rows.append(("x", t, 40.0, 40.0))
        else:
            lat += 0.01
            rows.append(("x", t, lat, 0.0))
    # a stationary id and one that dies in the middle
    rows += [("y", i * 100, 5.0, 5.0) for i in range(30)]
    rows += [("z", i * 100, 1.0 + 0.01 * i, 1.0) for i in range(10)] + [("z", 5000 + i * 100, 1.0, 1.0) for i in range(10)]
    got = segments_anchored(points(rows), Limits(time_s=1500.0, distance_km=50.0), split_seconds=1000)
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_anchored(rows, 1500.0, 50.0)


def interleaved(tracks, n, step=60):
    """Rows of several far apart tracks under one id, one after the other."""
    return [("m", i * step, 10.0 * (i % tracks) + 0.001 * i, 20.0) for i in range(n)]


def test_interleaved_tracks_over_many_chunks(points):
    for tracks, n in ((2, 400), (3, 300)):
        rows = interleaved(tracks, n) + [("o", i * 60, 1.0 + 0.001 * i + (50 if i % 17 == 5 else 0), 3.0) for i in range(200)]
        got = segments_anchored(points(rows), Limits(time_s=3600.0, distance_km=300.0), split_seconds=600)
        g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
        assert g == loop_anchored(rows, 3600.0, 300.0)


def test_no_scan_sees_more_than_one_chunk(points, monkeypatch):
    """Interleaved tracks are scanned chunk by chunk, never in one group."""
    from gridwake.operators import anchored_chunks as ac
    scanned = []
    real = ac.intermediate

    def spy(df, label):
        out = real(df, label)
        if label == "anchored-entries":
            scanned.append(out.count())
        return out
    monkeypatch.setattr(ac, "intermediate", spy)
    rows = interleaved(2, 4000)
    got = segments_anchored(points(rows), Limits(time_s=3600.0, distance_km=300.0), split_seconds=3600)
    chunks = 4000 * 60 // 3600 + 1
    assert got.count() == len(loop_anchored(rows, 3600.0, 300.0))
    assert sum(scanned) <= 2 * chunks and len(scanned) <= 5     # rounds follow the tracks, not the chunks


def sparse_track(chunks, step=600):
    """One row near the anchor at both ends, and far ones in every chunk between."""
    far = [("s", (k + 1) * step + j * 60, 40.0 + 0.01 * (k % 50), -70.0 - 0.1 * j) for k in range(chunks) for j in range(3)]
    end = (chunks + 2) * step
    return [("s", 0, 1.0, 1.0), ("s", 30, 1.1, 1.0), *far, ("s", end, 1.2, 1.0), ("s", end + 30, 1.3, 1.0)]


@pytest.mark.parametrize("fan", [1024, 8])
def test_an_anchor_jumps_over_untouched_chunks(points, monkeypatch, fan):
    """500 chunks without a touch: rounds do not grow with their number."""
    from gridwake.operators import anchored_chunks as ac
    rounds = []
    real = ac.intermediate

    def spy(df, label):
        rounds.append(label == "anchored-scan")
        return real(df, label)
    monkeypatch.setattr(ac, "intermediate", spy)
    monkeypatch.setattr(ac, "FAN", fan)
    rows = sparse_track(500 if fan > 100 else 150)
    limits = Limits(time_s=10.0 ** 6, distance_km=100.0)
    got = segments_anchored(points(rows), limits, split_seconds=600)
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_anchored(rows, limits.time_s, limits.distance_km) and len(g) == 3
    assert sum(rounds) <= 10


def test_jumps_keep_late_rows_and_any_shape(points):
    """Random tracks with long excursions, antimeridian, poles and time limits
    that end inside an untouched stretch, against the row loop."""
    rng = random.Random(4)
    rows = []
    for name in range(12):
        lat, lon, t = rng.uniform(-89, 89), rng.choice([179.9, -179.95, 0.0, 60.0]), 0
        home = (lat, lon)
        for _ in range(rng.randint(3, 9)):
            for _ in range(rng.randint(1, 40)):
                t += rng.randint(1, 400)
                rows.append((f"t{name}", t, max(-90.0, min(90.0, lat + rng.uniform(-0.3, 0.3))),
                             (lon + rng.uniform(-0.3, 0.3) + 180) % 360 - 180))
            lat, lon = home if rng.random() < 0.5 else (rng.uniform(-89, 89), rng.uniform(-180, 179))
    for time_limit in (700.0, 6000.0, 10.0 ** 6):
        got = segments_anchored(points(rows), Limits(time_s=time_limit, distance_km=150.0), split_seconds=300)
        g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
        assert g == loop_anchored(rows, time_limit, 150.0)


def test_pieces_follow_the_rows_and_never_change_the_result(points, monkeypatch):
    """Chunks are runs of buckets: few rows are one chunk and need one scan."""
    from gridwake.operators import anchored_chunks as ac
    from gridwake.operators import paths
    labels = []
    real = ac.intermediate
    monkeypatch.setattr(ac, "intermediate", lambda df, label: labels.append(label) or real(df, label))
    rows = interleaved(3, 300) + sparse_track(40)
    limits = Limits(time_s=10.0 ** 5, distance_km=100.0)
    expected = loop_anchored(rows, limits.time_s, limits.distance_km)
    scans = []
    for size in (2_000_000, 30):
        monkeypatch.setattr(paths, "PIECE_ROWS", size)
        labels.clear()
        got = segments_anchored(points(rows), limits, split_seconds=600)
        assert sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect()) == expected
        scans.append(labels.count("anchored-scan"))
    assert scans[0] == 1 < scans[1]


def test_caps_hold_all_points():
    import numpy as np
    from gridwake.functions.geo import great_circle_km
    from gridwake.operators.anchored_chunks import CAPS, Caps
    rng = np.random.default_rng(6)
    for spread in (0.5, 20, 90):
        caps, lat, lon = Caps(300.0), rng.uniform(-spread, spread, 3000), rng.uniform(-2 * spread, 2 * spread, 3000)
        for part in np.array_split(np.arange(3000), 4):
            caps.add(lat[part], lon[part])
        assert len(caps.caps) <= CAPS
        inside = np.zeros(3000, bool)
        for a, b, r in caps.caps:
            inside |= great_circle_km(a, b, lat, lon) <= r + 1e-6
        assert inside.all()
        above = Caps(1200.0)
        above.add(*map(np.array, zip(*caps.caps)))
        for a, b, r in caps.caps:
            assert any(great_circle_km(x, y, a, b) + r <= z + 1e-6 for x, y, z in above.caps)
    caps.add(np.array([np.nan]), np.array([0.0]))
    assert caps.caps == [[0.0, 0.0, np.inf]]


def test_follow_equals_the_row_loop():
    import numpy as np
    from gridwake.operators.anchored_chunks import follow
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 120))
        ts = np.sort(rng.integers(0, 6000, n))
        lat = np.cumsum(rng.normal(0, 0.05, n)) + 20 * (rng.random(n) < 0.3)
        lon = np.where(rng.random(n) < 0.05, np.nan, np.cumsum(rng.normal(0, 0.05, n)))
        a, b, last, ended = follow(ts, lat, lon, 900.0, 60.0, True)
        from gridwake.functions.geo import great_circle_km
        at, steps, dead = 0, [], False
        for i in range(1, n):
            if ts[i] - ts[at] > 900:
                dead = True
                break
            if great_circle_km(lat[at], lon[at], lat[i], lon[i]) > 60:
                continue
            steps.append((at, i))
            at = i
        assert list(zip(a.tolist(), b.tolist())) == steps and last == at and ended == dead


def test_dense_id_is_split_by_rows_not_by_the_limit(spark, points):
    """One id, one day, a limit of a day: several tasks, equal results."""
    from pyspark.sql import functions as F
    n = 20000
    dense = spark.range(n).select(F.lit("d").alias("id"), F.timestamp_seconds(F.col("id") * 4).alias("dt"),
                                  (F.col("id") * 0.0001).alias("lat"), F.lit(5.0).alias("lon"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        got = segments_consecutive(dense, Limits(time_s=86400.0, distance_km=50.0), split_seconds=3600)
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() >= 5
        whole = segments_consecutive(dense, Limits(time_s=86400.0, distance_km=50.0), split_seconds=10 ** 7)
        assert got.count() == whole.count() == n - 1
        assert got.exceptAll(whole).count() == 0
    finally:
        spark.conf.set(key, old)


def test_nan_and_infinite_coordinates(points):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 0, 1.0, 1.0), ("a", 60, nan, 1.0), ("a", 120, 1.1, 1.0), ("a", 180, inf, 1.0), ("a", 240, 1.2, 1.0),
            ("b", 0, 1.0, 1.0), ("b", 60, 1.0, -inf), ("b", 120, 1.1, 1.0), ("b", 180, 70.0, 1.0), ("b", 240, 1.2, 1.0)]
    far = segments_consecutive(points(rows), Limits(time_s=86400.0)).collect()
    assert sorted((r.id, r.alat, r.blat) for r in far) == [("b", 1.1, 70.0), ("b", 70.0, 1.2)]
    got = segments_anchored(points(rows), Limits(time_s=86400.0, distance_km=300.0)).collect()
    assert sorted((r.id, r.alat, r.blat) for r in got) == [("a", 1.1, 1.2), ("b", 1.0, 1.1), ("b", 1.1, 1.2)]


def test_a_scan_answers_in_few_batches():
    """Short chunks share an output batch; each keeps its key, steps and exit."""
    import pyarrow as pa
    from gridwake.operators.anchored_chunks import chunk_scanner
    n, per = 300, 4
    rows = pa.table({
        "id": pa.array(["a"] * n * per), "chunk": pa.array([i // per for i in range(n * per)], pa.int64()),
        "entered": pa.array([i >= per for i in range(n * per)]),
        "ets": pa.array([None if i < per else 60 * (i // per * per) - 60 for i in range(n * per)], pa.int64()),
        "elat": pa.array([None if i < per else 1.0 for i in range(n * per)], pa.float64()),
        "elon": pa.array([None if i < per else float("nan") if i < 2 * per else 0.001 * (i // per * per) for i in range(n * per)], pa.float64()),
        "ts": pa.array([60 * i for i in range(n * per)], pa.int64()),
        "lat": pa.array([1.0] * n * per), "lon": pa.array([0.001 * (i + 1) for i in range(n * per)])})
    out = list(chunk_scanner(86400.0, 300.0, True, first=True)(rows.to_batches(max_chunksize=600)))
    assert len(out) <= 3
    got = pa.Table.from_batches(out).to_pylist()
    assert sorted(r["chunk"] for r in got if r["kind"] == 1) == list(range(n))
    assert all(r["bts"] is None and r["blat"] is None for r in got if r["kind"] in (1, 2))
    steps = [r for r in got if r["kind"] == 0]
    assert all(r["bts"] == r["ats"] + 60 and r["chunk"] == r["bts"] // 60 // per for r in steps)
    assert sum(r["chunk"] == 0 for r in steps) == per - 1 and sum(r["chunk"] == 5 for r in steps) == per
