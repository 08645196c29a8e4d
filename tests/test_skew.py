"""A hot id (a third of all rows) must be spread over many tasks, and the
results must stay exact."""

import random
import uuid

from pyspark.sql import functions as F

from gridwake.config import Limits
from gridwake.operators.paths import segments_anchored, segments_consecutive
from gridwake.operators.sequence import BUCKET, equi_depth, partition_by_bucket, time_bucket
from gridwake.sinks import write_positions

from test_paths import loop_anchored, loop_consecutive


def hot_rows(seed=5, n_hot=1200, n_cold_ids=40, per_cold=60):
    rnd = random.Random(seed)
    rows = []
    lat, lon, t = 10.0, 10.0, 0
    for _ in range(n_hot):                      # one id, dense, long
        t += rnd.choice([60, 120, 600])
        if rnd.random() < 0.05:
            rows.append(("hot", t, lat + 8.0, lon))   # outlier
            continue
        lat += rnd.uniform(-0.02, 0.02)
        lon += rnd.uniform(-0.02, 0.02)
        rows.append(("hot", t, lat, lon))
    for i in range(n_cold_ids):
        t, la, lo = 0, rnd.uniform(-50, 50), rnd.uniform(-170, 170)
        for _ in range(per_cold):
            t += rnd.choice([300, 3600, 20000])
            la += rnd.uniform(-0.3, 0.3)
            lo += rnd.uniform(-0.3, 0.3)
            rows.append((f"c{i}", t, la, lo))
    return rows


def test_hot_id_is_split_over_partitions(spark, points):
    rows = hot_rows()
    p = points(rows)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")      # tiny test data would otherwise be coalesced into one task
    try:
        part = partition_by_bucket(p, "id", time_bucket(F.col("dt"), 3600))
        pids = (part.where(F.col("id") == "hot").select(F.spark_partition_id().alias("pid"), BUCKET)
                .agg(F.countDistinct("pid").alias("tasks"), F.countDistinct(BUCKET).alias("buckets")).first())
    finally:
        spark.conf.set(key, old)
    # the hot id's (id, bucket) keys hash to (nearly) every shuffle partition
    assert pids.buckets > 10 and pids.tasks >= 6


def test_hot_id_results_exact(spark, points):
    rows = hot_rows()
    p = points(rows)
    lim_c = Limits(time_s=1800.0, distance_km=100.0, inclusive=False)
    got = segments_consecutive(p, lim_c, split_seconds=3600)
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_consecutive(rows, 1800.0, 100.0)
    lim_a = Limits(time_s=1800.0, distance_km=100.0)
    got = segments_anchored(p, lim_a, split_seconds=3600)
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_anchored(rows, 1800.0, 100.0)


def one_second(n=4000, seed=8):
    """One id with all rows in one second beside ids with few rows."""
    rnd = random.Random(seed)
    rows = [("dense", 7200, round(rnd.uniform(-5, 5), 3), round(rnd.uniform(-5, 5), 3)) for _ in range(n)]
    rows += [(f"s{i}", rnd.randint(0, 10 ** 6), rnd.uniform(0, 3), rnd.uniform(0, 3)) for i in range(5) for _ in range(40)]
    return rows + [("dense", 7260, 1.0, 1.0), ("dense", 100, 1.0, 1.0), ("none", None, 1.0, 1.0), ("bad", 50, None, 1.0)]


def test_equal_seconds_are_split_and_sparse_ids_are_not(spark, points):
    p = points(one_second())
    found = equi_depth(p, "id", "dt", ["dt", "lat", "lon"], 200)
    sizes = found.groupBy("id", BUCKET).count().collect()
    dense = {r[BUCKET]: r["count"] for r in sizes if r["id"] == "dense"}
    assert len(dense) >= 12 and max(dense.values()) < 3 * 200
    assert all(len({r[BUCKET] for r in sizes if r["id"] == f"s{i}"}) == 1 for i in range(5))
    assert [r[BUCKET] for r in sizes if r["id"] == "none"] == [None]
    # buckets ascend in the order of the rows
    rows = found.where("id = 'dense'").orderBy("dt", "lat", "lon").select(BUCKET).collect()
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        part = partition_by_bucket(found, "id", F.col(BUCKET)).where("id = 'dense'")
        assert part.select(F.spark_partition_id()).distinct().count() >= 6
    finally:
        spark.conf.set(key, old)


def test_split_inside_a_second_is_exact(spark, points):
    rows = one_second(900)
    p = points(rows)
    got = segments_consecutive(p, Limits(time_s=3600.0, distance_km=200.0, inclusive=False), target_rows=60)
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_consecutive(rows, 3600.0, 200.0)
    got = segments_anchored(p, Limits(time_s=3600.0, distance_km=200.0), target_rows=60, piece_rows=50)
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_anchored(rows, 3600.0, 200.0)


def test_a_stored_layout_needs_no_exchange(spark, points, tmp_path):
    """Positions stored in buckets by id are paired where they lie."""
    rows = [r for r in hot_rows(n_hot=300, n_cold_ids=12) if r[2] is not None]
    table = f"stored_{uuid.uuid4().hex}"
    write_positions(points(rows), table, buckets=5, path=str(tmp_path / "positions"))
    limits = Limits(time_s=1800.0, distance_km=100.0, inclusive=False)
    stored = spark.read.table(table)
    got = segments_consecutive(stored, limits)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan and "Bucketed: true" in plan
    assert "Exchange" in segments_consecutive(points(rows), limits)._jdf.queryExecution().executedPlan().toString()
    g = sorted((r.id, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got.collect())
    assert g == loop_consecutive(rows, 1800.0, 100.0)
    spark.sql(f"drop table {table}")


def test_rows_of_a_task_do_not_grow_with_the_table(spark, points):
    """Segments to be cut at grid lines lie in tasks of a bounded number of
    rows, track pairs are counted there without another shuffle, and the rows
    are the same."""
    from gridwake.config import Grid
    from gridwake.operators.crossings import crossings
    from gridwake.operators.stats import cell_track_pairs
    rows = [(f"u{u}", 60 * i, 10.0 + u * 0.01 + i * 0.01, 20.0 + i * 0.03) for u in range(40) for i in range(30)]
    limits = Limits(time_s=86400, distance_km=1000)
    for rule in (segments_consecutive, segments_anchored):
        plain, wide = rule(points(rows), limits), rule(points(rows), limits, task_rows=40)
        assert wide.rdd.getNumPartitions() >= 30
        assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, plain.collect())) != []
        pairs = cell_track_pairs(crossings(wide, Grid(0.1, 0.1)))
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (pairs, wide.select("*"))]
        assert plans[0].count("Exchange") == plans[1].count("Exchange") > 0
        per_task = wide.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_task <= 6 * 30
