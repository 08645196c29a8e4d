import os
import random
import tempfile

from pyspark.sql import functions as F

from gridwake.config import Grid, Limits, Region
from gridwake.operators.paths import segments_consecutive
from gridwake.sources.events import read_event_points
from gridwake.streaming import stream_cell_counts, stream_segments, stream_segments_ordered

SF = "/root/testdata/sf0.001"


def _scratch(spark):
    base = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp()
    base = base.replace("file:", "")
    return tempfile.mkdtemp(prefix="stream-", dir=base if os.path.isdir(base) else None)


def test_stream_segments_match_batch(spark):
    pts = read_event_points(spark, SF)
    root = _scratch(spark)
    src = os.path.join(root, "points")
    # three time slices written as separate files, streamed one file per trigger
    pts.withColumn("slice", F.floor(F.dayofmonth("dt") / 11)).repartition(1, "slice") \
        .write.partitionBy("slice").parquet(src)
    from pyspark.sql import types as T
    schema = T.StructType(pts.schema.fields + [T.StructField("slice", T.LongType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    lim = Limits(time_s=86400, distance_km=300, inclusive=False)
    q = (stream_segments(stream, lim).writeStream.format("memory").queryName("seg_stream")
         .outputMode("append").option("checkpointLocation", os.path.join(root, "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("seg_stream")
    exp = segments_consecutive(pts, lim)
    key = ["id", "adt", "bdt", "alat", "alon", "blat", "blon"]
    g = sorted(tuple(r) for r in got.select(*key).collect())
    e = sorted(tuple(r) for r in exp.select(*key).collect())
    assert g == e and len(e) > 0


def test_stream_cell_counts(spark):
    pts = read_event_points(spark, SF)
    root = _scratch(spark)
    seg_dir = os.path.join(root, "segments")
    lim = Limits(time_s=86400, distance_km=300, inclusive=False)
    segments_consecutive(pts, lim).write.parquet(seg_dir)
    seg_stream = spark.readStream.schema(spark.read.parquet(seg_dir).schema).parquet(seg_dir)
    grid = Grid(1.0, 1.0, Region(-90.0, -360.0, 90.0, 180.0))
    q = (stream_cell_counts(seg_stream, grid, "1 hour", "0 seconds").writeStream.format("memory")
         .queryName("cell_stream").outputMode("complete" if False else "update")
         .option("checkpointLocation", os.path.join(root, "ck")).start())
    q.processAllAvailable()
    q.stop()
    total = spark.table("cell_stream").groupBy("grid", "lat_idx", "lon_idx", "bucket_start") \
        .agg(F.max("value").alias("v")).agg(F.sum("v")).first()[0]
    from gridwake.operators.crossings import crossings
    assert total == crossings(spark.read.parquet(seg_dir), grid).count()


def test_stream_tripline_chained(spark):
    from gridwake.streaming import stream_tripline
    from gridwake.operators.crossings import crossings
    pts = read_event_points(spark, SF)
    root = _scratch(spark)
    src = os.path.join(root, "points")
    pts.withColumn("slice", F.floor(F.dayofmonth("dt") / 11)).repartition(1, "slice") \
        .write.partitionBy("slice").parquet(src)
    from pyspark.sql import types as T
    schema = T.StructType(pts.schema.fields + [T.StructField("slice", T.LongType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    lim = Limits(time_s=86400, distance_km=300, inclusive=False)
    grid = Grid(1.0, 1.0, Region(-90.0, -360.0, 90.0, 180.0))
    q = (stream_tripline(stream, lim, grid, "1 hour", "1 day").writeStream.format("memory")
         .queryName("tripline_stream").outputMode("append")
         .option("checkpointLocation", os.path.join(root, "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = {(r.lat_idx, r.lon_idx, r.bucket_start): r.value for r in spark.table("tripline_stream").collect()}
    batch = (crossings(segments_consecutive(pts, lim), grid, temporal_split="hour")
             .groupBy("lat_idx", "lon_idx", "bucket_ts").count().collect())
    exp = {(r.lat_idx, r.lon_idx, r.bucket_ts): r["count"] for r in batch}
    assert got and all(exp.get(k) == v for k, v in got.items())
    # every window that the watermark has passed is there: none is missing before the last one emitted
    last = max(k[2] for k in got)
    assert got == {k: v for k, v in exp.items() if k[2] <= last}


def streamed(spark, slices, lateness_s, limits, name):
    """Rows (id, seconds, lat, lon) per micro-batch, as the ordered stream gives them out."""
    root = _scratch(spark)
    src = os.path.join(root, "in")
    os.makedirs(src)
    schema = "id string, dt timestamp, lat double, lon double"
    q = (stream_segments_ordered(spark.readStream.schema(schema).parquet(src), limits, lateness_s).writeStream
         .format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(root, "ck")).start())
    try:
        for rows in slices:
            df = spark.createDataFrame(rows, "id string, s long, lat double, lon double")
            df.select("id", F.timestamp_seconds("s").alias("dt"), "lat", "lon").coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
        state = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    finally:
        q.stop()
    return spark.table(name).collect(), state


def test_a_shuffled_stream_equals_the_batch(spark, points):
    rng = random.Random(4)
    rows = []
    for i in range(6):
        t = 1_700_000_000 + rng.randint(0, 3000)
        for _ in range(80):
            t += rng.randint(1, 900)
            rows.append((f"s{i}", t, rng.uniform(10, 11), rng.uniform(10, 11)))
    rows += [("same", 1_700_000_100, 10.0 + k % 5, 20.0) for k in range(20)]
    # every row arrives up to an hour of event time late
    arrival = sorted(rows, key=lambda r: r[1] + rng.randint(0, 3500))
    slices = [arrival[i::1][k * 50:(k + 1) * 50] for i in [0] for k in range(-(-len(arrival) // 50))]
    limits = Limits(time_s=3000.0, distance_km=200.0, inclusive=False)
    end = max(r[1] for r in rows) + 100_000
    got, state = streamed(spark, [*slices, [("end", end, 0.0, 0.0)], [("end", end + 1, 0.0, 0.0)]], 3600, limits, "shuffled")
    assert {r.kind for r in got} == {"segment"}
    found = sorted((r.id, r.adt, r.bdt, r.alat, r.alon, r.blat, r.blon, r.time_s) for r in got)
    want = segments_consecutive(points(rows), limits)
    assert found == sorted(tuple(r) for r in want.select("id", "adt", "bdt", "alat", "alon", "blat", "blon", "time_s").collect())
    assert len(found) > 200 and state == 1            # idle ids have left no state


def test_rows_that_come_too_late_are_given_out(spark):
    base = 1_700_000_000
    slices = [[("a", base, 1.0, 1.0), ("a", base + 60, 1.1, 1.0)], [("b", base + 10_000, 5.0, 5.0)],
              [("b", base + 10_060, 5.1, 5.0)], [("a", base + 30, 1.05, 1.0), ("c", base + 20, 2.0, 2.0), ("a", base + 90, 1.2, 1.0)],
              [("b", base + 30_000, 6.0, 5.0)], [("b", base + 30_001, 6.0, 5.1)]]
    got, _ = streamed(spark, slices, 600, Limits(time_s=10.0 ** 5, distance_km=200.0, inclusive=False), "late_rows")
    late = sorted((r.id, r.blat) for r in got if r.kind == "late")
    assert late == [("a", 1.05), ("c", 2.0)]
    assert sorted((r.alat, r.blat) for r in got if r.kind == "segment" and r.id == "a") == [(1.0, 1.1), (1.1, 1.2)]
