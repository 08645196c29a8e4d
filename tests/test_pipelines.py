from pyspark.sql import functions as F

from gridwake.config import Grid, Limits, Region
from gridwake.plans import MercatorOptions, TriplineOptions, mercator_pipeline, tripline_pipeline
from gridwake.sources.events import read_event_points

SF = "/root/testdata/sf0.001"


def test_tripline_pipeline_defaults(spark):
    pts = read_event_points(spark, SF)
    opts = TriplineOptions(limits=Limits(time_s=86400, distance_km=300),
                           grids=(Grid(0.5, 0.5, Region(-90.0, -360.0, 90.0, 180.0), "g"),))
    out = tripline_pipeline(pts, opts)
    assert set(out) >= {"segments", "crossings", "cell_stats", "counts", "velocity", "direction", "track_ids"}
    n_cross = out["crossings"].count()
    assert n_cross > 0
    assert out["counts"].agg(F.sum("value")).first()[0] == n_cross
    assert out["track_ids"].count() == out["cell_stats"].count()
    assert set(out["velocity"].columns) == {"grid", "lat_idx", "lon_idx", "lat", "lon", "dt", "velocity"}


def test_mercator_pipeline_defaults(spark):
    pts = read_event_points(spark, SF)
    out = mercator_pipeline(pts, MercatorOptions(limits=Limits(time_s=86400, distance_km=300, inclusive=False),
                                                 max_level=3))
    hits = out["bin_hits"].count()
    assert hits > 0
    assert out["bin_counts"].agg(F.sum("value")).first()[0] == hits
    tiles = out["tiles"].select(F.size("bins").alias("n"),
                                F.aggregate("bins", F.lit(0.0), lambda a, x: a + x).alias("s"))
    agg = tiles.agg(F.min("n"), F.max("n"), F.sum("s")).first()
    assert agg[0] == agg[1] == 65536 and agg[2] == hits


def test_write_cell_tables(spark):
    import tempfile
    from gridwake.sinks import write_cell_tables
    pts = read_event_points(spark, SF)
    out = tripline_pipeline(pts, TriplineOptions(limits=Limits(time_s=86400, distance_km=300)))
    d = tempfile.mkdtemp(prefix="gw-cells-")
    paths = write_cell_tables(out["cell_stats"], d)
    n = spark.read.parquet(paths["cell_stats"]).count()
    for name, col in (("counts", "value"), ("velocity", "velocity"), ("direction", "direction")):
        t = spark.read.parquet(paths[name])
        assert t.count() == n and col in t.columns


def test_legacy_id_lists_have_one_row_per_label(spark):
    from gridwake.plans.pipelines import legacy_tripline_options
    pts = read_event_points(spark, SF)
    opts = legacy_tripline_options(limits=Limits(time_s=86400, distance_km=300), temporal_split="day",
                                   grids=(Grid(10.0, 10.0, Region(-90.0, -360.0, 90.0, 180.0), "g"),))
    out = tripline_pipeline(pts, opts)
    keys = ["lat", "lon", "dt"]
    ids, counts = out["track_ids"], out["counts"]
    assert ids.count() == ids.select(*keys).distinct().count() == counts.count()
    per_cell = out["track_pairs"].groupBy(*keys).agg(F.count("track_id").alias("n"), F.sum("n_crossings").alias("c"))
    joined = per_cell.join(ids.select(*keys, "n_tracks"), keys).join(counts.select(*keys, "value"), keys)
    assert joined.where("n <> n_tracks or c <> value").count() == 0


def test_all_outputs_in_one_run(spark, tmp_path):
    from gridwake.plans.pipelines import write_mercator, write_tripline
    pts = read_event_points(spark, SF)
    world = Grid(1.0, 1.0, Region(-90.0, -360.0, 90.0, 180.0), "g")
    opts = TriplineOptions(limits=Limits(time_s=86400, distance_km=300), grids=(world,), path_mode="consecutive")
    paths, out = write_tripline(pts, str(tmp_path / "t"), opts), tripline_pipeline(pts, opts)
    for name in ("counts", "velocity", "direction", "track_ids", "track_pairs", "segments"):
        back = spark.read.parquet(paths[name])
        assert back.count() == out[name].count(), name
    assert spark.read.parquet(paths["counts"]).exceptAll(out["counts"]).count() == 0
    mopts = MercatorOptions(limits=Limits(time_s=86400, distance_km=300, inclusive=False), max_level=2)
    paths, out = write_mercator(pts, str(tmp_path / "m"), mopts), mercator_pipeline(pts, mopts)
    assert spark.read.parquet(paths["bin_counts"]).exceptAll(out["bin_counts"]).count() == 0
    assert spark.read.parquet(paths["tiles"]).count() == out["tiles"].count()


def test_a_region_that_clips_the_short_way_is_told(spark):
    import pytest
    pts = read_event_points(spark, SF)
    with pytest.warns(UserWarning, match="clips"):
        tripline_pipeline(pts, TriplineOptions(path_mode="consecutive", grids=(Grid(1.0, 1.0, Region()),)))
