import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gridwake.config import Region
from gridwake.sinks import export_counts, write_stage, write_tiles
from gridwake.sources import (filter_region, normalise_positions, parse_text_lines, points_from_text,
                              read_points, read_position_log, to_points)


def scratch():
    return tempfile.mkdtemp(prefix="gw-test-")


def test_raw_log_normalise_and_clean(spark):
    d = scratch()
    with open(os.path.join(d, "log.csv"), "w") as f:
        f.write('1, "367001" ,NAME,IMO, 40.5 , -73.25 ,10,90, 2401151030 ,DEST,ETA\n')
        f.write('1,367001,NAME,IMO,40.6,-73.20,10,90,2401151045,DEST,ETA\n')
        f.write('1,367002,NAME,IMO,abc,-73.20,10,90,2401151045,DEST,ETA\n')
    log = read_position_log(spark, d)
    assert log.columns[:3] == ["ais_type", "mmsi", "name"]
    norm = normalise_positions(log)
    assert [r.dt for r in norm.orderBy("dt").collect()][:1] == ["2024-01-15 10:30:00"]
    kept = to_points(norm, "mmsi", "dt", "latitude", "longitude", on_error="drop").orderBy("dt").collect()
    assert [(r.id, r.lat, r.lon) for r in kept] == [("367001", 40.5, -73.25), ("367001", 40.6, -73.2)]
    all_rows = to_points(norm, "mmsi", "dt", "latitude", "longitude", on_error="keep")
    assert all_rows.where(F.col("lat").isNull()).count() == 1


def test_dt_formats(spark):
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00.123", "1", "2"),
                                ("a", "2024-01-01T11:00:00", "1", "2"),
                                ("a", "garbage", "1", "2")], "id string, dt string, lat string, lon string")
    got = to_points(df, "id", "dt", "lat", "lon", on_error="keep").orderBy("dt").collect()
    assert [str(r.dt) for r in got] == ["None", "2024-01-01 10:00:00", "2024-01-01 11:00:00"]


def test_text_lines_by_position(spark):
    lines = spark.createDataFrame([("v1\tx\t2024-01-01 10:00:00.5\ty\t40.0\t-70.0",),
                                   ("v1\tx\t2024-01-01T10:05:00.0\ty\t40.1\t-70.1",)], "value string")
    p = parse_text_lines(lines, id_idx=0, lat_idx=4, lon_idx=5, datetime_idx=2).orderBy("dt").collect()
    assert [(r.id, str(r.dt), r.lat, r.lon) for r in p] == [
        ("v1", "2024-01-01 10:00:00", 40.0, -70.0), ("v1", "2024-01-01 10:05:00", 40.1, -70.1)]
    lines2 = spark.createDataFrame([("v2\t2024-02-03\t04:05:06.789\t1.5\t2.5",)], "value string")
    q = parse_text_lines(lines2, id_idx=0, date_idx=1, time_idx=2, lat_idx=3, lon_idx=4).first()
    assert (q.id, str(q.dt), q.lat, q.lon) == ("v2", "2024-02-03 04:05:06", 1.5, 2.5)
    bad = spark.createDataFrame([("v3\tx\tnot-a-date\ty\t1\t2",)], "value string")
    with pytest.raises(Exception):
        parse_text_lines(bad, id_idx=0, lat_idx=4, lon_idx=5, datetime_idx=2, on_error="fail").collect()
    d = scratch()
    with open(os.path.join(d, "a.tsv"), "w") as f:
        f.write("v9\tx\t2024-01-01 10:00:00.0\ty\t3.0\t4.0\n")
    assert points_from_text(spark, d, id_idx=0, lat_idx=4, lon_idx=5, datetime_idx=2).count() == 1


def test_region_filter_and_reader(spark, points):
    p = points([("a", 0, 10.0, 10.0), ("a", 60, 10.00000005, 20.0), ("a", 120, 30.0, 10.0)])
    assert filter_region(p, Region(0.0, 0.0, 10.0, 20.0)).count() == 2
    assert read_points(spark, lambda s: p).columns == ["id", "dt", "lat", "lon"]
    with pytest.raises(ValueError):
        Region(-100.0, 0.0, 10.0, 10.0).validate()
    with pytest.raises(ValueError):
        Region(0.0, 0.0, 10.0, 180.0).validate()


def test_sinks(spark):
    d = scratch()
    counts = spark.createDataFrame([(40.05, -73.95, 3, "2024-01-01 10:00:00")],
                                   "lat double, lon double, value long, dt string")
    export_counts(counts, os.path.join(d, "export"))
    text = "".join(open(os.path.join(d, "export", f)).read()
                   for f in sorted(os.listdir(os.path.join(d, "export"))) if f.endswith(".csv"))
    assert text.splitlines()[0] == "latitude\tlongitude\tcount\tdate"
    assert "40.05\t-73.95\t3\t2024-01-01 10:00:00" in text
    write_stage(counts, os.path.join(d, "stage"))
    write_stage(counts, os.path.join(d, "stage"))          # overwrite
    assert spark.read.parquet(os.path.join(d, "stage")).count() == 1
    tiles = spark.createDataFrame([(1, 0, 1, [0.0, 1.0]), (2, 3, 2, [2.0])],
                                  "level int, tile_x long, tile_y long, bins array<double>")
    write_tiles(tiles, os.path.join(d, "tiles"), name="demo", description="test")
    assert {"level=1", "level=2"} <= set(os.listdir(os.path.join(d, "tiles")))
    back = spark.read.parquet(os.path.join(d, "tiles"))
    assert back.where("level = 2").first().name == "demo"


def test_log_keeps_rows_with_unbalanced_quotes(spark, tmp_path):
    from gridwake.sources.positions import normalise_positions, read_position_log, to_points
    (tmp_path / "log.csv").write_text('1,366,"FOO,9,30.1,-70.5,0,0,2401021530,d,e\n'
                                      '1," 367 ",a "b" c,9," 30.2 ",-70.6,0,0,2401021531,"x,e\n')
    pts = to_points(normalise_positions(read_position_log(spark, str(tmp_path))), "mmsi", "dt", "latitude", "longitude")
    assert sorted((r.id, r.lat, r.lon) for r in pts.collect()) == [("366", 30.1, -70.5), ("367", 30.2, -70.6)]


def test_unpadded_and_impossible_times(spark):
    from gridwake.functions.timefn import format_ts, parse_dt
    rows = [("2024-1-5 3:04:05",), ("2024-01-05T03:4:5.250",), ("2024-02-30 00:00:00",), ("24-1-5 3:04:05",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(format_ts(parse_dt("t"))).collect()]
    assert got == ["2024-01-05 03:04:05", "2024-01-05 03:04:05", None, None, None, None]


def test_intermediate_tables_need_a_shared_folder_on_a_cluster():
    import pytest
    from gridwake.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
