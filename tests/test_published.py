"""Results that are replaced whole or not at all, ordered exports, growing
tile sets, and counted rejects."""

import os

import pytest
from pyspark.sql import functions as F

from gridwake.operators.tiles import bin_counts, bin_hits
from gridwake.plans import catalog
from gridwake.sinks import (describe_tile_set, export_counts, merge_tile_set, publish, read_counts, read_published,
                            read_tile_counts, write_stage)
from gridwake.sinks import published
from gridwake.sources import store_positions, to_points

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def failing(df):
    return df.withColumn("v", F.when(F.col("k") == 7, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("v")))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    old = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    path = str(tmp_path / "out")
    publish(old, path)
    write_stage(old, f"{path}-stage")
    spark.sql("drop table if exists old_rows")
    write_stage(old, "old_rows", as_table=True)
    for write in (lambda df: publish(df, path), lambda df: write_stage(df, f"{path}-stage"),
                  lambda df: write_stage(df, "old_rows", as_table=True)):
        with pytest.raises(Exception, match="boom"):
            write(failing(old))
    assert rows_of(read_published(spark, path)) == rows_of(old)
    assert rows_of(spark.read.parquet(f"{path}-stage")) == rows_of(old) == rows_of(spark.table("old_rows"))
    # a result may be computed from the one it replaces
    write_stage(spark.table("old_rows").withColumn("v", F.col("v") + 1), "old_rows", as_table=True)
    write_stage(spark.read.parquet(f"{path}-stage").where("k < 3"), f"{path}-stage")
    publish(read_published(spark, path).where("k > 6"), path)
    assert spark.table("old_rows").agg(F.sum("v")).first()[0] == 100
    assert spark.read.parquet(f"{path}-stage").count() == 3 and read_published(spark, path).count() == 3
    spark.sql("drop table old_rows")


def test_readers_keep_their_version_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "out")
    frames = []
    for n in range(1, 5):
        assert publish(spark.range(n).withColumn("v", F.lit(n)), path) == n
        frames.append(read_published(spark, path))
        assert frames[-1].count() == n
    assert frames[2].count() == 3                      # the version before the current one is still there
    versions = [f for f in os.listdir(path) if f.startswith("_version=")]
    assert len(versions) == 2 and len(os.listdir(f"{path}/_manifests")) <= 2 * 2
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "nothing"))


def test_two_writers_cannot_both_win(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    publish(spark.range(1), path)
    seen = published.current(spark, path)
    publish(spark.range(2), path)
    monkeypatch.setattr(published, "current", lambda *a: seen)      # a writer that began before the last one
    with pytest.raises(RuntimeError, match="another writer"):
        publish(spark.range(3), path)
    monkeypatch.undo()
    assert read_published(spark, path).count() == 2


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 4).cast("int").alias("p"), F.concat(F.lit("a b/"), F.col("id") % 2).alias("q"))
    publish(rows, path, partition_by=["p", "q"])
    before = set(published.current(spark, path)["folders"])
    publish(rows.where("p = 1").withColumn("k", F.col("k") + 1000), path, partition_by=["p", "q"], touched_only=True)
    after = set(published.current(spark, path)["folders"])
    assert len(before) == len(after) == 4 and len(before & after) == 3
    want = rows.withColumn("k", F.when(F.col("p") == 1, F.col("k") + 1000).otherwise(F.col("k")))
    back = read_published(spark, path)
    assert rows_of(back) == rows_of(want) and back.dtypes == rows.dtypes
    with pytest.raises(ValueError):
        publish(rows.select("k", "p"), path, partition_by=["p"], touched_only=True)
    publish(rows.where("false"), path, partition_by=["p", "q"])
    assert read_published(spark, path).count() == 0


def test_export_is_one_ordered_file_in_parts(spark, tmp_path):
    rows = [(k * 37 % 1000 / 10, -k / 7, k, f"2024-01-{k % 28 + 1:02d} 00:00:00") for k in range(2000)] + [(None, 1.0, 5, None)]
    df = spark.createDataFrame(rows, "lat double, lon double, value long, dt string").repartition(9)
    path = str(tmp_path / "export")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        export_counts(df, path)
    finally:
        spark.conf.set(key, before)
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(parts) > 3
    text = "".join((tmp_path / "export" / f).read_text() for f in parts)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3] or "", r[2]))
    want = ["latitude\tlongitude\tcount\tdate"] + ["\t".join("" if v is None else str(v) for v in r) for r in ordered]
    assert text == "\n".join(want) + "\n"
    assert rows_of(read_counts(spark, path)) == sorted(rows, key=str)
    empty = str(tmp_path / "empty")
    export_counts(df.where("false"), empty)
    assert read_counts(spark, empty).count() == 0


def test_two_halves_equal_the_whole_tile_set(spark, tmp_path):
    seg = catalog._consecutive(spark, SF)
    half, whole = str(tmp_path / "half"), str(tmp_path / "whole")
    merge_tile_set(bin_counts(bin_hits(seg, 4)), whole, "hits", "all")
    for part in (0, 1):
        merge_tile_set(bin_counts(bin_hits(seg.where(F.col("id").cast("long") % 2 == part), 4)), half, "hits", "all")
    assert rows_of(read_tile_counts(spark, half)) == rows_of(read_tile_counts(spark, whole))
    assert rows_of(describe_tile_set(spark, half)) == rows_of(describe_tile_set(spark, whole))
    # a batch of one level leaves the folders of the others alone
    before = set(published.current(spark, f"{half}/counts")["folders"])
    merge_tile_set(bin_counts(bin_hits(seg, 4)).where("level = 4"), half, "hits", "all")
    kept = before & set(published.current(spark, f"{half}/counts")["folders"])
    assert {f for f in before if "level=4" not in f} == kept


def test_rejects_are_counted_in_the_pass_that_stores(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00", "1.0", "2.0"), (None, "x", "1.0", "2.0"), ("b", "x", "?", "2.0"),
            ("c", "2024-01-01 00:00:00", "?", ""), ("d", "2024-01-01 00:00:00", "1", None), ("e", "2024-01-01T01:00:00", "1", "2")]
    raw = spark.createDataFrame(rows, "who string, at string, y string, x string")
    good, bad, counts = store_positions(to_points(raw, "who", "at", "y", "x", on_error="mark"), str(tmp_path / "p"))
    assert counts == {"good": 2, "id": 1, "time": 1, "latitude": 1, "longitude": 1}
    assert sorted(r.id for r in good.collect()) == ["a", "e"] and good.columns == ["id", "dt", "lat", "lon"]
    assert sorted((r.reason, r.raw_lat) for r in bad.collect()) == [("id", "1.0"), ("latitude", "?"), ("longitude", "1"), ("time", "?")]
