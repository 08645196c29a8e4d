"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query is fully executed (rows are consumed by a no-op sink, nothing is
collected to the driver). All headline queries first run once on the small
sf0.01 tables, untimed (Janino code generation, Python worker start). Then
every query runs twice at the bench scale: the first ("cold") pass is
reported under ``cold_queries``; the second ("warm") pass, after the JVM's
JIT has compiled the generated code, gives ``value`` and ``queries``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridwake.plans import TriplineOptions, catalog  # noqa: E402
from gridwake.plans.pipelines import write_tripline  # noqa: E402
from gridwake.session import build_session  # noqa: E402
from gridwake.sources.events import read_event_points  # noqa: E402

HEADLINE = [
    "segments_consecutive",
    "segments_anchored",
    "crossings_all",
    "cell_stats",
    "cell_track_ids",
    "multi_grid_counts",
    "bin_counts",
    "dense_tiles_summary",
    "pipeline_tripline",
    "pipeline_mercator",
    "segments_anchored_interleaved",
    "write_tripline",
]


def write_all(spark, sf_dir: str) -> None:
    """All tables of the tripline pipeline, written in one run."""
    opts = TriplineOptions(limits=catalog.LIMITS_CONSECUTIVE, grids=(catalog.GRID_FINE,), path_mode="consecutive")
    with tempfile.TemporaryDirectory(prefix="gridwake-bench-") as out:
        write_tripline(read_event_points(spark, sf_dir), out, opts)


def run(spark, name: str, sf_dir: str) -> None:
    if name == "write_tripline":
        write_all(spark, sf_dir)
    else:
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="gridwake-bench")
    # warm-up on the smallest table set so JIT and Python workers are ready
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            run(spark, name, warm_dir)
    passes = []
    for _ in range(2):
        times = {}
        for name in HEADLINE:
            t0 = time.perf_counter()
            run(spark, name, sf_dir)
            times[name] = round(time.perf_counter() - t0, 3)
        passes.append(times)
    cold, warm = passes
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "sf": sf,
                      "cold_total": round(sum(cold.values()), 3), "cold_queries": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
