"""Reading tables and cutting lineage, shared by the training-data operators."""

from __future__ import annotations

import gc
import sys
import types
from contextlib import contextmanager

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ..session import intermediate as materialise
from ..session import release

__all__ = ["arrow_rows", "free_finished", "fresh_name", "materialise", "read_table", "release", "share",
           "shared_value", "worker_cache"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


TEXT_ROWS = 1000          # texts handed to Python at once by jobs that run at call time


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = TEXT_ROWS):
    """Within the block, jobs hand Python at most ``rows`` rows a batch: for
    rows so wide that the session's batch size would not fit in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_finished(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans nobody refers to any more.
    It does so only after the driver has collected its garbage, which on a
    large heap may come long after the next big shuffle."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def worker_cache(name: str) -> dict:
    """A dict that the tasks of one stage share within a Python worker process:
    a reused worker keeps what earlier tasks of the stage have computed, and
    drops it when it gets a task of another stage, so that the caches of
    operators that follow each other do not add up. Callers bound its size."""
    module = sys.modules.setdefault("_gridwake_worker_cache", types.ModuleType("_gridwake_worker_cache"))
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if module.__dict__.get("stage") != stage:
        module.__dict__.update(stage=stage, kept={})
        gc.collect()
    return module.__dict__.setdefault("kept", {}).setdefault(name, {})


def share(spark: SparkSession, value):
    """Broadcast ``value``; its classes are pickled by value like task code.
    Callers bound its size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(broadcast):
    return cloudpickle.loads(broadcast.value)
