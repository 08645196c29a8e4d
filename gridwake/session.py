"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
are for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
JIT_FLAGS = "-XX:-DontCompileHugeMethods"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "gridwake", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GRIDWAKE_DRIVER_MEMORY", "8g"))
        # Wide geo projections compile to methods above HotSpot's 8000-byte JIT
        # limit; let the JIT compile them instead of interpreting them.
        .config("spark.driver.extraJavaOptions", JIT_FLAGS)
        .config("spark.executor.extraJavaOptions", JIT_FLAGS)
        # keep small shuffles (segments before a 10-100x explode) parallel
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256KB")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_BYTES = 8000           # HotSpot interprets longer methods for ever, unless started with JIT_FLAGS


def small_methods(spark: SparkSession) -> None:
    """Let stages whose fused method HotSpot would not compile run operator by
    operator, each in methods short enough. A session setting, which changes
    no result; a lower limit that the caller has set stays."""
    if int(spark.conf.get(METHOD_LIMIT)) > METHOD_BYTES:
        spark.conf.set(METHOD_LIMIT, str(METHOD_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is; without it this raises, since executors cannot share
    the driver's own disk. Only a ``local`` master, where driver and executors
    are one process, gets a scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="gridwake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def intermediate(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the checkpoint folder and read it back:
    cuts the lineage, survives lost executors, prunes columns on reading, and
    gives the planner true sizes. The files go with ``release`` or when the
    driver's JVM ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path, files = _place(spark, path)
    files.deleteOnExit(hadoop_path)
    written = spark.read.schema(df.schema).parquet(path)
    written._written_to = path
    return written


def release(*frames: DataFrame) -> None:
    """Delete tables that ``intermediate`` returned and nothing reads any more:
    call it once what was derived from them is itself written."""
    for frame in frames:
        path = frame.__dict__.pop("_written_to", None)
        if path:
            hadoop_path, files = _place(frame.sparkSession, path)
            files.delete(hadoop_path, True)
            files.cancelDeleteOnExit(hadoop_path)


def _place(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
