"""Results that are replaced as a whole or not at all.

A published folder holds its data in versions (``_version=<n>-<id>``) and one
small manifest per version (``_manifests/<n>.json``) that lists the folders a
reader has to read. A new version is written beside the old one; only when it
is complete does its manifest appear, by a rename that fails if another
writer was first. Until then, and if the job dies, readers see the old rows;
a job may read the folder it publishes to. With ``touched_only`` a version
replaces just the partitions it holds rows of and keeps the folders of all
others (dynamic partition overwrite). The version before the current one
stays for readers that have begun; older ones are deleted.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION = "_version"


class _Files:
    """The few file operations needed, on whatever store ``path`` names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.base = path.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """The file appears complete, or not at all if there is one already."""
        spare = f"_manifests/.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(spare), False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf) \
            if self.path("").toUri().getScheme() else self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self.path(spare), self.path(name), options)
        except Exception as e:
            self.fs.delete(self.path(spare), False)
            raise RuntimeError(f"{self.base}: another writer published first") from e

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifests(files: _Files) -> list[str]:
    return [n for n in files.names("_manifests") if n.endswith(".json") and not n.startswith(".")]


def current(spark: SparkSession, path: str) -> dict | None:
    """The manifest readers go by: ``version, schema, partition_by, folders``."""
    files = _Files(spark, path)
    names = _manifests(files)
    return json.loads(files.read(f"_manifests/{names[-1]}")) if names else None


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, touched_only: bool = False) -> int:
    """Make ``df`` the content of ``path`` (or, with ``touched_only``, of the
    partitions it has rows of). Returns the new version number."""
    spark, partition_by = df.sparkSession, list(partition_by or [])
    if VERSION in df.columns:
        raise ValueError(f"{VERSION} is a reserved column name")
    files, before = _Files(spark, path), current(spark, path)
    if before and touched_only and (before["partition_by"] != partition_by
                                    or T.StructType.fromJson(before["schema"]) != _nullable(df.schema)):
        raise ValueError("touched_only needs the schema and partitions of the published version")
    version = (before["version"] if before else 0) + 1
    folder = f"{VERSION}={version}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{files.base}/{folder}")

    folders = [folder]
    for _ in partition_by:
        folders = [f"{f}/{name}" for f in folders for name in files.names(f) if "=" in name]
    if before and touched_only:
        new = {f.split("/", 1)[-1] for f in folders} if partition_by else {""}
        folders += [f for f in before["folders"] if partition_by and f.split("/", 1)[-1] not in new]
    files.create(f"_manifests/{version:010d}.json", json.dumps({
        "version": version, "schema": _nullable(df.schema).jsonValue(), "partition_by": partition_by, "folders": folders}))

    names = _manifests(files)
    kept = {f.split("/")[0] for n in names[-2:] for f in json.loads(files.read(f"_manifests/{n}"))["folders"]} | {folder}
    for n in names[:-2]:
        files.delete(f"_manifests/{n}")
    for n in files.names(""):
        number = n.removeprefix(f"{VERSION}=").split("-")[0]
        if n.startswith(f"{VERSION}=") and n not in kept and number.isdigit() and int(number) < version:
            files.delete(n)
    return version


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version."""
    manifest = current(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    schema, base = T.StructType.fromJson(manifest["schema"]), path.rstrip("/")
    if not manifest["folders"]:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return (spark.read.schema(stored).option("basePath", base)
            .parquet(*[f"{base}/{f}" for f in manifest["folders"]]).select(*schema.names))
