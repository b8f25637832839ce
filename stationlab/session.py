"""Shared-folder helpers: scratch space and durable cuts of the lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FOLDER = "stationlab"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, with its scheme. Where that is unset: on a local
    master, which has one machine only, a folder of this application below spark.local.dir; on a
    cluster a folder below the home of the default file system, which all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    folder = folder or context.getCheckpointDir()
    if folder:
        return qualified(spark, folder)
    if context.master == "local" or context.master.startswith("local["):
        local = spark.conf.get("spark.local.dir", "/tmp").split(",")[0]
        return f"file:{local}/{FOLDER}-{context.applicationId}"
    files = context._jvm.org.apache.hadoop.fs.FileSystem.get(context._jsc.hadoopConfiguration())
    return f"{files.getHomeDirectory().toString()}/.{FOLDER}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority, as Spark's default file system completes it, so that
    readers other than Spark find the same place."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    return files.makeQualified(place).toString()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before. Lazy results may read it, so it stays
    until its owner drops it, or the whole folder, with `drop_scratch`."""
    return f"{shared_folder(spark).rstrip('/')}/{FOLDER}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored there, in any file system Spark knows."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Removes one scratch path, or all of them; nothing that reads them may run later."""
    top = f"{shared_folder(spark).rstrip('/')}/{FOLDER}"
    if path is not None and not path.startswith(f"{top}/"):
        raise ValueError(f"not a scratch path: {path}")
    remove_path(spark, path or top)


def durable(df: DataFrame) -> DataFrame:
    """`df` computed once into the checkpoint folder, so that later stages which must all see
    the same rows and partitions do so even after an executor is lost."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what runs inside; afterwards it is as before."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)
