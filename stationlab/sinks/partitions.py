"""Upserts that rewrite only the partitions they touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlab.operators.upsert import keyed_merge
from stationlab.session import drop_scratch, path_exists, scratch_path


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    partition: str,
    schema: T.StructType,
    order_by: Sequence[str] | None = None,
) -> None:
    """Merges `updates` into the Parquet table at `path`, which is partitioned by one of its keys.

    Only partitions with updates are read (Spark prunes the others by the updates' values) and
    replaced (dynamic partition overwrite); files of all others stay as they are. The merge is as in
    `keyed_merge`. Merged rows are first stored in the shared folder and then put in place, so the
    table is never read while it is written, and a run that ended between can be repeated with the
    same outcome. One writer at a time: of two that touch a partition the later one counts."""
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys {list(keys)}")
    if path_exists(spark, path):
        stored = spark.read.schema(schema).parquet(path)
        touched = updates.select(F.col(partition).cast(schema[partition].dataType).alias("_p")).distinct()
        current = stored.join(F.broadcast(touched), F.col(partition).eqNullSafe(F.col("_p")), "left_semi")
    else:
        current = spark.createDataFrame([], schema)
    rows = keyed_merge(current.select(*schema.names), updates, keys, update_columns, order_by)
    merged = scratch_path(spark, "merged")
    rows.write.parquet(merged)
    (
        spark.read.schema(schema)
        .parquet(merged)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    drop_scratch(spark, merged)


def partition_files(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """(partition, file) of a partitioned table, distinct."""
    rows = spark.read.parquet(path)
    return rows.select(partition, F.col("_metadata.file_name").alias("file")).distinct()
