"""Incremental ingest of yearly files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlab.functions.dates import year_of
from stationlab.operators.joins import station_semi_join
from stationlab.operators.prep import clean_observations
from stationlab.schemas import RAW_DAILY
from stationlab.session import path_exists, remove_path

DELIVERED = T.StructType([*RAW_DAILY.fields, T.StructField("delivery", T.IntegerType())])
INGESTED = ["year", "delivery", "batch"]


def ingest_years(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    station_ids: DataFrame | None = None,
    clean: bool = True,
    files_per_batch: int = 64,
    pattern: str = "*.csv*",
) -> None:
    """Adds the yearly files of `source` that were not ingested before to `target`.

    The file source remembers finished files in `checkpoint`, and the Parquet sink commits
    each batch as a whole, so every file is ingested once even after a failure. Runs until no
    new file is left."""
    raw = (
        spark.readStream.schema(RAW_DAILY)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source, header=False)
    )
    rows = clean_observations(raw) if clean else raw
    if station_ids is not None:
        rows = station_semi_join(rows, station_ids)
    query = (
        rows.withColumn("year", year_of("DATE"))
        .writeStream.format("parquet")
        .partitionBy("year")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def batch_writer(target: str, clean: bool = True) -> Callable[[DataFrame, int], None]:
    """Writes a batch of delivered rows as the partitions (year, delivery, batch).

    The partitions belong to this batch alone and are replaced as a whole, so a batch that runs
    again, after a failure or by mistake, leaves the same rows."""

    def write(rows: DataFrame, batch: int) -> None:
        kept = clean_observations(rows, ["delivery"]) if clean else rows
        (
            kept.withColumns({"year": year_of("DATE"), "batch": F.lit(batch)})
            .hint("rebalance", "year", "delivery")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*INGESTED)
            .parquet(target)
        )

    return write


def ingest_deliveries(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    pattern: str = "*.csv*",
) -> None:
    """Adds deliveries of yearly files, `source`/delivery=N/*.csv, that were not ingested before.

    A delivery holds whole years. Of a year the delivery of the highest number counts, whenever it
    arrives: `current_years` reads it, `drop_superseded` removes the others. Files of a delivery may
    come in several batches. A corrected file belongs to a delivery of its own, as the file source
    takes a path once."""
    reader = spark.readStream.schema(DELIVERED).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.csv(source, header=False)
        .writeStream.foreachBatch(batch_writer(target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _partitions(spark: SparkSession, target: str) -> DataFrame:
    """(year, delivery, batch, newest) from the partition columns alone."""
    found = spark.read.parquet(target).select(*INGESTED).distinct()
    newest = found.groupBy("year").agg(F.max("delivery").alias("newest"))
    return found.join(newest.withColumnRenamed("year", "y"), F.col("year").eqNullSafe(F.col("y"))).drop("y")


def current_years(spark: SparkSession, target: str) -> DataFrame:
    """The readings of each year's newest delivery; partitions of older ones are not opened."""
    newest = _partitions(spark, target).filter("delivery = newest")
    newest = newest.select(*[F.col(c).alias(f"_{c}") for c in INGESTED])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in INGESTED]
    rows = spark.read.parquet(target)
    # One row per stored partition.
    return rows.join(F.broadcast(newest), same, "left_semi").drop("delivery", "batch")


def drop_superseded(spark: SparkSession, target: str) -> list[tuple[int, int]]:
    """Removes what newer deliveries replaced; returns its (year, delivery). Not while others read."""
    old = _partitions(spark, target).filter("delivery < newest").select("year", "delivery").distinct()
    removed = []
    for year, delivery in sorted(map(tuple, old.collect()), key=repr):
        name = "__HIVE_DEFAULT_PARTITION__" if year is None else year
        path = f"{target}/year={name}/delivery={delivery}"
        if path_exists(spark, path):
            remove_path(spark, path)
            removed.append((year, delivery))
    return removed
