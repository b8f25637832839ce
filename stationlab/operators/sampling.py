"""Repeatable samples of stations and of their observations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.operators.joins import station_key
from stationlab.schemas import MAP_QUOTAS, SELECTION_QUOTAS
from stationlab.session import durable


def _quota_table(df: DataFrame, quotas: Mapping[str, int]) -> DataFrame:
    return F.broadcast(
        df.sparkSession.createDataFrame(list(quotas.items()), "REGION string, _quota int")
    )


def _lottery(key: str, seed: str) -> Column:
    return F.md5(F.concat(F.col(key), F.lit(seed)))


def sample_observations(
    df: DataFrame, fraction: float, seed: int = 42, unit: str = "station"
) -> DataFrame:
    """A share of the data.

    unit="station" keeps whole stations, chosen by a hash of their id, so that day-count gates
    still mean the same; unit="row" draws single rows."""
    if fraction >= 1.0:
        return df
    if unit == "row":
        return df.sample(fraction=fraction, seed=seed)
    if unit != "station":
        raise ValueError(f"unknown sampling unit: {unit}")
    limit = format(int(fraction * 16**15), "015x")
    return df.filter(F.substring(_lottery("STATION", str(seed)), 1, 15) < limit)


def regional_random_sample(
    stations: DataFrame, quotas: Mapping[str, int] = MAP_QUOTAS, seed: str = "42"
) -> DataFrame:
    """Up to a quota of random stations per region; other regions are left out.

    The constant limit lets Spark keep only the best rows of each region inside each task
    before the shuffle, so a region of any size is safe."""
    key = station_key(stations)
    order = Window.partitionBy("REGION").orderBy(_lottery(key, seed), key)
    return (
        stations.filter(F.col("REGION").isin(*quotas))
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= max(quotas.values()))
        .join(_quota_table(stations, quotas), "REGION")
        .filter(F.col("_place") <= F.col("_quota"))
        .select(*stations.columns)
    )


def numbered_within(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds the 0-based `position` and the `group_size` of each row in its group.

    The rows are range-partitioned, so one group may span many tasks; positions are the place
    in the partition plus the rows of the group in earlier partitions. Rows that are equal in
    `order` follow their input partition, which keeps a mass of copies from ending up in one
    task. The ordered rows are checkpointed because both counts must see the same partitions."""
    keys = [group, *order, "_input"]
    placed = durable(
        df.withColumn("_input", F.spark_partition_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            *df.columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    parts = placed.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_start")
    )
    earlier = Window.partitionBy(group).orderBy("_part")
    parts = parts.select(
        group,
        "_part",
        "_start",
        (
            F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
        ).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(group)).alias("group_size"),
    )
    return (
        placed.join(parts, [group, "_part"])
        .withColumn("position", F.col("_offset") + F.col("_row") - F.col("_start"))
        .select(*df.columns, "position", "group_size")
    )


def _even_positions(k: Column, n: Column) -> Column:
    """k whole positions spread evenly over 0 .. n-1, both ends included; 0 alone if k is 1, none
    if it is less."""
    step = F.try_divide((n - 1).cast("double"), (k - 1).cast("double"))
    spread = F.transform(
        F.sequence(F.lit(0), k - 1),
        lambda i: F.when(i == k - 1, n - 1).otherwise(F.floor(i * step)),
    )
    single = F.array(F.lit(0).cast("long"))
    return F.when(k > 1, spread).when(k == 1, single).otherwise(F.array().cast("array<bigint>"))


def even_spaced_sample(
    stations: DataFrame, quotas: Mapping[str, int] = SELECTION_QUOTAS
) -> DataFrame:
    """Stations spread evenly over the elevations of each region.

    A region with no more stations than its quota is taken whole. Equal elevations are ordered
    by station id."""
    key = station_key(stations)
    order = numbered_within(
        stations.filter(F.col("REGION").isin(*quotas)),
        "REGION",
        ["ELEVATION", key],
    )
    quota = _quota_table(stations, quotas)
    ranked = order.join(quota, "REGION")
    wanted = (
        ranked.filter((F.col("position") == 0) & (F.col("group_size") > F.col("_quota")))
        .select(
            "REGION",
            F.explode(_even_positions(F.col("_quota"), F.col("group_size"))).alias("position"),
        )
        .distinct()
    )
    whole = ranked.filter(F.col("group_size") <= F.col("_quota")).select(*stations.columns)
    spread = (
        ranked.filter(F.col("group_size") > F.col("_quota"))
        .join(wanted, ["REGION", "position"], "left_semi")
        .select(*stations.columns)
    )
    return whole.unionByName(spread)
