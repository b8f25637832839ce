"""Exact per-group percentiles and threshold flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.operators.joins import salted_lookup


def keyed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows on which all key columns are known.

    Stated up front, the test is the same in every branch that reads the rows, which keeps
    their plans equal and lets Spark run a shared shuffle once."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def counted_readings(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """How often (`n`) each value occurs per group: percentiles of the group, and of any coarser one,
    follow from it with `weight=F.col("n")`, and share its one shuffle of the readings."""
    return keyed(df, list(by)).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def percentile_by_group(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    p: float,
    weight: Column | None = None,
    name: str = "threshold",
    slice_width: float = 0.1,
) -> DataFrame:
    """Exact interpolated percentile of `value` per group, safe for groups of any size.

    Equal readings are first counted, which Spark combines before the shuffle. The counts are
    then summed over slices of the value axis; only the one or two slices that hold the wanted
    ranks are ordered. No task ever holds more of a group than its slices or one slice of
    its distinct readings. A slice is by default one step of readings in tenths; take a wider one
    for values of a much larger range. NULL and NaN readings are ignored. `weight` is the multiplicity of
    a row."""
    by = list(by)
    # NaN is an unknown reading, as NULL is.
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    # A NULL reading becomes a zero of weight 0: with no filter of its own, this branch shares
    # the scan and the shuffle of its input with whatever else reads that input.
    readings = (
        keyed(df, by)
        .select(
            *by,
            F.when(known, F.floor(F.col(value) / F.lit(slice_width)))
            .otherwise(0)
            .alias("_slice"),
            F.when(known, F.col(value).cast("double")).otherwise(0.0).alias("_value"),
            F.when(known, F.lit(1) if weight is None else weight)
            .otherwise(0)
            .cast("long")
            .alias("_n"),
        )
        .groupBy(*by, "_slice", "_value")
        .agg(F.sum("_n").alias("_n"))
    )

    def reaches(below: Column, upto: Column, rank: str) -> Column:
        return (F.col(rank) >= below) & (F.col(rank) < upto)

    position = F.lit(float(p)) * (F.sum("_n").over(Window.partitionBy(*by)) - 1)
    upto = F.sum("_n").over(
        Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    )
    slices = (
        readings.groupBy(*by, "_slice")
        .agg(F.sum("_n").alias("_n"))
        .withColumns({"_position": position, "_upto": upto})
        .withColumns(
            {
                "_below": F.col("_upto") - F.col("_n"),
                "_low": F.floor("_position"),
                "_high": F.ceil("_position"),
            }
        )
        .filter(
            reaches(F.col("_below"), F.col("_upto"), "_low")
            | reaches(F.col("_below"), F.col("_upto"), "_high")
        )
        .select(*by, "_slice", "_below", "_position", "_low", "_high")
    )
    inside = Window.partitionBy(*by, "_slice").orderBy("_value")
    reached = F.col("_below") + F.sum("_n").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)
    )
    low, high = F.col("_low_value"), F.col("_high_value")
    return (
        readings.join(slices, [*by, "_slice"])
        .withColumn("_reached", reached)
        .withColumn("_before", F.col("_reached") - F.col("_n"))
        .groupBy(*by)
        .agg(
            F.max("_position").alias("_position"),
            F.max(
                F.when(reaches(F.col("_before"), F.col("_reached"), "_low"), F.col("_value"))
            ).alias("_low_value"),
            F.max(
                F.when(reaches(F.col("_before"), F.col("_reached"), "_high"), F.col("_value"))
            ).alias("_high_value"),
        )
        .select(
            *by,
            F.when(low == high, low)
            .otherwise(
                (F.ceil("_position") - F.col("_position")) * low
                + (F.col("_position") - F.floor("_position")) * high
            )
            .alias(name),
        )
    )


def threshold_join(
    df: DataFrame,
    value: str,
    p: float,
    by: Sequence[str] = ("STATION",),
    flag: str = "is_extreme",
    name: str = "threshold",
) -> DataFrame:
    """Rows with the percentile of their group and a flag for values strictly above it."""
    limits = percentile_by_group(df, by, value, p, name=name)
    return salted_lookup(df, limits, list(by)).withColumn(flag, F.col(value) > F.col(name))
