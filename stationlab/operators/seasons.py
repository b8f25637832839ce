"""Seasonal aggregates per station-year and the baselines over them.

The first aggregation of every analysis goes from readings to station-years. It is combined
within each task before the shuffle, so a station with a large share of the readings costs no
more than any other, and what follows per station has at most one row per calendar year.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.functions.dates import season_filter


def of_element(obs: DataFrame, element: str) -> DataFrame:
    return obs.filter(F.col("ELEMENT") == element)


def seasonal_totals(
    obs: DataFrame, element: str, months: Iterable[int], min_days: int = 50
) -> DataFrame:
    """Sum, rows and mean of an element per station-year, where there are enough rows."""
    return (
        season_filter(of_element(obs, element), months)
        .groupBy("STATION", "year")
        .agg(
            F.sum("VALUE").alias("total"),
            F.count(F.lit(1)).alias("days"),
            F.avg("VALUE").alias("daily_mean"),
        )
        .filter(F.col("days") >= min_days)
    )


def seasonal_means(
    obs: DataFrame, element: str, months: Iterable[int], min_days: int = 75
) -> DataFrame:
    """Mean, rows and sample deviation of an element per station-year."""
    return (
        season_filter(of_element(obs, element), months)
        .groupBy("STATION", "year")
        .agg(
            F.avg("VALUE").alias("mean"),
            F.count(F.lit(1)).alias("days"),
            F.stddev_samp("VALUE").alias("std"),
        )
        .filter(F.col("days") >= min_days)
    )


def station_baseline(
    detail: DataFrame,
    value: str,
    by: Sequence[str] = ("STATION",),
    min_n: int = 5,
    need_spread: bool = False,
) -> DataFrame:
    """Long-term mean, sample deviation and rows per station."""
    result = (
        detail.groupBy(*by)
        .agg(
            F.avg(value).alias("baseline"),
            F.stddev_samp(value).alias("std"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("n") >= min_n)
    )
    return result.filter("std > 0") if need_spread else result


def baseline_columns(
    value: Column, by: Sequence[str] = ("STATION",), where: Column | None = None
) -> tuple[Column, Column, Column]:
    """Mean, sample deviation and rows over the station, as window columns.

    Over station-year rows this replaces aggregating and joining back: one shuffle instead of
    two and a join."""
    window = Window.partitionBy(*by)
    kept = value if where is None else F.when(where, value)
    rows = F.count(F.lit(1)) if where is None else F.count_if(where)
    return F.avg(kept).over(window), F.stddev_samp(kept).over(window), rows.over(window)


def with_baseline(
    detail: DataFrame,
    value: str,
    by: Sequence[str] = ("STATION",),
    min_n: int = 5,
    need_spread: bool = False,
) -> DataFrame:
    """Detail rows with the baseline of their station; stations failing the gate are dropped."""
    baseline, std, n = baseline_columns(F.col(value), by)
    result = detail.withColumns({"baseline": baseline, "std": std, "n": n}).filter(
        F.col("n") >= min_n
    )
    return result.filter("std > 0") if need_spread else result


def standardized_anomaly(
    detail: DataFrame, value: str, by: Sequence[str] = ("STATION",), min_n: int = 5
) -> DataFrame:
    """Difference from the station's baseline, plain and in standard deviations."""
    return with_baseline(detail, value, by, min_n, need_spread=True).withColumns(
        {
            "difference": F.col(value) - F.col("baseline"),
            "anomaly": F.try_divide(F.col(value) - F.col("baseline"), F.col("std")),
        }
    )


def timeseries_rollup(
    df: DataFrame, by: Sequence[str], value: str, time: str = "year"
) -> DataFrame:
    """Mean, deviation, extremes and rows of a column per group and time, ordered by time."""
    return (
        df.groupBy(*by, time)
        .agg(
            F.avg(value).alias(f"avg_{value}"),
            F.stddev_samp(value).alias(f"std_{value}"),
            F.min(value).alias(f"min_{value}"),
            F.max(value).alias(f"max_{value}"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy(time)
    )


def linear_trend(
    series: DataFrame, value: str, time: str = "year", by: Sequence[str] = ("STATION",)
) -> DataFrame:
    """Least-squares line of a value over time per group; NULL where time does not vary."""
    y, x = F.col(value), F.col(time).cast("double")
    return series.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_count(y, x).alias("n"),
    )
