"""Do warm springs precede more summer heat waves?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.functions.dates import season_filter
from stationlab.functions.scalars import fill_missing_counts
from stationlab.functions.stats import mean_where, pearson
from stationlab.operators.seasons import of_element, seasonal_means, with_baseline
from stationlab.operators.windows import heat_wave_flags
from stationlab.schemas import SPRING, SUMMER


def summer_flags(obs: DataFrame, percentile: float = 0.95) -> DataFrame:
    """Heat-wave flags over June-August maxima, at day grain."""
    return heat_wave_flags(season_filter(of_element(obs, "TMAX"), SUMMER), percentile)


def heat_wave_metrics(flags: DataFrame, *more: Column) -> DataFrame:
    """Heat-wave and extreme days per station-year, with peak and mean heat-wave temperature."""
    wave = F.col("is_heat_wave_day")
    days = F.coalesce(F.sum(F.when(wave, F.col("n_extreme"))), F.lit(0))
    return flags.groupBy("STATION", "year").agg(
        days.alias("heat_wave_days"),
        F.max(F.when(wave, F.col("max_value"))).alias("max_heat_wave_temp"),
        F.try_divide(F.sum(F.when(wave, F.col("sum_extreme"))), days).alias("avg_heat_wave_temp"),
        F.sum("n_extreme").alias("extreme_days"),
        F.sum("n_readings").alias("summer_days"),
        *more,
    )


def summer_years(flags: DataFrame) -> DataFrame:
    """The metrics of a station-year with what the trend over years needs besides."""
    return heat_wave_metrics(
        flags,
        F.sum("sum_value").alias("sum_value"),
        F.sum("n_known").alias("n_known"),
        F.max("max_value").alias("max_value"),
    )


def spring_means(obs: DataFrame, min_days: int = 75) -> DataFrame:
    """Mean spring maximum per station-year."""
    return seasonal_means(obs, "TMAX", SPRING, min_days).withColumnsRenamed(
        {"mean": "spring_avg_tmax", "days": "spring_days", "std": "spring_temp_std"}
    )


def with_spring_anomaly(springs: DataFrame, min_years: int = 5) -> DataFrame:
    """Springs with their station's baseline and the standardised anomaly."""
    difference = F.col("spring_avg_tmax") - F.col("baseline")
    return (
        with_baseline(springs, "spring_avg_tmax", min_n=min_years, need_spread=True)
        .withColumn("spring_temp_anomaly", F.try_divide(difference, F.col("std")))
        .withColumnsRenamed(
            {"baseline": "baseline_spring_temp", "std": "std_spring_temp", "n": "num_years"}
        )
    )


def heat_of(springs: DataFrame, metrics: DataFrame, min_years: int = 5) -> DataFrame:
    """Spring station-years with the heat-wave metrics of the same year's summer.

    A year without summer rows has no heat-wave days and no intensity. Both sides are placed by
    station-year when they meet; the baseline comes last, so that only its shuffle is added."""
    joined = springs.join(metrics, ["STATION", "year"], "left")
    counted = fill_missing_counts(joined, ["heat_wave_days", "extreme_days"])
    return with_spring_anomaly(counted, min_years)


def heat_detail(
    obs: DataFrame, percentile: float = 0.95, min_days: int = 75, min_years: int = 5
) -> DataFrame:
    """`heat_of` the springs and summers of the readings."""
    metrics = heat_wave_metrics(summer_flags(obs, percentile))
    return heat_of(spring_means(obs, min_days), metrics, min_years)


def heat_summary(
    detail: DataFrame, by: Sequence[str] = (), percentile: float = 0.95
) -> DataFrame:
    anomaly = F.col("spring_temp_anomaly")
    warm, cool = anomaly > 1, anomaly < -1
    waves, extremes = F.col("heat_wave_days"), F.col("extreme_days")
    return detail.groupBy(*by).agg(
        pearson(anomaly, waves).alias("correlation_days"),
        pearson(anomaly, F.col("max_heat_wave_temp")).alias("correlation_intensity"),
        pearson(anomaly, extremes).alias("correlation_extreme_days"),
        mean_where(waves, warm).alias("avg_hw_warm_spring"),
        mean_where(waves, cool).alias("avg_hw_cool_spring"),
        mean_where(extremes, warm).alias("avg_extreme_warm_spring"),
        mean_where(extremes, cool).alias("avg_extreme_cool_spring"),
        F.count_if(warm).alias("warm_spring_cases"),
        F.count_if(cool).alias("cool_spring_cases"),
        F.count(F.lit(1)).alias("sample_size"),
        F.lit(round(percentile * 100.0, 6)).alias("heat_threshold_percentile"),
    )


def spring_summer_heat(
    obs: DataFrame, percentile: float = 0.95, min_days: int = 75, min_years: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(detail, one-row summary)."""
    detail = heat_detail(obs, percentile, min_days, min_years)
    return detail, heat_summary(detail, percentile=percentile)


def heat_wave_trends(obs: DataFrame, percentile: float = 0.95) -> DataFrame:
    """Heat-wave days and mean and maximum summer temperature per year, by year."""
    return trends_of(summer_years(summer_flags(obs, percentile)))


def trends_of(summers: DataFrame) -> DataFrame:
    """The trends from `summer_years`."""
    return (
        summers.groupBy("year")
        .agg(
            F.sum("heat_wave_days").alias("total_hw_days"),
            F.sum("heat_wave_days").alias("hw_day_count"),
            F.try_divide(F.sum("sum_value"), F.sum("n_known")).alias("avg_summer_temp"),
            F.max("max_value").alias("max_summer_temp"),
        )
        .orderBy("year")
    )
