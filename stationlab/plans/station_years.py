"""Everything the analyses need of a station-year, from one read of the observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.plans.snowmelt import snow_columns
from stationlab.schemas import EARLY_WINTER, LATE_SPRING, LATE_WINTER, SNOW_SEASON, SPRING


def station_years(obs: DataFrame) -> DataFrame:
    """Rows, both winter halves, spring maxima, snow and late-spring rain per station-year.

    One conditional aggregation, combined before the shuffle; the result has a row per station and
    calendar year, and the functions below take each analysis's side from it."""
    month, element, value = F.col("month"), F.col("ELEMENT"), F.col("VALUE")
    rain, tmax = element == "PRCP", element == "TMAX"
    early, late = rain & month.isin(*EARLY_WINTER), rain & month.isin(*LATE_WINTER)
    wet, spring = rain & month.isin(*LATE_SPRING), tmax & month.isin(*SPRING)
    snow = F.coalesce(
        (element == "SNWD") & month.isin(*SNOW_SEASON) & (value > 0), F.lit(False)
    )
    return obs.groupBy("STATION", "year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(early, value)).alias("early_winter_prcp"),
        F.count_if(early).alias("early_days"),
        F.sum(F.when(late, value)).alias("late_winter_prcp"),
        F.count_if(late).alias("late_days"),
        F.avg(F.when(spring, value)).alias("spring_avg_tmax"),
        F.count_if(spring).alias("spring_days"),
        F.stddev_samp(F.when(spring, value)).alias("spring_temp_std"),
        *[column.alias(name) for name, column in snow_columns(snow).items()],
        F.sum(F.when(wet, value)).alias("spring_prcp"),
        F.count_if(wet).alias("spring_prcp_days"),
        F.avg(F.when(wet, value)).alias("avg_daily_prcp"),
    )


def winters(years: DataFrame, min_days: int = 50) -> DataFrame:
    """Early winters matched with the late winters of the following year."""
    enough = max(min_days, 1)
    known = years.filter("STATION IS NOT NULL AND year IS NOT NULL")
    early = known.filter(F.col("early_days") >= enough).select(
        "STATION", (F.col("year") + 1).alias("year"), "early_winter_prcp"
    )
    late = known.filter(F.col("late_days") >= enough).select("STATION", "year", "late_winter_prcp")
    return early.join(late, ["STATION", "year"])


def springs(years: DataFrame, min_days: int = 75) -> DataFrame:
    """Mean spring maximum per station-year."""
    return years.filter(F.col("spring_days") >= max(min_days, 1)).select(
        "STATION", "year", "spring_avg_tmax", "spring_days", "spring_temp_std"
    )


def snow_and_rain(years: DataFrame) -> DataFrame:
    """Snowmelt and late-spring rain of the station-years that have one of them."""
    return years.filter("snow_days > 0 OR spring_prcp_days > 0").select(
        "STATION", "year", "snowmelt_doy", "snow_days", "max_snow_depth", "avg_snow_depth",
        "spring_prcp", "spring_prcp_days", "avg_daily_prcp",
    )
