"""Does an early snowmelt precede a dry spring?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.functions.dates import day_of_year, is_calendar_day, season_filter
from stationlab.functions.stats import mean_where, pearson, percent_of
from stationlab.operators.joins import attach_elevation
from stationlab.operators.seasons import baseline_columns, of_element
from stationlab.schemas import LATE_SPRING, SNOW_SEASON


def snow_columns(snow: Column) -> dict[str, Column]:
    """Aggregates of the snow rows of a station-year.

    Within a year the last day of the year is that of the largest date, so dates are turned
    into days once per station-year instead of once per row."""
    depth = F.when(snow, F.col("VALUE"))
    last = F.max(F.when(snow & is_calendar_day("DATE"), F.col("DATE")))
    return {
        "snowmelt_doy": day_of_year(last),
        "snow_days": F.count_if(snow),
        "max_snow_depth": F.max(depth),
        "avg_snow_depth": F.avg(depth),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def snowmelt_dates(obs: DataFrame) -> DataFrame:
    """Last day with snow on the ground in January-May, per station-year."""
    snow = season_filter(of_element(obs, "SNWD"), SNOW_SEASON).filter("VALUE > 0")
    return snow.groupBy("STATION", "year").agg(*_named(snow_columns(F.lit(True))))


def snow_and_rain(obs: DataFrame) -> DataFrame:
    """Snowmelt and April-May precipitation per station-year, from one aggregation."""
    month = F.col("month")
    snow = (
        (F.col("ELEMENT") == "SNWD") & month.isin(*SNOW_SEASON) & (F.col("VALUE") > 0)
    )
    rain = (F.col("ELEMENT") == "PRCP") & month.isin(*LATE_SPRING)
    snow_known = F.coalesce(snow, F.lit(False))
    amount = F.when(rain, F.col("VALUE"))
    return (
        obs.filter(F.col("ELEMENT").isin("SNWD", "PRCP") & month.isin(*SNOW_SEASON))
        .filter(snow_known | rain)
        .groupBy("STATION", "year")
        .agg(
            *_named(snow_columns(snow_known)),
            F.sum(amount).alias("spring_prcp"),
            F.count_if(rain).alias("spring_prcp_days"),
            F.avg(amount).alias("avg_daily_prcp"),
        )
    )


def melt_anomalies(
    rows: DataFrame, min_snow_days: int = 10, min_days: int = 50, min_years: int = 5
) -> DataFrame:
    """Station-years with both baselines and the flags `_snow` and `_paired`.

    Each baseline uses every station-year that passes its own gate, before the two sides are
    paired. `_paired` marks the rows of the analysis."""
    snow_ok = F.col("snow_days") >= max(min_snow_days, 1)
    rain_ok = F.col("spring_prcp_days") >= max(min_days, 1)
    melt, rain = F.col("snowmelt_doy"), F.col("spring_prcp")
    melt_mean, melt_std, melt_n = baseline_columns(melt, where=snow_ok)
    rain_mean, rain_std, rain_n = baseline_columns(rain, where=rain_ok)
    mean_snow_days, _, _ = baseline_columns(F.col("snow_days"), where=snow_ok)
    return (
        rows.withColumns(
            {
                "baseline_melt_doy": melt_mean,
                "std_melt_doy": melt_std,
                "years_with_snow": melt_n,
                "avg_snow_days": mean_snow_days,
                "baseline_spring_prcp": rain_mean,
                "std_spring_prcp": rain_std,
                "prcp_years": rain_n,
            }
        )
        .withColumns(
            {
                "melt_anomaly_days": melt - F.col("baseline_melt_doy"),
                "melt_anomaly_std": F.try_divide(
                    melt - F.col("baseline_melt_doy"), F.col("std_melt_doy")
                ),
                "prcp_anomaly_mm": rain - F.col("baseline_spring_prcp"),
                "prcp_anomaly_std": F.try_divide(
                    rain - F.col("baseline_spring_prcp"), F.col("std_spring_prcp")
                ),
                "_snow": snow_ok,
                "_paired": F.coalesce(
                    snow_ok
                    & rain_ok
                    & (F.col("years_with_snow") >= min_years)
                    & (F.col("std_melt_doy") > 0)
                    & (F.col("prcp_years") >= min_years)
                    & (F.col("std_spring_prcp") > 0),
                    F.lit(False),
                ),
            }
        )
    )


def melt_precip_years(
    obs: DataFrame, min_snow_days: int = 10, min_days: int = 50, min_years: int = 5
) -> DataFrame:
    """`melt_anomalies` of the readings."""
    return melt_anomalies(snow_and_rain(obs), min_snow_days, min_days, min_years)


def melt_precip_join(years: DataFrame) -> DataFrame:
    """The station-years on which both sides pass their gates."""
    return years.filter("_paired").drop("_snow", "_paired")


def snowmelt_summary(years: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    paired = F.col("_paired")

    def of_pairs(name: str) -> Column:
        return F.when(paired, F.col(name))

    melt, melt_std = of_pairs("snowmelt_doy"), of_pairs("melt_anomaly_std")
    rain, rain_std = of_pairs("spring_prcp"), of_pairs("prcp_anomaly_std")
    early, late = melt_std < -1, melt_std > 1
    return (
        years.groupBy(*by)
        .agg(
            pearson(melt, rain).alias("correlation"),
            pearson(melt_std, rain_std).alias("correlation_standardized"),
            pearson(of_pairs("melt_anomaly_days"), rain).alias("correlation_days"),
            mean_where(rain_std, early).alias("early_melt_prcp_anomaly"),
            mean_where(rain_std, late).alias("late_melt_prcp_anomaly"),
            F.count_if(early).alias("early_melt_cases"),
            F.count_if(late).alias("late_melt_cases"),
            percent_of(rain_std < 0, early).alias("early_dry_rate"),
            percent_of(rain_std > 0, late).alias("late_wet_rate"),
            F.count_if(paired).alias("sample_size"),
            F.count_distinct(F.when(paired, F.col("STATION"))).alias("num_stations"),
            F.count_if("_snow").alias("_snow_years"),
        )
        # The texts of the status.
        .withColumn(
            "status",
            F.when(F.col("_snow_years") == 0, "No snow data")
            .when(F.col("sample_size") == 0, "No overlapping data")
            .otherwise("ok"),
        )
        .drop("_snow_years")
    )


def snowmelt_precip(
    obs: DataFrame, min_snow_days: int = 10, min_days: int = 50, min_years: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(detail, one-row summary)."""
    years = melt_precip_years(obs, min_snow_days, min_days, min_years)
    return melt_precip_join(years), snowmelt_summary(years)


def snowmelt_by_elevation(
    obs: DataFrame,
    stations: DataFrame,
    min_snow_days: int = 10,
    min_days: int = 50,
    min_years: int = 5,
) -> DataFrame:
    """The summary per elevation band. Baselines are per station: one pass serves all bands."""
    years = melt_precip_years(obs, min_snow_days, min_days, min_years)
    return snowmelt_summary(attach_elevation(years, stations, salts=1), ["elev_band"])


def snowmelt_trends(obs: DataFrame) -> DataFrame:
    """Melt day statistics per year, over all station-years with snow, by year."""
    return trends_of(snowmelt_dates(obs))


def trends_of(melts: DataFrame) -> DataFrame:
    """The trends from station-years with snow."""
    return (
        melts.groupBy("year")
        .agg(
            F.avg("snowmelt_doy").alias("avg_melt_doy"),
            F.stddev_samp("snowmelt_doy").alias("std_melt_doy"),
            F.min("snowmelt_doy").alias("earliest_melt"),
            F.max("snowmelt_doy").alias("latest_melt"),
            F.count(F.lit(1)).alias("num_stations"),
        )
        .orderBy("year")
    )
