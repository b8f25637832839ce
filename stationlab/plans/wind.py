"""Does the diurnal temperature range shrink after high wind?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlab.functions.dates import month_of, season_name
from stationlab.functions.stats import percent_of
from stationlab.operators.windows import before_after_columns, lag_lead_columns, pivot_wide


def wind_days(
    obs: DataFrame,
    n: int = 7,
    percentile: float = 0.90,
    min_days: int = 100,
    by: Sequence[str] = ("STATION",),
) -> DataFrame:
    """All days with the three readings, the station's wind threshold and the frames around.

    One shuffle by station serves the percentile, the day count, the neighbours and the frames,
    and leaves the days placed by station for a later lookup. The table has one row per
    station and date, so a station holds its calendar days at most.

    Days without a positive range stay in the table, so that the summary can tell missing
    readings from missing events. They take no part in thresholds and, ordered last and without
    a range, none in frames either."""
    keep = [c for c in by if c != "STATION"]
    station = Window.partitionBy(*by)
    in_order = station.orderBy(F.desc("_usable"), "DATE")
    usable = F.col("_usable")
    daily = (
        pivot_wide(obs, keep=keep)
        .withColumn("temp_range", F.col("TMAX") - F.col("TMIN"))
        .withColumn("_usable", F.coalesce(F.col("temp_range") > 0, F.lit(False)))
        .withColumn("temp_range", F.when(usable, F.col("temp_range")))
        .withColumn("_wind", F.when(usable, F.col("AWND")))
    )
    return (
        daily.withColumns(
            {
                **lag_lead_columns("temp_range", n, in_order),
                **before_after_columns(
                    "temp_range", n, in_order, "avg_range_before", "avg_range_after"
                ),
            }
        )
        .withColumns(
            {
                "wind_threshold": F.percentile("_wind", F.lit(percentile)).over(station),
                "avg_wind": F.avg("_wind").over(station),
                "total_days": F.count_if(usable).over(station),
            }
        )
        .withColumn("is_high_wind", F.col("AWND") > F.col("wind_threshold"))
        .withColumn("range_change", F.col("avg_range_after") - F.col("avg_range_before"))
        .withColumn(
            "_is_event",
            F.coalesce(
                usable
                & (F.col("total_days") >= min_days)
                & F.col("is_high_wind")
                & F.col("range_change").isNotNull(),
                F.lit(False),
            ),
        )
        .drop("_usable", "_wind")
    )


def high_wind_events(days: DataFrame) -> DataFrame:
    """Days above their station's wind percentile with complete frames before and after."""
    return days.filter("_is_event").drop("_is_event")


def event_summary(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.groupBy(*by).agg(
        F.avg("avg_range_before").alias("avg_range_before"),
        F.avg("avg_range_after").alias("avg_range_after"),
        F.avg("range_change").alias("avg_range_change"),
        F.stddev_samp("range_change").alias("std_range_change"),
        F.count(F.lit(1)).alias("num_events"),
    )


def wind_summary(days: DataFrame, by: Sequence[str] = (), n: int = 7) -> DataFrame:
    """Event metrics with the moderation rate, and why there are none."""
    event = F.col("_is_event")

    def of_events(name: str):
        return F.when(event, F.col(name))

    return (
        days.groupBy(*by)
        .agg(
            F.avg(of_events("avg_range_before")).alias("avg_range_before"),
            F.avg(of_events("avg_range_after")).alias("avg_range_after"),
            F.avg(of_events("range_change")).alias("avg_range_change"),
            F.stddev_samp(of_events("range_change")).alias("std_range_change"),
            F.count_if(event).alias("num_events"),
            percent_of(F.col("range_change") < 0, event).alias("moderation_rate"),
            F.lit(n).alias("lag_days"),
            F.count(F.lit(1)).alias("_days"),
        )
        # The texts of the status.
        .withColumn(
            "status",
            F.when(F.col("_days") == 0, "No overlapping data")
            .when(F.col("num_events") == 0, "No complete events")
            .otherwise("ok"),
        )
        .drop("_days")
    )


def wind_moderation(
    obs: DataFrame, n: int = 7, percentile: float = 0.90, min_days: int = 100
) -> tuple[DataFrame, DataFrame]:
    """(events, one-row summary)."""
    days = wind_days(obs, n, percentile, min_days)
    return high_wind_events(days), wind_summary(days, n=n)


def wind_by_season(
    obs: DataFrame, n: int = 7, percentile: float = 0.90, min_days: int = 100
) -> DataFrame:
    """The summary per season; thresholds, the day gate and frames stay inside a season."""
    seasonal = obs.withColumn("season", season_name(month_of("DATE")))
    days = wind_days(seasonal, n, percentile, min_days, by=("STATION", "season"))
    return wind_summary(days, ["season"], n)
