"""Does a dry early winter precede a wet late winter?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.functions.stats import pearson, percent_of
from stationlab.operators.joins import attach_region
from stationlab.operators.seasons import baseline_columns, of_element
from stationlab.schemas import EARLY_WINTER, LATE_WINTER


def matched_winters(obs: DataFrame, min_days: int = 50) -> DataFrame:
    """Precipitation of November-December and of the following February-March per station.

    Both halves come from one aggregation: early rows count to the next year's winter."""
    early = F.col("month").isin(*EARLY_WINTER)
    late = F.col("month").isin(*LATE_WINTER)
    enough = max(min_days, 1)
    return (
        of_element(obs, "PRCP")
        .filter(early | late)
        .groupBy("STATION", F.when(early, F.col("year") + 1).otherwise(F.col("year")).alias("year"))
        .agg(
            F.sum(F.when(early, F.col("VALUE"))).alias("early_winter_prcp"),
            F.sum(F.when(late, F.col("VALUE"))).alias("late_winter_prcp"),
            F.count_if(early).alias("_early_days"),
            F.count_if(late).alias("_late_days"),
        )
        .filter((F.col("_early_days") >= enough) & (F.col("_late_days") >= enough))
        .drop("_early_days", "_late_days")
    )


def winter_anomalies(winters: DataFrame, min_years: int = 5) -> DataFrame:
    """Matched winters with the baselines over them and both anomalies."""
    early, late = F.col("early_winter_prcp"), F.col("late_winter_prcp")
    mean_early, std_early, years = baseline_columns(early)
    mean_late, std_late, _ = baseline_columns(late)
    return (
        winters.withColumns(
            {
                "baseline_early": mean_early,
                "baseline_late": mean_late,
                "std_early": std_early,
                "std_late": std_late,
                "num_years": years,
            }
        )
        .filter((F.col("num_years") >= min_years) & (F.col("std_early") > 0))
        .withColumns(
            {
                "early_anomaly": F.try_divide(early - F.col("baseline_early"), F.col("std_early")),
                "late_anomaly": F.try_divide(late - F.col("baseline_late"), F.col("std_late")),
            }
        )
    )


def winter_detail(obs: DataFrame, min_days: int = 50, min_years: int = 5) -> DataFrame:
    """Station-winters with the baselines over matched winters and both anomalies."""
    return winter_anomalies(matched_winters(obs, min_days), min_years)


def winter_summary(detail: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    early, late = F.col("early_anomaly"), F.col("late_anomaly")
    return detail.groupBy(*by).agg(
        pearson(early, late).alias("correlation"),
        F.count(F.lit(1)).alias("sample_size"),
        percent_of(late > 0, early < -1).alias("compensation_rate"),
        percent_of(late < 0, early > 1).alias("reverse_compensation_rate"),
        F.count_if(early < -1).alias("dry_early_cases"),
        F.count_if(early > 1).alias("wet_early_cases"),
    )


def winter_precip_lag(
    obs: DataFrame, min_days: int = 50, min_years: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(detail, one-row summary)."""
    detail = winter_detail(obs, min_days, min_years)
    return detail, winter_summary(detail)


def winter_precip_by_region(
    obs: DataFrame, stations: DataFrame, min_days: int = 50, min_years: int = 5
) -> DataFrame:
    """The summary per region. Baselines are per station, so one pass serves all regions."""
    detail = attach_region(winter_detail(obs, min_days, min_years), stations, salts=1)
    return winter_summary(detail.filter(F.col("REGION").isNotNull()), ["REGION"])
