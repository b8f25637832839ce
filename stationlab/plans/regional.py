"""The four analyses per region, and what they say together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.operators.joins import attach_region, station_regions
from stationlab.plans import station_years
from stationlab.plans.heat import heat_of, heat_summary, heat_wave_metrics, summer_flags
from stationlab.plans.snowmelt import melt_anomalies, snowmelt_summary
from stationlab.plans.wind import wind_days, wind_summary
from stationlab.plans.winter import winter_anomalies, winter_summary

# The names of the analyses.
H1 = "H1_winter_precipitation"
H2 = "H2_spring_summer_heat"
H3 = "H3_wind_moderation"
H4 = "H4_snowmelt_precipitation"
HYPOTHESES = [H1, H2, H3, H4]

# Metrics reported per region, with their source column in each summary.
REGIONAL_METRICS = {
    "correlation": {H1: "correlation", H2: "correlation_days", H4: "correlation"},
    "sample_size": {H1: "sample_size", H2: "sample_size", H4: "sample_size"},
    "compensation_rate": {H1: "compensation_rate"},
    "avg_hw_warm": {H2: "avg_hw_warm_spring"},
    "avg_hw_cool": {H2: "avg_hw_cool_spring"},
    "avg_range_change": {H3: "avg_range_change"},
    "moderation_rate": {H3: "moderation_rate"},
    "num_events": {H3: "num_events"},
    "early_melt_prcp": {H4: "early_melt_prcp_anomaly"},
}
COUNTS = ("sample_size", "num_events")


def _regional(summary: DataFrame, hypothesis: str) -> DataFrame:
    status = F.col("status") if "status" in summary.columns else F.lit("ok")
    metrics = [
        (F.col(source[hypothesis]) if hypothesis in source else F.lit(None))
        .cast("long" if name in COUNTS else "double")
        .alias(name)
        for name, source in REGIONAL_METRICS.items()
    ]
    return summary.select(
        F.lit(hypothesis).alias("hypothesis"), "REGION", *metrics, status.alias("status")
    )


def eligible_regions(rows: DataFrame, stations: DataFrame, min_rows: int = 10_000) -> DataFrame:
    """Regions with at least `min_rows` observations, from tables with `rows` per station."""
    return (
        rows.groupBy("STATION")
        .agg(F.sum("rows").alias("n"))
        .join(station_regions(stations), "STATION")
        .groupBy("REGION")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("REGION").isNotNull() & (F.col("n") >= min_rows))
        .select("REGION")
    )


def regional_consistency(
    obs: DataFrame,
    stations: DataFrame,
    min_rows: int = 10_000,
    heat_percentile: float = 0.95,
    min_days: int = 50,
    min_spring_days: int = 75,
    min_wind_days: int = 100,
    min_years: int = 5,
    lag_days: int = 7,
    years: DataFrame | None = None,
) -> DataFrame:
    """One row per analysis and eligible region; see `regional_of`.

    Nothing runs before the result is used. The observations are read for summer days, for wind days
    and for station-years. Four branches use the latter, so a caller with large observations stores
    `station_years` and gives them as `years`; otherwise each branch computes them."""
    if years is None:
        years = station_years.station_years(obs)
    summers = heat_wave_metrics(summer_flags(obs, heat_percentile))
    tables = {
        "H1": winter_anomalies(station_years.winters(years, min_days), min_years),
        "H2": heat_of(station_years.springs(years, min_spring_days), summers, min_years),
        "H3": wind_days(obs, lag_days, min_days=min_wind_days),
        "H4": melt_anomalies(
            station_years.snow_and_rain(years), min_days=min_days, min_years=min_years
        ),
    }
    return regional_of(tables, years, stations, min_rows, heat_percentile, lag_days)


def regional_of(
    tables: Mapping[str, DataFrame],
    rows: DataFrame,
    stations: DataFrame,
    min_rows: int = 10_000,
    heat_percentile: float = 0.95,
    lag_days: int = 7,
) -> DataFrame:
    """One row per analysis and eligible region, from the detail tables of the whole network.

    Baselines, thresholds and frames are all per station and a station has one region, so only
    the last aggregation is grouped. Regions are attached to station-years and days, never to
    readings. A region without results for an analysis has NULL metrics and says so in `status`.
    `tables` has winter details, heat details, wind days and melt years as H1 to H4."""
    region = ["REGION"]

    def placed(detail: DataFrame) -> DataFrame:
        return attach_region(detail, stations)

    summaries = {
        H1: winter_summary(placed(tables["H1"]), region),
        H2: heat_summary(placed(tables["H2"]), region, heat_percentile),
        H3: wind_summary(placed(tables["H3"]), region, lag_days),
        H4: snowmelt_summary(placed(tables["H4"]), region),
    }
    found = None
    for hypothesis, summary in summaries.items():
        part = _regional(summary, hypothesis)
        found = part if found is None else found.unionByName(part)

    missing = F.create_map(
        *[
            F.lit(x)
            for pair in ((H1, "ok"), (H2, "ok"), (H3, "No overlapping data"), (H4, "No snow data"))
            for x in pair
        ]
    )
    expected = eligible_regions(rows, stations, min_rows).withColumn(
        "hypothesis", F.explode(F.array(*[F.lit(h) for h in HYPOTHESES]))
    )
    joined = expected.join(found, ["hypothesis", "REGION"], "left").withColumn(
        "status", F.coalesce("status", missing[F.col("hypothesis")])
    )
    ok = F.col("status") == "ok"
    metrics = {name: F.when(ok, F.col(name)) for name in REGIONAL_METRICS}
    metrics["sample_size"] = F.when(
        ok & (F.col("hypothesis") != H3), F.coalesce("sample_size", F.lit(0))
    )
    return joined.withColumns(metrics).select(
        "hypothesis", F.col("REGION").alias("region"), *REGIONAL_METRICS, "status"
    )


def regional_results_table(regional: DataFrame) -> DataFrame:
    """Export form: correlation, size, effect and a rough significance flag per region."""
    effect = F.coalesce("moderation_rate", "compensation_rate")
    size = F.coalesce("sample_size", "num_events")
    return regional.filter(F.col("status") == "ok").select(
        "hypothesis",
        "region",
        "correlation",
        size.alias("sample_size"),
        effect.alias("effect_size"),
        (
            F.coalesce(F.abs("correlation") > 0.1, F.lit(False))
            | F.coalesce(effect > 55, F.lit(False))
        ).alias("significant"),
    )


def direction_consistency(regional: DataFrame) -> DataFrame:
    """Whether most regions of an analysis point the same way.

    The direction is the sign of the correlation, or of the mean change where there is none. With
    fewer than two regions there is no verdict."""
    sign = F.signum(F.coalesce("correlation", "avg_range_change"))
    agreeing = F.greatest("positive", "negative")
    return (
        regional.groupBy("hypothesis")
        .agg(
            F.count(sign).alias("regions"),
            F.count_if(sign > 0).alias("positive"),
            F.count_if(sign < 0).alias("negative"),
        )
        .withColumn("majority_share", F.try_divide(agreeing, F.col("regions")))
        .withColumn(
            "consistent", F.when(F.col("regions") >= 2, F.col("majority_share") > 0.5)
        )
    )
