"""Verdicts and summary tables over the analyses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Deciding metric of each analysis and the limit beyond which the hypothesis is supported.
VERDICT_RULES = {
    "H1": ("correlation", "below", -0.1),
    "H2": ("correlation_days", "above", 0.1),
    "H3": ("moderation_rate", "above", 55.0),
    "H4": ("correlation", "above", 0.1),
}

# Headline metrics, by analysis. Metrics of other analyses are NULL in a row.
HEADLINES = {
    "H1": ["correlation", "sample_size", "compensation_rate"],
    "H2": [
        "correlation_days",
        "correlation_intensity",
        "avg_hw_warm_spring",
        "avg_hw_cool_spring",
    ],
    "H3": [
        "num_events",
        "avg_range_before",
        "avg_range_after",
        "avg_range_change",
        "moderation_rate",
    ],
    "H4": ["correlation", "sample_size", "early_melt_prcp_anomaly", "late_melt_prcp_anomaly"],
}

# Names of the analyses in the JSON document.
DOCUMENT_NAMES = {
    "H1": "hypothesis_1_winter_precipitation",
    "H2": "hypothesis_2_spring_summer_heat",
    "H3": "hypothesis_3_wind_moderation",
    "H4": "hypothesis_4_snowmelt_precipitation",
}


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def support_verdict(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """SUPPORTED or NOT SUPPORTED per analysis, from its one-row summary."""
    rows = []
    for name, summary in summaries.items():
        metric, side, limit = VERDICT_RULES[name]
        value = F.col(metric).cast("double")
        supported = value < limit if side == "below" else value > limit
        rows.append(
            summary.select(
                F.lit(name).alias("hypothesis"),
                F.lit(metric).alias("metric_name"),
                value.alias("metric_value"),
                F.when(supported, "SUPPORTED").otherwise("NOT SUPPORTED").alias("verdict"),
            )
        )
    return _stacked(rows)


def summary_report(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """One row per analysis with its headline metrics as doubles."""
    metrics = list(dict.fromkeys(m for names in HEADLINES.values() for m in names))
    rows = [
        summary.select(
            F.lit(name).alias("hypothesis"),
            *[
                (F.col(m) if m in HEADLINES[name] else F.lit(None)).cast("double").alias(m)
                for m in metrics
            ],
        )
        for name, summary in summaries.items()
    ]
    return _stacked(rows)


def summary_metrics_long(summary: DataFrame, hypothesis: str) -> DataFrame:
    """A one-row summary as (hypothesis, metric_name, metric_value, sample_size) rows.

    Only known numbers become metrics; the sample size is carried along with each of them."""
    numeric = [
        f.name
        for f in summary.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name != "sample_size"
    ]
    size = F.col("sample_size") if "sample_size" in summary.columns else F.lit(None)
    return (
        summary.select(
            size.cast("long").alias("sample_size"), *[F.col(c).cast("double") for c in numeric]
        )
        .unpivot(["sample_size"], numeric, "metric_name", "metric_value")
        .filter(F.col("metric_value").isNotNull())
        .select(F.lit(hypothesis).alias("hypothesis"), "metric_name", "metric_value", "sample_size")
    )


def results_document(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """All one-row summaries as a single JSON document (column `document`)."""
    parts = [
        summary.select(
            F.lit(DOCUMENT_NAMES.get(name, name)).alias("name"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("body"),
        )
        for name, summary in summaries.items()
    ]
    entry = F.concat(F.lit('"'), F.col("name"), F.lit('":'), F.col("body"))
    return _stacked(parts).agg(
        F.concat(
            F.lit("{"), F.array_join(F.sort_array(F.collect_list(entry)), ","), F.lit("}")
        ).alias("document")
    )


def run_documents(documents: Mapping[str, DataFrame]) -> DataFrame:
    """(run, document): the one-row JSON documents of several runs as VARIANT values in one table."""
    parts = [
        document.select(F.lit(run).alias("run"), F.parse_json("document").alias("document"))
        for run, document in documents.items()
    ]
    return _stacked(parts)


def document_metric(document: str, hypothesis: str, metric: str) -> Column:
    """A number of a document by its path, NULL where the run has none."""
    path = f"$.{DOCUMENT_NAMES.get(hypothesis, hypothesis)}.{metric}"
    return F.try_variant_get(document, path, "double")


def document_metrics(documents: DataFrame, metrics: Mapping[str, Sequence[str]]) -> DataFrame:
    """(run, hypothesis, metric_name, metric_value) of the named metrics, each read by its path."""
    entries = [
        F.struct(
            F.lit(hypothesis).alias("hypothesis"),
            F.lit(metric).alias("metric_name"),
            document_metric("document", hypothesis, metric).alias("metric_value"),
        )
        for hypothesis, names in metrics.items()
        for metric in names
    ]
    return documents.select("run", F.inline(F.array(*entries))).filter("metric_value IS NOT NULL")
