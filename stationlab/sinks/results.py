"""Result tables that are updated by key, one folder per run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlab.operators.joins import station_key
from stationlab.operators.upsert import keyed_merge
from stationlab.plans.report import summary_metrics_long
from stationlab.schemas import RESULT_TABLES
from stationlab.session import path_exists

INT_COLUMNS = ("year", "event_date", "snowmelt_doy")
COUNT_COLUMNS = ("heat_wave_days", "extreme_days", "sample_size", "num_stations")
TEXT_COLUMNS = ("station_id", "hypothesis", "metric_name", "description", "region", "state", "name")

# Columns that change their name on export.
RENAMES = {
    "STATION": "station_id",
    "STATION_ID": "station_id",
    "DATE": "event_date",
    "AWND": "awnd",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "ELEVATION": "elevation",
    "STATE": "state",
    "NAME": "name",
    "REGION": "region",
}

DETAIL_TABLES = {
    "H1": "h1_winter_precipitation",
    "H2": "h2_spring_summer_heat",
    "H3": "h3_wind_moderation",
    "H4": "h4_snowmelt_precipitation",
}


def result_schema(table: str) -> T.StructType:
    spec = RESULT_TABLES[table]
    fields = []
    for name in [*spec["keys"], *spec["update"], *spec["insert_only"]]:
        if name in TEXT_COLUMNS:
            kind: T.DataType = T.StringType()
        elif name in INT_COLUMNS:
            kind = T.IntegerType()
        elif name in COUNT_COLUMNS:
            kind = T.LongType()
        elif name == "significant":
            kind = T.BooleanType()
        else:
            kind = T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def as_result_rows(df: DataFrame, table: str) -> DataFrame:
    """`df` with the names, types and columns of a result table; absent columns are left out."""
    schema = result_schema(table)
    wanted = {f.name: f.dataType for f in schema.fields}
    chosen = {}
    for name in df.columns:
        target = RENAMES.get(name, name) if name not in wanted else name
        if target in wanted:
            chosen[target] = F.col(name).cast(wanted[target]).alias(target)
    return df.select(*[chosen[name] for name in wanted if name in chosen])


def yearly_trend_rows(
    trends: DataFrame, metric_name: str, columns: Mapping[str, str]
) -> DataFrame:
    """Rows of yearly_trends from a per-year table. `columns` maps target to source names."""
    return trends.select(
        "year",
        F.lit(metric_name).alias("metric_name"),
        *[F.col(source).alias(target) for target, source in columns.items()],
    )


def station_rows(stations: DataFrame) -> DataFrame:
    return stations.withColumnRenamed(station_key(stations), "station_id")


def merged_result(
    spark: SparkSession,
    table: str,
    updates: DataFrame,
    current: DataFrame | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """A result table after the updates; without a current version it starts empty."""
    spec = RESULT_TABLES[table]
    if current is None:
        current = spark.createDataFrame([], result_schema(table))
    rows = as_result_rows(updates, table)
    if order_by:
        rows = updates.select(
            *[F.col(c) for c in order_by if c not in rows.columns],
            *[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns],
        )
    return keyed_merge(current, rows, spec["keys"], spec["update"], order_by)


def read_result(spark: SparkSession, folder: str | None, table: str) -> DataFrame | None:
    """A result table of a run folder, None where the run has none."""
    path = f"{folder}/{table}"
    if folder is None or not path_exists(spark, path):
        return None
    return spark.read.schema(result_schema(table)).parquet(path)


def export_all_results(
    spark: SparkSession,
    folder: str,
    results: Mapping[str, tuple[DataFrame | None, DataFrame | None]],
    regional: DataFrame | None = None,
    stations: DataFrame | None = None,
    trends: DataFrame | None = None,
    previous: str | None = None,
) -> list[str]:
    """Writes the result tables of a run into its own folder: those of the run folder `previous` after
    the updates. Tables without updates are carried over. Returns the names of the updated tables.

    A run folder is written once, by Spark's own commit, and never changed: two runs never write to
    the same table, a second run into the same folder is refused, and a lost run leaves `previous`
    as it is. `results` maps H1 to H4 to (detail, summary); `trends` has rows of yearly_trends."""
    updates: dict[str, DataFrame] = {}
    metrics = None
    for name, (detail, summary) in results.items():
        if detail is None:
            continue
        updates[DETAIL_TABLES[name]] = detail
        if summary is not None:
            rows = summary_metrics_long(summary, name)
            metrics = rows if metrics is None else metrics.unionByName(rows)
    others = {
        "analysis_summary": metrics,
        "regional_results": regional,
        "yearly_trends": trends,
        "stations": None if stations is None else station_rows(stations),
    }
    updates |= {table: rows for table, rows in others.items() if rows is not None}
    for table in RESULT_TABLES:
        current = read_result(spark, previous, table)
        if table in updates:
            current = merged_result(spark, table, updates[table], current)
        if current is not None:
            current.write.mode("error").parquet(f"{folder}/{table}")
    return list(updates)
