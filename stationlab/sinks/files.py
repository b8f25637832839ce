"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.functions.dates import day_of, month_of, year_of
from stationlab.operators.joins import station_key

def write_clean_long(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Clean observations as Parquet, partitioned by year.

    Rows are rebalanced by year and element: Spark splits what is too large for a task, so a
    large year becomes many files. Files are sorted so that filters on element and station
    skip row groups."""
    (
        df.select("STATION", "DATE", "ELEMENT", "VALUE", year_of("DATE").alias("year"))
        .hint("rebalance", "year", "ELEMENT")
        .sortWithinPartitions("year", "ELEMENT", "STATION", "DATE")
        .write.mode(mode)
        .partitionBy("year")
        .parquet(path)
    )


def write_clustered(df: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Observations as an external table of `buckets` sorted buckets by station.

    Aggregations and windows per station over it need no shuffle. A bucket holds whole stations, so
    choose so many that one fits a task with room to spare, and keep `write_clean_long` where a few
    stations hold most rows."""
    rows = df.select("STATION", "DATE", "ELEMENT", "VALUE")
    parts = {"year": year_of("DATE"), "month": month_of("DATE"), "day": day_of("DATE")}
    (
        rows.withColumns(parts)
        .repartition(buckets, "STATION")
        .write.mode("overwrite")
        .bucketBy(buckets, "STATION")
        .sortBy("STATION", "ELEMENT", "DATE")
        .option("path", path)
        .saveAsTable(table)
    )


def write_clean_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The four columns of the long table as CSV with a header, in as many files as tasks."""
    df.select("STATION", "DATE", "ELEMENT", "VALUE").write.mode(mode).csv(path, header=True)


def write_station_list(stations: DataFrame, table_path: str, ids_path: str) -> None:
    """The station table as CSV and its ids as text, one per line."""
    stations.write.mode("overwrite").csv(table_path, header=True)
    stations.select(F.col(station_key(stations)).cast("string")).write.mode("overwrite").text(
        ids_path
    )


def export_flat(
    df: DataFrame, path: str, format: str = "csv", single_file: bool = False
) -> None:
    """CSV (with header) or JSON for charts.

    Written as the parallel part files of its tasks; `single_file` gathers them in one task, for
    results that a chart can hold."""
    if format not in ("csv", "json"):
        raise ValueError(f"Unsupported format: {format}")
    if single_file:
        df = df.repartition(1)
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.json(path)


def write_results_document(document: DataFrame, path: str) -> None:
    """The one-row JSON document as text."""
    document.coalesce(1).write.mode("overwrite").text(path)
