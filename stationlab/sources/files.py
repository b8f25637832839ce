"""Readers. Every schema is given, so no reader scans its input twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlab.functions.dates import day_of, derive_date_parts, month_of
from stationlab.operators.prep import parse_stations_fixed_width, station_line_fault
from stationlab.operators.sampling import sample_observations
from stationlab.schemas import OBSERVATION, RAW_DAILY, STATION, STORED_OBSERVATION
from stationlab.session import setting


def read_observations(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Long observations with year, month and day.

    `path` may be CSV with a header, or the Parquet written by `write_clean_long`. There the
    year is the partition column, so that a filter on it opens the files of those years only,
    and filters on element and station skip row groups."""
    if format == "parquet":
        stored = spark.read.schema(STORED_OBSERVATION).parquet(path)
        return stored.withColumns({"month": month_of("DATE"), "day": day_of("DATE")})
    return derive_date_parts(spark.read.schema(OBSERVATION).csv(path, header=True))


def read_year_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Observations of some years from the partitioned Parquet; other years are not opened."""
    return read_observations(spark, path, "parquet").filter(F.col("year").between(first, last))


def read_observations_sampled(
    spark: SparkSession, path: str, fraction: float = 1.0, seed: int = 42, unit: str = "station"
) -> DataFrame:
    """Observations of a share of the stations (or of the rows, with unit="row")."""
    return sample_observations(read_observations(spark, path), fraction, seed, unit)


def read_raw_yearly(spark: SparkSession, path: str) -> DataFrame:
    """Headerless yearly files, plain or gzipped, with their eight positional columns."""
    return spark.read.schema(RAW_DAILY).csv(path, header=False)


REQUIRED = ("STATION", "DATE", "ELEMENT", "VALUE")


def read_raw_checked(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Every line of the yearly files as a row, with `source_file`, `fault` and `line`.

    A line is malformed if it has too few or too many fields, or one that is no number where a number
    belongs; its fault names what is missing if a required field is empty. Good lines have neither
    fault nor line; see `kept_rows` and `rejected_rows`."""
    bad = "_corrupt_record"
    schema = T.StructType([*RAW_DAILY.fields, T.StructField(bad, T.StringType())])
    # Without pruning, so that fields are counted whatever columns are used later.
    rows = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", bad)
        .option("columnPruning", "false")
        .csv(path, header=header)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )
    fault = F.when(F.col(bad).isNotNull(), F.lit("malformed line"))
    for name in REQUIRED:
        fault = fault.when(F.col(name).isNull(), F.lit(f"missing {name}"))
    line = F.coalesce(bad, F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_DAILY.names]))
    return rows.withColumn("fault", fault).select(
        *RAW_DAILY.names, "source_file", "fault", F.when(F.col("fault").isNotNull(), line).alias("line")
    )


def read_stations_checked(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the fixed-width station text, as `value` with `source_file` and `fault`."""
    lines = spark.read.text(path).withColumn("source_file", F.col("_metadata.file_name"))
    return lines.withColumn("fault", station_line_fault())


def kept_rows(checked: DataFrame) -> DataFrame:
    """Rows without a fault, as the reader without checks gives them."""
    return checked.filter("fault IS NULL").drop("fault", "line", "source_file")


def rejected_rows(checked: DataFrame) -> DataFrame:
    """(source_file, fault, line): the reject table."""
    line = "line" if "line" in checked.columns else "value"
    return checked.filter("fault IS NOT NULL").select("source_file", "fault", F.col(line).alias("line"))


def store_checked(checked: DataFrame, path: str) -> None:
    """Kept and rejected rows as the partitions `rejected=false` and `rejected=true` of one table,
    from one read of the files.

    Each task keeps a writer open for either partition. Spark's default sorts a task's rows by partition
    first, which holds all of them."""
    with setting(checked.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        checked.withColumn("rejected", F.col("fault").isNotNull()).write.partitionBy("rejected").parquet(path)


def read_filtered_years(spark: SparkSession, path: str) -> DataFrame:
    """All yearly files with a header matched by a path or glob, with their file name."""
    return (
        spark.read.schema(RAW_DAILY)
        .csv(path, header=True)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )


def read_stations_fixed_width(spark: SparkSession, path: str) -> DataFrame:
    """Station table of known regions from the fixed-width text file."""
    return parse_stations_fixed_width(spark.read.text(path))


def read_station_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct station ids from a file with one id per line."""
    return (
        spark.read.text(path)
        .select(F.trim("value").alias("STATION"))
        .filter("STATION <> ''")
        .distinct()
    )


def read_station_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Station table from CSV with a header."""
    return spark.read.schema(STATION).csv(path, header=True)
