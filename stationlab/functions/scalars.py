"""Small column functions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.schemas import ELEVATION_BANDS, TENTHS_ELEMENTS


def elevation_band(elevation: Column) -> Column:
    """Label of the elevation band; NULL stays NULL."""
    label = F.when(elevation.isNull(), None)
    for name, upper in ELEVATION_BANDS:
        label = label.otherwise(name) if upper is None else label.when(elevation < upper, name)
    return label


def elevation_bands(df: DataFrame, elevation: str = "ELEVATION") -> DataFrame:
    """Rows with a known elevation, with their `elev_band`."""
    return df.filter(F.col(elevation).isNotNull()).withColumn(
        "elev_band", elevation_band(F.col(elevation))
    )


def physical_value(element: Column, value: Column) -> Column:
    """Raw integer reading in physical units: some elements are stored in tenths."""
    as_double = value.cast("double")
    return F.when(element.isin(*TENTHS_ELEMENTS), as_double / 10.0).otherwise(as_double)


def diurnal_range(wide: DataFrame) -> DataFrame:
    """Adds temp_range = TMAX - TMIN and keeps the days on which it is positive."""
    return wide.withColumn("temp_range", F.col("TMAX") - F.col("TMIN")).filter("temp_range > 0")


def fill_missing_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULL becomes 0 in the named columns only."""
    return df.fillna(0, subset=list(columns))


def region_fallback(df: DataFrame, region: str = "Unknown") -> DataFrame:
    """A constant REGION, for data that come without station metadata."""
    return df.withColumn("REGION", F.lit(region))
