"""Preparation of raw observations and station metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.functions.scalars import physical_value
from stationlab.operators.joins import map_state_to_region, station_key
from stationlab.schemas import ELEMENTS, STATION_TEXT_FIELDS


def clean_observations(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Unflagged readings of the kept elements, in physical units, as four columns and those of
    `keep`."""
    return raw.filter(F.col("QFLAG").isNull() & F.col("ELEMENT").isin(*ELEMENTS)).select(
        "STATION",
        "DATE",
        "ELEMENT",
        physical_value(F.col("ELEMENT"), F.col("VALUE")).alias("VALUE"),
        *keep,
    )


def us_known_region_filter(stations: DataFrame) -> DataFrame:
    """Stations whose id starts with US and whose state belongs to a region."""
    return map_state_to_region(
        stations.filter(F.col(station_key(stations)).startswith("US")), selection=True
    ).filter(F.col("REGION").isNotNull())


STATION_NUMBERS = ("LATITUDE", "LONGITUDE", "ELEVATION")


def station_text_fields() -> dict[str, Column]:
    return {
        name: F.trim(F.substring("value", start, length))
        for name, (start, length) in STATION_TEXT_FIELDS.items()
    }


def station_line_fault() -> Column:
    """Why a fixed-width line is no station, NULL where it is one. Blank elevations are allowed."""
    fields = station_text_fields()
    wrong = lambda name: fields[name].try_cast("double").isNull()
    return (
        F.when(F.length("value") < 70, "short line")
        .when(fields["STATION_ID"] == "", "missing STATION_ID")
        .when(wrong("LATITUDE"), "malformed LATITUDE")
        .when(wrong("LONGITUDE"), "malformed LONGITUDE")
        .when((fields["ELEVATION"] != "") & wrong("ELEVATION"), "malformed ELEVATION")
    )


def parse_stations_fixed_width(lines: DataFrame) -> DataFrame:
    """Station table from fixed-width text lines (one column named `value`).

    Short lines and lines of other networks are skipped, a blank elevation counts as 0, and
    stations of no known region are dropped."""
    fields = station_text_fields()
    numbers = {name: fields[name].try_cast("double") for name in STATION_NUMBERS}
    numbers["ELEVATION"] = F.coalesce(numbers["ELEVATION"], F.lit(0.0))
    parsed = lines.filter(F.length("value") >= 70).select(
        *[numbers.get(name, column).alias(name) for name, column in fields.items()]
    )
    return us_known_region_filter(parsed)


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Yearly frames as one; a column missing in one of them is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def station_listing(stations: DataFrame, limit: int | None = None) -> DataFrame:
    """All stations, or the first `limit` of them by id."""
    if limit is None:
        return stations
    return stations.orderBy(station_key(stations)).limit(limit)
