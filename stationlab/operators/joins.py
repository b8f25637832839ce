"""Joins of observations with station-level tables.

Station tables grow with the network, so none of them is broadcast by hand: Spark broadcasts
a side whose measured size is under its limit and shuffles it otherwise, splitting partitions
that are too large. Filters and column pruning pass through these joins to the scan. A caller who
knows of a hot station can ask for a sure split with `salts`. The only hand-made broadcast is the
state map, which has one row per state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlab.functions.scalars import elevation_bands
from stationlab.schemas import state_regions

def salted_lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salts: int = 1,
    salt_by: Sequence[str] = ("DATE",),
) -> DataFrame:
    """Equi-join of many `rows` with a `table` that has one row per key.

    With salts=1 it is a plain join. With more, each key of the table is repeated per salt and a
    row draws its salt from the `salt_by` columns alone, so the rows of a hot key spread over
    `salts` tasks; filters on other columns still reach the scan, and only these columns are read
    besides. `how` is inner, left or left_semi."""
    if salts == 1:
        return rows.join(table, list(on), how)
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")


def region_map(spark: SparkSession, selection: bool = False) -> DataFrame:
    return spark.createDataFrame(state_regions(selection), "STATE string, REGION string")


def map_state_to_region(stations: DataFrame, selection: bool = False) -> DataFrame:
    """Adds REGION from STATE; an unknown state gives NULL. An incoming REGION is replaced."""
    mapping = region_map(stations.sparkSession, selection)
    columns = [c for c in stations.columns if c != "REGION"]
    return (
        stations.select(*columns)
        .join(F.broadcast(mapping), "STATE", "left")
        .select(*columns, "REGION")
    )


def station_key(stations: DataFrame) -> str:
    """Name of the id column of a station table."""
    for name in ("STATION", "STATION_ID", "station_id"):
        if name in stations.columns:
            return name
    raise ValueError("the station table has no STATION, STATION_ID or station_id column")


def station_regions(stations: DataFrame) -> DataFrame:
    """(STATION, REGION), one row per station."""
    return map_state_to_region(stations).select(
        F.col(station_key(stations)).alias("STATION"), "REGION"
    )


def attach_region(df: DataFrame, stations: DataFrame, salts: int = 1) -> DataFrame:
    """Adds REGION to rows keyed by STATION; every row is kept. `salts` as in `salted_lookup`."""
    return salted_lookup(df.drop("REGION"), station_regions(stations), ["STATION"], salts=salts)


def attach_elevation(df: DataFrame, stations: DataFrame, salts: int = 1) -> DataFrame:
    """Adds ELEVATION and elev_band; rows of stations without an elevation are dropped.

    `salts` as in `salted_lookup`."""
    known = elevation_bands(
        stations.select(F.col(station_key(stations)).alias("STATION"), "ELEVATION")
    )
    rows = df.drop("ELEVATION", "elev_band")
    return salted_lookup(rows, known, ["STATION"], how="inner", salts=salts)


def station_semi_join(df: DataFrame, station_ids: DataFrame, salts: int = 1) -> DataFrame:
    """Rows of the listed stations. The id list has one column; repeated ids do no harm."""
    ids = station_ids.select(F.trim(F.col(station_ids.columns[0])).alias("STATION"))
    return salted_lookup(df, ids, ["STATION"], how="left_semi", salts=salts)


def shifted_year_join(
    first: DataFrame, second: DataFrame, by: Sequence[str] = ("STATION",), shift: int = 1
) -> DataFrame:
    """Joins year N of `first` with year N + shift of `second`; the result has the later year."""
    moved = first.withColumn("year", F.col("year") + F.lit(shift))
    return moved.join(second, [*by, "year"])
