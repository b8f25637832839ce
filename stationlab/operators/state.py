"""Station state that merges: what reports need of past readings, without the readings.

A state is three tables, each a sum over disjoint sets of readings, so that of two states of different
readings the merged one is that of all of them:

- `cube`: rows, first and last date per station, element and year;
- `values`: how often each reading occurs per station and element;
- `dates`: rows and a bit mask of the dates seen per station, element and 64-date block.

A new year is added by reading that year alone. `values` grows with the steps of an instrument and
`dates` with the days of a station, neither with repeated readings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlab.operators import quality
from stationlab.operators.thresholds import percentile_by_group

KEYS = {
    "cube": ["STATION", "ELEMENT", "year"],
    "values": ["STATION", "ELEMENT", "VALUE"],
    "dates": ["STATION", "ELEMENT", "block"],
}


@dataclass
class StationState:
    cube: DataFrame
    values: DataFrame
    dates: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"cube": self.cube, "values": self.values, "dates": self.dates}

    def profile(self) -> DataFrame:
        """As `quality.dataset_profile` of all readings."""
        return quality.profile_of(self.cube)

    def percentiles(self, by: Sequence[str], p: float) -> DataFrame:
        """As `percentile_by_group` of all readings, by STATION, ELEMENT or both."""
        return percentile_by_group(self.values, by, "VALUE", p, weight=F.col("n"))

    def duplicate_keys(self) -> DataFrame:
        """Rows beyond the first of each (STATION, DATE, ELEMENT), as one row."""
        return quality.duplicates_of(self.dates)


def state_of(obs: DataFrame) -> StationState:
    """The state of some readings (STATION, DATE, ELEMENT, VALUE, year)."""
    rows = F.count(F.lit(1)).alias("n")
    return StationState(
        quality.profile_cube(obs),
        obs.groupBy(*KEYS["values"]).agg(rows),
        quality.date_blocks(obs),
    )


def merged(*states: StationState) -> StationState:
    """The state of all readings of states that share none."""
    aggregates = {
        "cube": [F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")],
        "values": [F.sum("n").alias("n")],
        "dates": [F.sum("n").alias("n"), F.bit_or("mask").alias("mask")],
    }
    tables = {}
    for name, keys in KEYS.items():
        parts = [state.tables()[name] for state in states]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        tables[name] = rows.groupBy(*keys).agg(*aggregates[name])
    return StationState(**tables)


def write_state(state: StationState, path: str) -> None:
    """Each table below `path`, which must be new: a state that is read is never written over."""
    for name, table in state.tables().items():
        table.write.mode("error").parquet(f"{path}/{name}")


def read_state(spark: SparkSession, path: str) -> StationState:
    return StationState(**{name: spark.read.parquet(f"{path}/{name}") for name in KEYS})


def moments_of(detail: DataFrame, value: str, by: Sequence[str] = ("STATION",)) -> DataFrame:
    """Count, mean and sum of squared deviations of yearly values per station; mergeable."""
    known = F.count(value)
    return detail.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        known.alias("known"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * known).alias("m2"),
    )


def merged_moments(parts: Sequence[DataFrame], by: Sequence[str] = ("STATION",)) -> DataFrame:
    """The moments of all values, from those of disjoint sets of them: squared deviations add up,
    with those of the parts' means about the common mean."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    total = F.sum(F.col("mean") * F.col("known"))
    squares = F.sum(F.col("mean") * F.col("mean") * F.col("known"))
    grouped = rows.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("known").alias("known"),
        F.try_divide(total, F.sum("known")).alias("mean"),
        (F.sum("m2") + squares - F.try_divide(total * total, F.sum("known"))).alias("m2"),
    )
    return grouped


def baseline_of(moments: DataFrame, min_n: int = 5, need_spread: bool = False) -> DataFrame:
    """As `seasons.station_baseline` of all values."""
    std = F.when(F.col("known") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("known") - 1)))
    by = [c for c in moments.columns if c not in ("n", "known", "mean", "m2")]
    found = moments.filter(F.col("n") >= min_n).select(
        *by, F.col("mean").alias("baseline"), std.alias("std"), "n"
    )
    return found.filter("std > 0") if need_spread else found
