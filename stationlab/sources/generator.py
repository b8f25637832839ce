"""Synthetic observations of any size, for tests and trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlab.functions.dates import derive_date_parts
from stationlab.schemas import ELEMENTS


def _uniform(*key: Column) -> Column:
    """Uniform number in (0, 1) that depends on the key alone."""
    return (F.pmod(F.xxhash64(*key), F.lit(2**40)) + F.lit(0.5)) / F.lit(float(2**40))


def generate_observations(
    spark: SparkSession, n_stations: int = 10, n_years: int = 3, first_year: int = 2020, seed: int = 7
) -> DataFrame:
    """Station x year x day x element readings with seasonal shapes.

    Values come from hashes of station, day and element, so the table is the same on every
    run and however it is partitioned."""
    cells = spark.range(n_stations * n_years * 365).select(
        F.expr(f"cast(id div {n_years * 365} as int)").alias("station"),
        F.expr(f"cast((id div 365) % {n_years} as int) + {first_year}").alias("y"),
        F.expr("cast(id % 365 as int) + 1").alias("doy"),
    )
    rows = cells.withColumn("ELEMENT", F.explode(F.array(*[F.lit(e) for e in ELEMENTS])))
    key = [F.col("station"), F.col("y"), F.col("doy"), F.col("ELEMENT"), F.lit(seed)]
    u1, u2 = _uniform(*key, F.lit(1)), _uniform(*key, F.lit(2))
    gauss = F.sqrt(-2.0 * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)
    season = 15.0 * (1.0 - F.abs(F.col("doy") - 182) / 182.0)
    doy, element = F.col("doy"), F.col("ELEMENT")
    zero = F.lit(0.0)
    value = (
        F.when(element == "TMAX", 10.0 + season + 5.0 * gauss)
        .when(element == "TMIN", season + 5.0 * gauss)
        .when(element == "PRCP", -3.0 * F.log(u1))
        .when(
            element == "SNOW",
            F.when((doy < 90) | (doy > 320), F.greatest(zero, 20.0 + 15.0 * gauss)).otherwise(zero),
        )
        .when(
            element == "SNWD",
            F.when((doy < 100) | (doy > 310), F.greatest(zero, 50.0 + 30.0 * gauss)).otherwise(zero),
        )
        .otherwise(F.greatest(zero, 3.5 + 1.5 * gauss))
    )
    day = F.date_add(F.make_date("y", F.lit(1), F.lit(1)), F.col("doy") - 1)
    return derive_date_parts(
        rows.select(
            F.concat(F.lit("USC"), F.lpad(F.col("station").cast("string"), 8, "0")).alias("STATION"),
            F.date_format(day, "yyyyMMdd").cast("int").alias("DATE"),
            "ELEMENT",
            F.round(value, 1).alias("VALUE"),
        )
    )
