"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the local cores. With BENCH_STATIONS=635 the
four analyses are timed on generated observations of the published size instead (635
stations x 25 years x 365 days x 6 elements = 34.8 million rows), read from CSV."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.queries import QUERIES  # noqa: E402
from stationlab.plans import heat, snowmelt, wind, winter  # noqa: E402
from stationlab.session import scratch_path  # noqa: E402
from stationlab.sinks.files import write_clean_csv  # noqa: E402
from stationlab.sources.files import read_observations  # noqa: E402
from stationlab.sources.generator import generate_observations  # noqa: E402

HEADLINE = [
    "winter_precip_lag_summary",
    "spring_summer_heat_summary",
    "wind_moderation",
    "snowmelt_precip_summary",
    "winter_precip_by_region",
    "wind_by_season",
    "snowmelt_by_elevation",
    "regional_consistency",
    "clean_observations",
    "validate_quality",
    "dataset_profile",
    "percentile_threshold",
    "even_spaced_sample",
    "keyed_upsert",
]
RUNS = 2


def seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def given_tables(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            seconds(QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    return times


def published_size(spark: SparkSession, stations: int) -> dict[str, float]:
    path = scratch_path(spark, "bench")
    write_clean_csv(generate_observations(spark, stations, 25, 2000), path)
    obs = read_observations(spark, path)
    return {
        "h1": round(seconds(winter.winter_precip_lag(obs)[1]), 3),
        "h2": round(seconds(heat.spring_summer_heat(obs)[1]), 3),
        "h3": round(seconds(wind.wind_moderation(obs)[1]), 3),
        "h4": round(seconds(snowmelt.snowmelt_precip(obs)[1]), 3),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    stations = int(os.environ.get("BENCH_STATIONS", "0"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if stations:
        times, size = published_size(spark, stations), f"{stations} generated stations"
    else:
        times, size = given_tables(spark, sf_dir), Path(sf_dir).name
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": size,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
