"""Whole runs: from raw files to clean observations, and from those to stored results."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from stationlab.operators import prep, quality, sampling
from stationlab.operators.joins import station_semi_join
from stationlab.plans import heat, regional, report, snowmelt, station_years, wind, winter
from stationlab.session import scratch_path
from stationlab.sinks import files as sink_files
from stationlab.sinks.results import export_all_results, yearly_trend_rows
from stationlab.sources import files as source_files


@dataclass(frozen=True)
class Gates:
    """Thresholds of the analyses."""

    season_days: int = 50
    spring_days: int = 75
    snow_days: int = 10
    wind_days: int = 100
    years: int = 5
    region_rows: int = 10_000
    heat_percentile: float = 0.95
    wind_percentile: float = 0.90
    lag_days: int = 7


@dataclass
class Analyses:
    """Lazy results. All of them follow from few tables: `years` (station-years), `summers`, and
    `wind` (days); `store` keeps these once and takes the results from what it kept."""

    tables: dict[str, DataFrame]
    gates: Gates = Gates()
    stations: DataFrame | None = None
    reports: dict[str, DataFrame] = field(default_factory=dict)

    def details(self) -> dict[str, DataFrame]:
        """Winter details, heat details, wind days and melt years as H1 to H4."""
        g, years = self.gates, self.tables["years"]
        heat_metrics = self.tables["summers"].drop("sum_value", "n_known", "max_value")
        return {
            "H1": winter.winter_anomalies(station_years.winters(years, g.season_days), g.years),
            "H2": heat.heat_of(station_years.springs(years, g.spring_days), heat_metrics, g.years),
            "H3": self.tables["wind"],
            "H4": snowmelt.melt_anomalies(
                station_years.snow_and_rain(years), g.snow_days, g.season_days, g.years
            ),
        }

    @property
    def results(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """(detail, summary) per analysis."""
        g, d = self.gates, self.details()
        return {
            "H1": (d["H1"], winter.winter_summary(d["H1"])),
            "H2": (d["H2"], heat.heat_summary(d["H2"], percentile=g.heat_percentile)),
            "H3": (wind.high_wind_events(d["H3"]), wind.wind_summary(d["H3"], n=g.lag_days)),
            "H4": (snowmelt.melt_precip_join(d["H4"]), snowmelt.snowmelt_summary(d["H4"])),
        }

    @property
    def regional(self) -> DataFrame | None:
        """The regional table, if there are stations."""
        if self.stations is None:
            return None
        g = self.gates
        return regional.regional_of(
            self.details(), self.tables["years"], self.stations, g.region_rows,
            g.heat_percentile, g.lag_days,
        )

    def trends(self) -> DataFrame:
        """Rows of yearly_trends: heat waves and snowmelt per year."""
        hot = heat.trends_of(self.tables["summers"])
        melts = station_years.snow_and_rain(self.tables["years"]).filter("snow_days > 0")
        melt = snowmelt.trends_of(melts)
        columns = {"avg_value": "avg_summer_temp", "max_value": "max_summer_temp"}
        rows = yearly_trend_rows(hot, "summer_temperature", columns)
        rows = rows.unionByName(
            yearly_trend_rows(hot, "heat_wave_days", {"avg_value": "total_hw_days"}), True
        )
        columns = {
            "avg_value": "avg_melt_doy", "std_value": "std_melt_doy",
            "min_value": "earliest_melt", "max_value": "latest_melt", "num_stations": "num_stations",
        }
        return rows.unionByName(yearly_trend_rows(melt, "snowmelt_doy", columns), True)

    def summaries(self) -> dict[str, DataFrame]:
        return {name: summary for name, (_, summary) in self.results.items()}

    def verdicts(self) -> DataFrame:
        return report.support_verdict(self.summaries())

    def document(self) -> DataFrame:
        return report.results_document(self.summaries())


def prepare(
    spark: SparkSession,
    station_text: str,
    raw_files: str,
    target: str,
    quotas: dict[str, int],
    counts: quality.RowCounts | None = None,
) -> DataFrame:
    """Selects stations, keeps their clean readings and stores them. Returns the stations.

    Writes `stations`, `station_ids` and `observations` below `target`. `counts` takes the quality
    counts of the kept readings while they are written."""
    known = source_files.read_stations_fixed_width(spark, station_text)
    stations = sampling.even_spaced_sample(known, quotas)
    table, ids = f"{target}/stations", f"{target}/station_ids"
    sink_files.write_station_list(stations, table, ids)
    raw = source_files.read_raw_yearly(spark, raw_files)
    known_ids = source_files.read_station_ids(spark, ids)
    kept = station_semi_join(prep.clean_observations(raw), known_ids)
    kept = kept if counts is None else counts.watch(kept)
    sink_files.write_clean_long(kept, f"{target}/observations")
    return source_files.read_station_metadata(spark, table)


def analyze(
    obs: DataFrame,
    stations: DataFrame | None = None,
    gates: Gates = Gates(),
    quality_checks: bool = True,
) -> Analyses:
    """The four analyses, the regional comparison if stations are given, and the reports."""
    g = gates
    flags = heat.summer_flags(obs, g.heat_percentile)
    found = Analyses(
        {
            "years": station_years.station_years(obs),
            "summers": heat.summer_years(flags),
            "wind": wind.wind_days(obs, g.lag_days, g.wind_percentile, g.wind_days),
        },
        gates,
        stations,
    )
    if quality_checks:
        found.reports = {
            "coverage_overall": quality.coverage_overall(obs),
            "coverage_by_element": quality.coverage_by_element(obs),
            "coverage_key_elements": quality.coverage_key_elements(obs),
            "quality_issues": quality.validate_quality(obs),
        }
    return found


def store(
    spark: SparkSession,
    found: Analyses,
    folder: str,
    stations: DataFrame | None = None,
    previous: str | None = None,
) -> list[str]:
    """Writes all results and the JSON document into the run folder `folder`, merged with those of
    the run folder `previous`.

    The tables that everything follows from are computed once, each from one read of the
    observations, into the shared folder; summaries, regions, trends and document come from there."""
    kept = {}
    for name, table in found.tables.items():
        path = scratch_path(spark, f"run-{name}")
        table.write.parquet(path)
        kept[name] = spark.read.schema(table.schema).parquet(path)
    found = replace(found, tables=kept)
    table = None if found.regional is None else regional.regional_results_table(found.regional)
    written = export_all_results(
        spark, folder, found.results, table, stations, found.trends(), previous
    )
    sink_files.write_results_document(found.document(), f"{folder}/document")
    return written
