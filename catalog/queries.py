"""The registered queries: each runs one library operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import adapter
from stationlab.functions import dates, scalars, stats
from stationlab.operators import (
    joins,
    prep,
    quality,
    sampling,
    seasons,
    state,
    thresholds,
    upsert,
    windows,
)
from stationlab.plans import heat, regional, report, snowmelt, station_years, wind, winter, workflow
from stationlab.schemas import KEY_ELEMENTS, LATE_SPRING, RESULT_TABLES, SPRING, SUMMER
from stationlab.session import scratch_path
from stationlab.sinks import files as sink_files
from stationlab.sinks import partitions, results
from stationlab.sources import files as source_files
from stationlab.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The given tables are thinner than real station data: lower day gates and heat percentile.
MIN_DAYS = 10
HEAT = 0.70
REGION_ROWS = 1000


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six digits, without negative zero."""
    return df.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def obs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.observations(spark, sf_dir)


def summaries(obs: DataFrame) -> dict[str, tuple[DataFrame, DataFrame]]:
    """(detail, summary) of the four analyses."""
    return {
        "H1": winter.winter_precip_lag(obs, MIN_DAYS),
        "H2": heat.spring_summer_heat(obs, HEAT, MIN_DAYS),
        "H3": wind.wind_moderation(obs),
        "H4": snowmelt.snowmelt_precip(obs, min_days=MIN_DAYS),
    }


# Sources and sinks: the rows are written by Spark to the shared folder and read back.


@query
def read_observations(spark, sf_dir):
    path = scratch_path(spark, "observations")
    sink_files.write_clean_csv(obs_of(spark, sf_dir), path)
    return source_files.read_observations(spark, path)


@query
def read_observations_sampled(spark, sf_dir):
    path = scratch_path(spark, "observations")
    sink_files.write_clean_csv(adapter.raw(spark, sf_dir), path)
    return source_files.read_observations_sampled(spark, path, 0.5)


@query
def read_raw_yearly(spark, sf_dir):
    path = scratch_path(spark, "raw")
    adapter.raw(spark, sf_dir).write.option("compression", "gzip").csv(path)
    return source_files.read_raw_yearly(spark, path)


@query
def read_filtered_years(spark, sf_dir):
    """The year of each row's file, found in its path, beside the year of its date."""
    path = scratch_path(spark, "filtered")
    rows = adapter.raw(spark, sf_dir).withColumn("file_year", dates.year_of("DATE"))
    rows.write.partitionBy("file_year").csv(path, header=True)
    read = source_files.read_filtered_years(spark, f"{path}/file_year=*/*").withColumn(
        "file_year",
        F.regexp_extract(F.col("_metadata.file_path"), r"file_year=(\d+)/", 1).cast("int"),
    )
    return read.groupBy("STATION", dates.year_of("DATE").alias("year"), "file_year").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("QFLAG").alias("flagged"),
        F.sum("VALUE").alias("value_sum"),
        F.sum("DATE").alias("date_sum"),
    )


@query
def raw_line_faults(spark, sf_dir):
    """Yearly files with cut, garbled and incomplete lines: lines and sums by what became of them."""
    path, table = scratch_path(spark, "raw-lines"), scratch_path(spark, "checked")
    adapter.raw_lines(spark, sf_dir).write.text(path)
    source_files.store_checked(source_files.read_raw_checked(spark, path), table)
    return (
        spark.read.parquet(table)
        .groupBy(F.col("rejected").cast("boolean").alias("rejected"), F.coalesce("fault", F.lit("none")).alias("fault"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(F.when(F.col("fault").isNull(), F.col("VALUE"))).cast("long").alias("value_sum"),
            F.sum(F.length("line")).alias("rejected_chars"),
        )
    )


@query
def station_line_faults(spark, sf_dir):
    path = scratch_path(spark, "stations-text")
    adapter.station_lines(spark, sf_dir).write.text(path)
    checked = source_files.read_stations_checked(spark, path)
    return checked.groupBy(F.coalesce("fault", F.lit("none")).alias("fault")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars")
    )


@query
def parse_stations_fixed_width(spark, sf_dir):
    path = scratch_path(spark, "stations-text")
    adapter.station_lines(spark, sf_dir).write.text(path)
    return source_files.read_stations_fixed_width(spark, path)


def _station_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    table, ids = scratch_path(spark, "stations"), scratch_path(spark, "station-ids")
    sink_files.write_station_list(adapter.stations_demo_regions(spark, sf_dir), table, ids)
    return table, ids


@query
def read_station_ids(spark, sf_dir):
    return source_files.read_station_ids(spark, _station_files(spark, sf_dir)[1])


@query
def read_station_metadata(spark, sf_dir):
    return source_files.read_station_metadata(spark, _station_files(spark, sf_dir)[0])


@query
def write_station_list(spark, sf_dir):
    table, ids = _station_files(spark, sf_dir)
    stations = source_files.read_station_metadata(spark, table)
    return stations.join(
        source_files.read_station_ids(spark, ids),
        stations.STATION_ID == F.col("STATION"),
        "full_outer",
    )


@query
def station_listing(spark, sf_dir):
    return prep.station_listing(adapter.stations_demo_regions(spark, sf_dir))


@query
def station_listing_first(spark, sf_dir):
    return prep.station_listing(adapter.stations_demo_regions(spark, sf_dir), 50)


@query
def incremental_year_ingest(spark, sf_dir):
    source = scratch_path(spark, "incoming")
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "progress")
    raw = adapter.raw(spark, sf_dir)
    for part in (F.col("DATE") < 19980101, F.col("DATE") >= 19980101):
        raw.filter(part).write.mode("append").option("compression", "gzip").csv(source)
        ingest.ingest_years(spark, source, target, checkpoint)
    return spark.read.parquet(target).select("STATION", "DATE", "ELEMENT", "VALUE")


@query
def corrected_year_ingest(spark, sf_dir):
    """All years delivered, then 1997 again with other values, then 1998 of an older delivery; and a
    batch that runs twice."""
    source, target = scratch_path(spark, "incoming"), scratch_path(spark, "ingested")
    checkpoint = scratch_path(spark, "progress")
    raw = adapter.raw(spark, sf_dir)
    in_year = lambda year: raw.filter(dates.year_of("DATE") == year)
    corrected = in_year(1997).withColumn("VALUE", F.col("VALUE") + 1)
    late = in_year(1998).withColumn("VALUE", F.col("VALUE") + 2)
    for number, rows in ((2, raw), (3, corrected), (1, late)):
        rows.write.option("compression", "gzip").csv(f"{source}/delivery={number}")
        ingest.ingest_deliveries(spark, source, target, checkpoint, files_per_batch=3)
    again = scratch_path(spark, "batch")
    corrected.write.parquet(again)
    batch = spark.read.schema(corrected.schema).parquet(again).withColumn("delivery", F.lit(4))
    for _ in range(2):
        ingest.batch_writer(target)(batch, 1000)
    ingest.drop_superseded(spark, target)
    return ingest.current_years(spark, target).select("STATION", "DATE", "ELEMENT", "VALUE")


@query
def clustered_observations(spark, sf_dir):
    """Wind moderation over observations stored in buckets by station."""
    path = scratch_path(spark, "clustered")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    sink_files.write_clustered(obs_of(spark, sf_dir), name, path, 16)
    return rounded(wind.wind_moderation(spark.table(name))[1])


@query
def quality_while_writing(spark, sf_dir):
    """Issues and elements of the raw readings, counted while they are written."""
    counts = quality.RowCounts(
        adapter.RAW_ELEMENTS.split(","), max_tmax=45, max_tmin=45, min_tmax=-45, min_tmin=-45
    )
    watched = counts.watch(adapter.raw(spark, sf_dir))
    sink_files.write_clean_long(watched, scratch_path(spark, "counted"))
    elements = counts.coverage(spark).select(F.col("ELEMENT").alias("item"), F.col("records").alias("n"))
    return counts.issues(spark).withColumnRenamed("issue", "item").unionAll(elements)


@query
def write_clean_long(spark, sf_dir):
    path = scratch_path(spark, "clean")
    sink_files.write_clean_long(prep.clean_observations(adapter.raw(spark, sf_dir)), path)
    return source_files.read_observations(spark, path, format="parquet")


@query
def read_year_range(spark, sf_dir):
    path = scratch_path(spark, "clean")
    sink_files.write_clean_long(prep.clean_observations(adapter.raw(spark, sf_dir)), path)
    return source_files.read_year_range(spark, path, 1996, 1998)


@query
def export_flat(spark, sf_dir):
    path = scratch_path(spark, "flat")
    series = seasons.timeseries_rollup(obs_of(spark, sf_dir), ["ELEMENT"], "VALUE")
    sink_files.export_flat(rounded(series), path)
    return spark.read.csv(
        path,
        header=True,
        schema="ELEMENT string, year int, avg_VALUE double, std_VALUE double, "
        "min_VALUE double, max_VALUE double, n bigint",
    )


@query
def summary_metrics_long(spark, sf_dir):
    _, summary = winter.winter_precip_lag(obs_of(spark, sf_dir), MIN_DAYS)
    return rounded(report.summary_metrics_long(summary, "H1"))


@query
def results_document(spark, sf_dir):
    """The document taken apart again into its numbers."""
    document = report.results_document(
        {name: pair[1] for name, pair in summaries(obs_of(spark, sf_dir)).items()}
    )
    parsed = F.from_json("document", "map<string, map<string, string>>")
    return rounded(
        document.select(F.explode(parsed).alias("hypothesis", "metrics"))
        .select("hypothesis", F.explode("metrics").alias("metric_name", "text"))
        .select("hypothesis", "metric_name", F.col("text").try_cast("double").alias("metric_value"))
        .filter("metric_value is not null")
    )


def _paths(spec: dict[str, DataFrame]) -> dict[str, list[str]]:
    """The number columns of each summary."""
    return {
        name: [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
        for name, df in spec.items()
    }


@query
def run_documents(spark, sf_dir):
    """Documents of two runs in one table, their metrics read by path; the second has two analyses."""
    found = _summary_of_each(spark, sf_dir)
    part = {name: found[name] for name in ("H1", "H3")}
    path = scratch_path(spark, "documents")
    report.run_documents(
        {"first": report.results_document(found), "second": report.results_document(part)}
    ).write.parquet(path)
    return rounded(report.document_metrics(spark.read.parquet(path), _paths(found)))


@query
def export_all_results(spark, sf_dir):
    folder = scratch_path(spark, "results")
    results.export_all_results(spark, folder, summaries(obs_of(spark, sf_dir)))
    return rounded(results.read_result(spark, folder, "analysis_summary").drop("description"))


@query
def result_table_merges(spark, sf_dir):
    """A whole run stored twice: rows and sums of the number columns of all eight tables."""
    gates = workflow.Gates(
        season_days=MIN_DAYS, spring_days=MIN_DAYS, region_rows=REGION_ROWS, heat_percentile=HEAT
    )
    stations = adapter.obs_stations(spark, sf_dir)
    run = workflow.analyze(obs_of(spark, sf_dir), stations, gates, quality_checks=False)
    folder, found = None, None
    for _ in range(2):
        previous, folder = folder, scratch_path(spark, "results")
        workflow.store(spark, run, folder, stations, previous)
    for name, spec in RESULT_TABLES.items():
        table = results.read_result(spark, folder, name)
        numbers = [
            c
            for c in (*spec["update"], *spec["insert_only"])
            if table.schema[c].dataType.typeName() in ("double", "long", "integer")
        ]
        sums = {"records": F.count(F.lit(1))} | {c: F.sum(c) for c in numbers}
        sums = [F.struct(F.lit(c).alias("item"), v.cast("double").alias("total")) for c, v in sums.items()]
        part = table.agg(F.array(*sums).alias("sums")).select(
            F.lit(name).alias("table_name"), F.inline("sums")
        )
        found = part if found is None else found.unionAll(part)
    return rounded(found.filter("total IS NOT NULL"), 3)


@query
def keyed_upsert(spark, sf_dir):
    """Winters up to 1998 stored, winters from 1997 arriving twice with other values."""
    winters = winter.winter_detail(obs_of(spark, sf_dir), MIN_DAYS).select(
        "STATION", "year", "early_winter_prcp", "late_winter_prcp", "baseline_early"
    )
    arriving = winters.filter("year >= 1997").withColumn(
        "arrival", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    updates = arriving.select(
        "STATION",
        "year",
        (F.col("early_winter_prcp") + F.col("arrival")).alias("early_winter_prcp"),
        (F.col("late_winter_prcp") + F.col("arrival")).alias("late_winter_prcp"),
        (F.col("baseline_early") + F.col("arrival")).alias("baseline_early"),
        "arrival",
    )
    return rounded(
        upsert.keyed_merge(
            winters.filter("year <= 1998"),
            updates,
            ["STATION", "year"],
            ["early_winter_prcp", "late_winter_prcp"],
            ["arrival"],
        )
    )


@query
def partition_upsert(spark, sf_dir):
    """Winters stored by year, those of 1998 arriving with other values: rows, and whether the files
    of their year were rewritten."""
    names = ["STATION", "year", "early_winter_prcp", "late_winter_prcp"]
    winters = winter.winter_detail(obs_of(spark, sf_dir), MIN_DAYS).select(*names)
    path, keys, changed = scratch_path(spark, "winters"), names[:2], names[2:]
    schema = winters.schema
    partitions.upsert_partitions(spark, path, winters, keys, changed, "year", schema)
    known = scratch_path(spark, "files")
    partitions.partition_files(spark, path, "year").write.parquet(known)
    updates = winters.filter("year = 1998").select(*keys, *[(F.col(c) + 1).alias(c) for c in changed])
    partitions.upsert_partitions(spark, path, updates, keys, changed, "year", schema)
    kept = spark.read.parquet(known).select("year", "file").withColumn("kept", F.lit(True))
    files = partitions.partition_files(spark, path, "year").join(kept, ["year", "file"], "left")
    state = files.groupBy("year").agg((F.count("kept") < F.count(F.lit(1))).alias("rewritten"))
    return rounded(spark.read.schema(schema).parquet(path).join(state, "year").select(*names, "rewritten"))


# Projections, filters and scalars.


@query
def derive_date_parts(spark, sf_dir):
    return dates.derive_date_parts(adapter.daily(spark, sf_dir).select("STATION", "DATE"))


@query
def day_of_year(spark, sf_dir):
    days = adapter.daily(spark, sf_dir)
    return days.select(
        "STATION",
        "DATE",
        dates.day_of_year("DATE").alias("doy"),
        dates.day_of_year(F.col("DATE") + 70).alias("shifted_doy"),
    )


@query
def season_filter(spark, sf_dir):
    return dates.season_filter(obs_of(spark, sf_dir), LATE_SPRING)


@query
def clean_observations(spark, sf_dir):
    return prep.clean_observations(adapter.raw(spark, sf_dir))


@query
def us_known_region_filter(spark, sf_dir):
    return prep.us_known_region_filter(adapter.stations_demo(spark, sf_dir))


@query
def map_state_to_region(spark, sf_dir):
    return joins.map_state_to_region(adapter.stations_demo(spark, sf_dir))


@query
def region_fallback(spark, sf_dir):
    return scalars.region_fallback(adapter.daily(spark, sf_dir).select("STATION", "DATE"))


@query
def elevation_bands(spark, sf_dir):
    return scalars.elevation_bands(adapter.stations_demo(spark, sf_dir)).select(
        "STATION_ID", "ELEVATION", "elev_band"
    )


@query
def diurnal_range(spark, sf_dir):
    return scalars.diurnal_range(adapter.daily(spark, sf_dir)).select(
        "STATION", "DATE", "temp_range"
    )


def _yearly_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seasons.seasonal_totals(obs_of(spark, sf_dir), "PRCP", LATE_SPRING, MIN_DAYS).select(
        "STATION", "year", "total"
    )


@query
def standardized_anomaly(spark, sf_dir):
    return rounded(seasons.standardized_anomaly(_yearly_rain(spark, sf_dir), "total"))


@query
def fill_missing_counts(spark, sf_dir):
    per_supplier = (
        adapter.raw(spark, sf_dir)
        .groupBy("STATION")
        .agg(
            F.sum(F.when(F.col("ELEMENT") == "SNOW", F.col("VALUE"))).alias("snow"),
            F.sum(F.when(F.col("ELEMENT") == "WT01", F.col("VALUE"))).alias("weather"),
        )
    )
    everyone = adapter.stations_demo(spark, sf_dir).select(F.col("STATION_ID").alias("STATION"))
    return scalars.fill_missing_counts(everyone.join(per_supplier, "STATION", "left"), ["snow"])


@query
def effect_size(spark, sf_dir):
    month = F.col("month")
    return rounded(
        stats.effect_size(
            obs_of(spark, sf_dir), "VALUE", month.isin(*SUMMER), month.isin(*SPRING), ("ELEMENT",)
        )
    )


# Joins.


@query
def pivot_wide(spark, sf_dir):
    return windows.pivot_wide(prep.clean_observations(adapter.raw(spark, sf_dir)), ["TMAX", "TMIN"])


@query
def shifted_year_join(spark, sf_dir):
    obs = obs_of(spark, sf_dir)
    early = seasons.seasonal_totals(obs, "PRCP", [11, 12], MIN_DAYS)
    late = seasons.seasonal_totals(obs, "PRCP", [2, 3], MIN_DAYS)
    return joins.shifted_year_join(
        early.select("STATION", "year", F.col("total").alias("early_total")),
        late.select("STATION", "year", F.col("total").alias("late_total")),
    )


@query
def baseline_join_back(spark, sf_dir):
    return rounded(seasons.with_baseline(_yearly_rain(spark, sf_dir), "total"))


@query
def threshold_join(spark, sf_dir):
    winds = adapter.daily(spark, sf_dir).select("STATION", "DATE", "AWND")
    return rounded(thresholds.threshold_join(winds, "AWND", 0.90, flag="is_high_wind"))


@query
def spring_heat_left_join(spark, sf_dir):
    return rounded(heat.heat_detail(obs_of(spark, sf_dir), HEAT, MIN_DAYS)).select(
        "STATION", "year", "spring_avg_tmax", "spring_days", "heat_wave_days",
        "max_heat_wave_temp", "extreme_days", "summer_days",
    )


@query
def melt_precip_join(spark, sf_dir):
    years = snowmelt.melt_precip_years(obs_of(spark, sf_dir), min_days=MIN_DAYS)
    return rounded(snowmelt.melt_precip_join(years)).select(
        "STATION", "year", "snowmelt_doy", "snow_days", "spring_prcp", "spring_prcp_days",
        "baseline_melt_doy", "baseline_spring_prcp",
    )


@query
def attach_region(spark, sf_dir):
    return joins.attach_region(
        obs_of(spark, sf_dir), adapter.obs_stations(spark, sf_dir)
    )


@query
def attach_elevation(spark, sf_dir):
    return joins.attach_elevation(
        obs_of(spark, sf_dir).select("STATION", "DATE", "ELEMENT", "VALUE"),
        adapter.obs_stations(spark, sf_dir),
    )


@query
def station_semi_join(spark, sf_dir):
    ids = adapter.stations_demo_regions(spark, sf_dir).filter("REGION = 'West'")
    return joins.station_semi_join(
        adapter.raw(spark, sf_dir).select("STATION", "DATE", "ELEMENT", "VALUE"),
        ids.select("STATION_ID"),
    )


# Aggregations.


@query
def seasonal_totals(spark, sf_dir):
    return rounded(
        seasons.seasonal_totals(obs_of(spark, sf_dir), "PRCP", [11, 12], MIN_DAYS)
    )


@query
def seasonal_means(spark, sf_dir):
    return rounded(seasons.seasonal_means(obs_of(spark, sf_dir), "TMAX", SPRING, MIN_DAYS))


@query
def station_baseline(spark, sf_dir):
    return rounded(
        seasons.station_baseline(_yearly_rain(spark, sf_dir), "total", need_spread=True)
    )


@query
def percentile_threshold(spark, sf_dir):
    """Thresholds of every supplier's readings, all elements together and per element."""
    both = ["STATION", "ELEMENT"]
    counts = thresholds.counted_readings(adapter.raw(spark, sf_dir), both, "VALUE")
    n = F.col("n")
    return rounded(
        thresholds.percentile_by_group(counts, ["STATION"], "VALUE", 0.95, n)
        .withColumn("ELEMENT", F.lit("ALL"))
        .unionByName(thresholds.percentile_by_group(counts, both, "VALUE", 0.90, n))
    )


def _merged_state(spark: SparkSession, sf_dir: str) -> state.StationState:
    """The state of the readings up to 1997, stored, and of the later ones, merged."""
    obs = dates.derive_date_parts(adapter.raw(spark, sf_dir))
    path = scratch_path(spark, "state")
    state.write_state(state.state_of(obs.filter("year <= 1997")), path)
    later = state.state_of(obs.filter("year > 1997"))
    return state.merged(state.read_state(spark, path), later)


@query
def percentile_from_state(spark, sf_dir):
    merged = _merged_state(spark, sf_dir)
    return rounded(
        merged.percentiles(["STATION"], 0.95)
        .withColumn("ELEMENT", F.lit("ALL"))
        .unionByName(merged.percentiles(["STATION", "ELEMENT"], 0.90))
    )


@query
def profile_from_state(spark, sf_dir):
    """The profile of all raw readings and their duplicate keys."""
    merged = _merged_state(spark, sf_dir)
    extra = merged.duplicate_keys().select(
        F.lit("duplicates").alias("section"),
        F.lit("keys").alias("key"),
        F.col("duplicate_keys").cast("double").alias("value"),
    )
    return rounded(merged.profile().unionByName(extra))


@query
def baseline_from_state(spark, sf_dir):
    rain = _yearly_rain(spark, sf_dir)
    parts = [state.moments_of(rain.filter(years), "total") for years in ("year <= 1995", "year = 1996", "year > 1996")]
    return rounded(state.baseline_of(state.merged_moments(parts), need_spread=True))


@query
def heat_wave_metrics(spark, sf_dir):
    return rounded(heat.heat_wave_metrics(heat.summer_flags(obs_of(spark, sf_dir), HEAT)))


@query
def snowmelt_dates(spark, sf_dir):
    return rounded(snowmelt.snowmelt_dates(obs_of(spark, sf_dir)))


@query
def event_summary(spark, sf_dir):
    events = wind.high_wind_events(wind.wind_days(obs_of(spark, sf_dir)))
    return rounded(wind.event_summary(events))


@query
def pearson_corr(spark, sf_dir):
    return rounded(
        stats.pearson_corr(adapter.daily(spark, sf_dir), "TMAX", "AWND", ("STATION",))
    )


@query
def corr_significance(spark, sf_dir):
    return rounded(
        stats.corr_significance(adapter.daily(spark, sf_dir), "PRCP", "SNWD", ("STATION",))
    )


@query
def conditional_rate(spark, sf_dir):
    return rounded(
        stats.conditional_rate(
            adapter.daily(spark, sf_dir), F.col("AWND") > 50, F.col("TMAX") > 40, ("STATION",)
        )
    )


@query
def tail_comparison(spark, sf_dir):
    anomalies = seasons.standardized_anomaly(_yearly_rain(spark, sf_dir), "total")
    return rounded(stats.tail_comparison(anomalies, "anomaly", "total"))


@query
def coverage_overall(spark, sf_dir):
    return quality.coverage_overall(obs_of(spark, sf_dir))


@query
def coverage_by_element(spark, sf_dir):
    raw = dates.derive_date_parts(adapter.raw(spark, sf_dir))
    return rounded(quality.coverage_by_element(raw))


@query
def coverage_key_elements(spark, sf_dir):
    """Over all readings, with an element besides that never occurs."""
    elements = [*KEY_ELEMENTS, "EVAP"]
    return rounded(quality.coverage_key_elements(adapter.raw(spark, sf_dir), elements))


@query
def validate_quality(spark, sf_dir):
    raw = adapter.raw(spark, sf_dir)
    return quality.validate_quality(raw, max_tmax=45, max_tmin=45, min_tmax=-45, min_tmin=-45)


@query
def heat_wave_trends(spark, sf_dir):
    return rounded(heat.heat_wave_trends(obs_of(spark, sf_dir), HEAT))


@query
def snowmelt_trends(spark, sf_dir):
    return rounded(snowmelt.snowmelt_trends(obs_of(spark, sf_dir)))


@query
def timeseries_rollup(spark, sf_dir):
    regions = joins.attach_region(obs_of(spark, sf_dir), adapter.obs_stations(spark, sf_dir))
    return rounded(seasons.timeseries_rollup(regions, ["REGION", "ELEMENT"], "VALUE"))


@query
def linear_trend(spark, sf_dir):
    return rounded(seasons.linear_trend(_yearly_rain(spark, sf_dir), "total"))


@query
def dataset_profile(spark, sf_dir):
    return rounded(quality.dataset_profile(obs_of(spark, sf_dir)))


@query
def expected_vs_actual(spark, sf_dir):
    return rounded(quality.expected_vs_actual(obs_of(spark, sf_dir), years=7))


@query
def column_coverage(spark, sf_dir):
    return rounded(quality.column_coverage(adapter.raw(spark, sf_dir)))


@query
def expectation_report(spark, sf_dir):
    return rounded(
        quality.expectation_report(
            obs_of(spark, sf_dir),
            adapter.obs_stations(spark, sf_dir),
            records=(100_000, 1_000_000_000),
            min_stations=20,
            years=(1995, 2002),
        )
    )


@query
def source_file_profile(spark, sf_dir):
    """Rows and bytes per input file of orders and order lines, read together."""
    both = spark.read.schema("l_orderkey bigint, o_orderkey bigint").parquet(
        f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet"
    )
    profile = quality.source_file_profile(both)
    has_bytes = (F.col("bytes") > 0) & (F.col("total_bytes") > F.col("bytes"))
    return profile.select("file_name", "records", has_bytes.alias("has_bytes"))


@query
def station_selection_stats(spark, sf_dir):
    return rounded(quality.station_selection_stats(adapter.stations_demo(spark, sf_dir)))


# Windows.


def _summer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.season_filter(seasons.of_element(obs_of(spark, sf_dir), "TMAX"), SUMMER)


@query
def heat_wave_flags(spark, sf_dir):
    return rounded(windows.heat_wave_flags(_summer(spark, sf_dir), HEAT)).select(
        "STATION", "year", "DATE", "heat_threshold", "max_value", "is_extreme", "is_heat_wave_day"
    )


@query
def run_lengths(spark, sf_dir):
    return windows.run_lengths(_summer(spark, sf_dir), HEAT)


def _days_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily readings of two days in three, so that row frames and calendar frames differ."""
    return adapter.daily(spark, sf_dir).filter(F.col("DATE") % 3 != 0)


@query
def run_lengths_calendar(spark, sf_dir):
    return windows.run_lengths(_summer(spark, sf_dir), HEAT, 2, calendar=True)


@query
def lag_lead_calendar(spark, sf_dir):
    days = _days_with_gaps(spark, sf_dir).select("STATION", "DATE", "AWND")
    return windows.lag_lead_features(days, "AWND", 3, calendar=True)


@query
def before_after_calendar(spark, sf_dir):
    days = scalars.diurnal_range(_days_with_gaps(spark, sf_dir))
    return rounded(
        windows.before_after_window(
            days.select("STATION", "DATE", "temp_range"), "temp_range", calendar=True, min_days=3
        )
    )


@query
def lag_lead_features(spark, sf_dir):
    days = adapter.daily(spark, sf_dir).select("STATION", "DATE", "AWND")
    return windows.lag_lead_features(days, "AWND", 7)


@query
def before_after_window(spark, sf_dir):
    days = scalars.diurnal_range(adapter.daily(spark, sf_dir))
    return rounded(
        windows.before_after_window(days.select("STATION", "DATE", "temp_range"), "temp_range")
    )


@query
def high_wind_events(spark, sf_dir):
    return rounded(wind.high_wind_events(wind.wind_days(obs_of(spark, sf_dir))))


@query
def even_spaced_sample(spark, sf_dir):
    quotas = {"Northeast": 53, "Southeast": 47, "Midwest": 1, "West": 2, "Alaska": 100_000}
    quotas |= {"Southwest": 0, "Hawaii": 3}
    return sampling.even_spaced_sample(adapter.stations_demo_regions(spark, sf_dir), quotas)


@query
def regional_random_sample(spark, sf_dir):
    return sampling.regional_random_sample(adapter.stations_demo_regions(spark, sf_dir))


@query
def first_last_years(spark, sf_dir):
    return quality.first_last_years(obs_of(spark, sf_dir), 2)


# Sort, limit and sets.


@query
def top_stations(spark, sf_dir):
    return quality.top_stations(adapter.raw(spark, sf_dir))


@query
def union_years(spark, sf_dir):
    obs = obs_of(spark, sf_dir)
    parts = [obs.filter(F.col("year") == 1995), obs.filter("year > 1995").drop("day")]
    return prep.union_years(parts)


@query
def distinct_keys(spark, sf_dir):
    return prep.distinct_keys(adapter.raw(spark, sf_dir), ["STATION", "DATE", "ELEMENT"])


@query
def distinct_key_counts(spark, sf_dir):
    return quality.count_distinct_keys(adapter.raw(spark, sf_dir))


# Composite analyses.


@query
def winter_precip_lag(spark, sf_dir):
    return rounded(winter.winter_precip_lag(obs_of(spark, sf_dir), MIN_DAYS)[0])


@query
def winter_precip_lag_summary(spark, sf_dir):
    return rounded(winter.winter_precip_lag(obs_of(spark, sf_dir), MIN_DAYS)[1])


@query
def spring_summer_heat(spark, sf_dir):
    return rounded(heat.spring_summer_heat(obs_of(spark, sf_dir), HEAT, MIN_DAYS)[0])


@query
def spring_summer_heat_summary(spark, sf_dir):
    return rounded(heat.spring_summer_heat(obs_of(spark, sf_dir), HEAT, MIN_DAYS)[1])


@query
def wind_moderation(spark, sf_dir):
    return rounded(wind.wind_moderation(obs_of(spark, sf_dir))[1])


@query
def snowmelt_precip(spark, sf_dir):
    return rounded(snowmelt.snowmelt_precip(obs_of(spark, sf_dir), min_days=MIN_DAYS)[0])


@query
def snowmelt_precip_summary(spark, sf_dir):
    return rounded(snowmelt.snowmelt_precip(obs_of(spark, sf_dir), min_days=MIN_DAYS)[1])


@query
def winter_precip_by_region(spark, sf_dir):
    return rounded(
        winter.winter_precip_by_region(
            obs_of(spark, sf_dir), adapter.obs_stations(spark, sf_dir), MIN_DAYS
        )
    )


@query
def wind_by_season(spark, sf_dir):
    return rounded(wind.wind_by_season(obs_of(spark, sf_dir)))


@query
def snowmelt_by_elevation(spark, sf_dir):
    return rounded(
        snowmelt.snowmelt_by_elevation(
            obs_of(spark, sf_dir), adapter.obs_stations(spark, sf_dir), min_days=MIN_DAYS
        )
    )


def _regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-years are stored first, as four branches use them."""
    obs, path = obs_of(spark, sf_dir), scratch_path(spark, "station-years")
    years = station_years.station_years(obs)
    years.write.parquet(path)
    return regional.regional_consistency(
        obs,
        adapter.obs_stations(spark, sf_dir),
        min_rows=REGION_ROWS,
        heat_percentile=HEAT,
        min_days=MIN_DAYS,
        min_spring_days=MIN_DAYS,
        years=spark.read.schema(years.schema).parquet(path),
    )


@query
def regional_consistency(spark, sf_dir):
    return rounded(_regional(spark, sf_dir))


@query
def regional_results_table(spark, sf_dir):
    return rounded(regional.regional_results_table(_regional(spark, sf_dir)))


@query
def direction_consistency(spark, sf_dir):
    return rounded(regional.direction_consistency(_regional(spark, sf_dir)))


def _summary_of_each(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: pair[1] for name, pair in summaries(obs_of(spark, sf_dir)).items()}


@query
def support_verdict(spark, sf_dir):
    return rounded(report.support_verdict(_summary_of_each(spark, sf_dir)))


@query
def summary_report(spark, sf_dir):
    return rounded(report.summary_report(_summary_of_each(spark, sf_dir)))
