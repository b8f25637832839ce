"""What the physical plans look like: number of scans, pruning, limits before the shuffle."""

import re

import pytest

from stationlab.operators import joins, quality, sampling, thresholds
from stationlab.plans import heat, snowmelt, wind, winter, workflow
from stationlab.sinks.files import write_clean_long
from stationlab.sources.files import read_observations, read_year_range


@pytest.fixture(scope="module")
def stored(spark, generated, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "clean")
    write_clean_long(generated, path)
    return path


def executed(df):
    """The final adaptive plan."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    ("analysis", "scans"),
    [
        (winter.winter_precip_lag, 1),
        (heat.spring_summer_heat, 2),
        (wind.wind_moderation, 1),
        (snowmelt.snowmelt_precip, 1),
    ],
)
def test_each_summary_reads_its_input_once(spark, stored, analysis, scans):
    plan = executed(analysis(read_observations(spark, stored, "parquet"))[1])
    assert len(re.findall(r"FileScan parquet", plan)) == scans
    assert "PushedFilters: []" not in plan


def test_reports_read_their_input_once(spark, stored):
    obs = read_observations(spark, stored, "parquet")
    for report in (quality.validate_quality, quality.dataset_profile, quality.coverage_key_elements):
        assert len(re.findall(r"FileScan parquet", executed(report(obs)))) == 1


def test_year_filter_opens_only_those_years(spark, stored):
    plan = executed(read_year_range(spark, stored, 2013, 2014).select("VALUE"))
    assert re.search(r"PartitionFilters: \[.*year", plan)
    assert "ReadSchema: struct<VALUE:double>" in plan


def test_random_sample_is_limited_before_the_shuffle(spark, generated_stations):
    from stationlab.operators.joins import map_state_to_region

    plan = executed(sampling.regional_random_sample(map_state_to_region(generated_stations)))
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "attach",
    [
        lambda obs, stations: joins.attach_region(obs, stations),
        lambda obs, stations: joins.attach_elevation(obs, stations),
        lambda obs, stations: joins.station_semi_join(obs, stations.select("STATION_ID")),
        lambda obs, stations: joins.station_semi_join(obs, stations.select("STATION_ID"), salts=4),
        lambda obs, stations: thresholds.threshold_join(obs, "VALUE", 0.9, ("year", "STATION")),
    ],
)
def test_filters_and_pruning_pass_through_station_joins(spark, stored, generated_stations, attach):
    obs = read_observations(spark, stored, "parquet")
    plan = executed(attach(obs, generated_stations).filter("year = 2013").select("STATION", "VALUE"))
    scans = re.findall(r"FileScan parquet.*", plan)
    assert scans and all(re.search(r"PartitionFilters: \[[^]]*year", scan) for scan in scans)
    assert all("ELEMENT" not in scan.split("ReadSchema")[1] for scan in scans)


def test_heat_moves_a_station_once(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        summary = heat.spring_summer_heat(read_observations(spark, stored, "parquet"))[1]
        plan = summary._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"\bExchange ", plan)) <= 7


def test_a_run_reads_its_observations_three_times(spark, stored, generated_stations):
    found = workflow.analyze(read_observations(spark, stored, "parquet"), generated_stations)
    scans = [
        len(re.findall("FileScan parquet", table._jdf.queryExecution().executedPlan().toString()))
        for table in found.tables.values()
    ]
    assert sum(scans) == 3
