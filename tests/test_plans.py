"""The composite analyses at their default gates, over generated stations."""

import pytest
from observation_tables import observation_rows
from pyspark.sql import functions as F

from stationlab.operators import joins, windows
from stationlab.plans import heat, regional, report, snowmelt, wind, winter


def close(a, b):
    if a is None or b is None or isinstance(a, str):
        return a == b
    return a == pytest.approx(b, rel=1e-9, abs=1e-9)


def same(row, other):
    return all(close(value, other[name]) for name, value in row.asDict().items() if name in other)


def test_all_analyses_have_results_at_default_gates(generated):
    first = winter.winter_precip_lag(generated)[1].first()
    assert first.sample_size == 12 * 7 and first.correlation is not None
    second = heat.spring_summer_heat(generated)[1].first()
    assert second.sample_size == 12 * 8 and second.avg_extreme_warm_spring > 0
    third = wind.wind_moderation(generated)[1].first()
    assert third.status == "ok" and third.num_events > 1000
    fourth = snowmelt.snowmelt_precip(generated)[1].first()
    assert fourth.status == "ok" and fourth.num_stations <= 12


def test_grouped_summaries_equal_filtered_runs(generated, generated_stations):
    tagged = joins.attach_region(generated, generated_stations).cache()
    winters = {r.REGION: r.asDict() for r in winter.winter_precip_by_region(generated, generated_stations).collect()}
    assert set(winters) == {"Southwest", "West", "Northeast"}
    regions = regional.regional_consistency(generated, generated_stations).collect()
    found = {(r.hypothesis, r.region): r for r in regions}
    assert len(found) == 12
    for region in winters:
        part = tagged.filter(F.col("REGION") == region)
        assert same(winter.winter_precip_lag(part)[1].first(), winters[region])
        third = wind.wind_moderation(part)[1].first()
        assert close(third.moderation_rate, found[regional.H3, region].moderation_rate)
        fourth = snowmelt.snowmelt_precip(part)[1].first()
        assert close(fourth.correlation, found[regional.H4, region].correlation)
        second = heat.spring_summer_heat(part)[1].first()
        assert close(second.correlation_days, found[regional.H2, region].correlation)


def test_bands_and_seasons_equal_filtered_runs(generated, generated_stations):
    bands = snowmelt.snowmelt_by_elevation(generated, generated_stations).collect()
    tagged = joins.attach_elevation(generated, generated_stations).cache()
    assert len(bands) == 3
    for row in bands:
        part = tagged.filter(F.col("elev_band") == row.elev_band)
        assert same(snowmelt.snowmelt_precip(part)[1].first(), row.asDict())
    for row in wind.wind_by_season(generated).collect():
        months = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8], "Fall": [9, 10, 11]}
        part = generated.filter(F.col("month").isin(*months[row.season]))
        assert same(wind.wind_moderation(part)[1].first(), row.asDict())


def test_overall_count_is_the_sum_of_regions_and_the_unknown(generated, generated_stations):
    detail = joins.attach_region(winter.winter_detail(generated), generated_stations)
    parts = winter.winter_summary(detail, ["REGION"]).collect()
    assert None in {r.REGION for r in parts}
    assert sum(r.sample_size for r in parts) == winter.winter_precip_lag(generated)[1].first().sample_size


def test_region_gate_and_missing_results(generated, generated_stations):
    few = generated.filter("STATION >= 'USC00000008'").filter("ELEMENT <> 'AWND' and ELEMENT <> 'SNWD'")
    assert regional.regional_consistency(few, generated_stations, min_rows=10**9).count() == 0
    rows = {r.hypothesis: r for r in regional.regional_consistency(few, generated_stations).collect()}
    assert {r.region for r in rows.values()} == {"Northeast"}
    assert rows[regional.H3].status == "No overlapping data" and rows[regional.H3].num_events is None
    assert rows[regional.H4].status == "No snow data"
    table = regional.regional_results_table(regional.regional_consistency(few, generated_stations))
    assert {r.hypothesis for r in table.collect()} == {regional.H1, regional.H2}


def test_empty_input_gives_a_row_without_metrics(generated):
    empty = generated.filter("STATION = 'none'")
    assert winter.winter_precip_lag(empty)[1].first().sample_size == 0
    assert heat.spring_summer_heat(empty)[1].first().correlation_days is None
    third = wind.wind_moderation(empty)[1].first()
    assert (third.status, third.num_events) == ("No overlapping data", 0)
    calm = generated.withColumn("VALUE", F.when(F.col("ELEMENT") == "AWND", 1.0).otherwise(F.col("VALUE")))
    assert wind.wind_moderation(calm)[1].first().status == "No complete events"
    assert snowmelt.snowmelt_precip(empty)[1].first().status == "No snow data"
    dry = generated.filter("ELEMENT <> 'PRCP'")
    assert snowmelt.snowmelt_precip(dry)[1].first().status == "No overlapping data"


def test_late_winter_without_spread_keeps_its_row(spark):
    rows = []
    for year in range(2000, 2007):
        for day in range(1, 31):
            for month in (11, 12):
                rows.append(("A", year * 10000 + month * 100 + day, "PRCP", float(year % 4)))
            for month in (2, 3):
                if day <= 28:
                    rows.append(("A", year * 10000 + month * 100 + day, "PRCP", 1.0))
    detail = winter.winter_detail(observation_rows(spark, rows)).collect()
    assert len(detail) == 6
    assert all(r.late_anomaly is None and r.early_anomaly is not None for r in detail)
    summary = winter.winter_precip_lag(observation_rows(spark, rows))[1].first()
    assert summary.correlation is None and summary.sample_size == 6


def test_flags_equal_runs_on_generated_summers(generated):
    summer = generated.filter("ELEMENT = 'TMAX' and month in (6, 7, 8)")
    days = windows.heat_wave_flags(summer, 0.7).filter("is_heat_wave_day").count()
    runs = windows.run_lengths(summer, 0.7).agg(F.sum("run_length").alias("n")).first().n
    assert days == runs > 0


def test_duplicated_readings_do_not_change_winter_means(generated):
    """Sums double and gates see twice the rows, but anomalies stay the same."""
    once = {(r.STATION, r.year): r.early_anomaly for r in winter.winter_detail(generated).collect()}
    twice = winter.winter_detail(generated.union(generated)).collect()
    assert all(close(once[r.STATION, r.year], r.early_anomaly) for r in twice) and len(twice) == len(once)


def test_verdicts(spark):
    def summary(name, value):
        return spark.createDataFrame([(value,)], f"{name} double")

    rows = report.support_verdict(
        {
            "H1": summary("correlation", -0.2),
            "H2": summary("correlation_days", 0.1),
            "H3": summary("moderation_rate", None),
            "H4": summary("correlation", 0.11),
        }
    ).collect()
    assert [r.verdict for r in rows] == ["SUPPORTED", "NOT SUPPORTED", "NOT SUPPORTED", "SUPPORTED"]


def test_direction_needs_two_regions(spark):
    rows = [("H1", 0.2, None), ("H1", 0.3, None), ("H1", -0.1, None), ("H2", 0.5, None), ("H3", None, -1.0),
            ("H3", None, 1.0)]
    df = spark.createDataFrame(rows, "hypothesis string, correlation double, avg_range_change double")
    found = {r.hypothesis: (r.majority_share, r.consistent) for r in regional.direction_consistency(df).collect()}
    assert found["H1"] == (pytest.approx(2 / 3), True)
    assert found["H2"] == (1.0, None)
    assert found["H3"] == (0.5, False)
