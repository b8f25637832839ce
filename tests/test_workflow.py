import json

from pyspark.sql import functions as F

from stationlab.operators.joins import map_state_to_region
from stationlab.plans import workflow
from stationlab.operators import quality
from stationlab.sinks.results import read_result
from stationlab.sources.files import read_observations


def test_from_raw_files_to_stored_results(spark, generated, generated_stations, tmp_path):
    """Raw files of the generated stations, prepared, analysed and stored twice."""
    text, raw, target = (str(tmp_path / n) for n in ("stations.txt", "raw", "prepared"))
    generated_stations.select(
        F.format_string(
            "%-11s %8.1f %9.1f %6.1f %2s %-30s",
            "STATION_ID", "LATITUDE", "LONGITUDE", "ELEVATION", "STATE", "NAME",
        ).alias("value")
    ).write.text(text)
    tenths = F.col("ELEMENT").isin("TMAX", "TMIN", "PRCP")
    value = F.round(F.when(tenths, F.col("VALUE") * 10).otherwise(F.col("VALUE"))).cast("int")
    empty = F.lit(None).cast("string")
    generated.select(
        "STATION", "DATE", "ELEMENT", value.alias("VALUE"), empty.alias("MFLAG"),
        F.when(F.col("day") == 13, "X").alias("QFLAG"), F.lit("7").alias("SFLAG"),
        empty.alias("TIME"),
    ).write.option("compression", "gzip").csv(raw)

    counts = quality.RowCounts(max_tmax=30, min_tmin=0)
    quotas = {"Southwest": 3, "West": 9, "Northeast": 3}
    stations = workflow.prepare(spark, text, raw, target, quotas, counts)
    assert stations.count() == 10
    obs = read_observations(spark, f"{target}/observations", "parquet")
    assert obs.select("STATION").distinct().count() == 10
    assert obs.filter("day = 13").count() == 0
    # Counted while the readings were written, the same as over what was written.
    issues = quality.validate_quality(obs, max_tmax=30, min_tmin=0).filter("issue <> 'duplicate_keys'")
    assert sorted(counts.issues(spark).collect()) == sorted(issues.collect()) != []
    assert counts.coverage(spark).collect() == quality.coverage_by_element(obs).collect()
    assert counts.figures()["records"] == obs.count()

    found = workflow.analyze(obs, stations, workflow.Gates(season_days=45))
    runs = [str(tmp_path / f"run{i}") for i in range(2)]
    tables = workflow.store(spark, found, runs[0], stations)
    assert len(tables) == 8
    first = {t: read_result(spark, runs[0], t).count() for t in tables}
    assert all(first.values())
    # Three analyses in three regions; snowmelt needs stations whose melt day varies.
    assert 9 <= first["regional_results"] <= 12 and first["stations"] == 10
    workflow.store(spark, found, runs[1], stations, runs[0])
    assert {t: read_result(spark, runs[1], t).count() for t in tables} == first

    document = json.loads(spark.read.text(f"{runs[1]}/document").first().value)
    assert len(document) == 4
    assert found.verdicts().count() == 4
    assert found.reports["quality_issues"].count() == 0
    assert map_state_to_region(stations).filter("REGION is null").count() == 0
