import json
from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from observation_tables import observation_rows
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from stationlab.operators import quality
from stationlab.plans import report
from stationlab.schemas import RESULT_TABLES
from stationlab.sinks import files as sinks
from stationlab.sinks import jdbc, results
from stationlab.sources import files as sources
from stationlab.sources.generator import generate_observations
from stationlab.streaming.ingest import ingest_years


def write(path, text):
    path.write_text(text)
    return str(path)


def test_observations_csv_with_empty_value(spark, tmp_path):
    path = write(tmp_path / "o.csv", "STATION,DATE,ELEMENT,VALUE\nA,20200229,TMAX,15.5\nA,20200301,TMAX,\n")
    rows = sources.read_observations(spark, path).orderBy("DATE").collect()
    assert tuple(rows[0]) == ("A", 20200229, "TMAX", 15.5, 2020, 2, 29)
    assert rows[1].VALUE is None


def test_yearly_files_and_station_ids(spark, tmp_path):
    head = "STATION,DATE,ELEMENT,VALUE,MFLAG,QFLAG,SFLAG,TIME\n"
    write(tmp_path / "2000_filtered.csv", head + "A,20000101,TMAX,10,,,7,0700\n")
    write(tmp_path / "2001_filtered.csv", head + "A,20010101,TMAX,10,,I,7,\n")
    rows = sources.read_filtered_years(spark, f"{tmp_path}/*_filtered.csv").orderBy("DATE").collect()
    assert [r.source_file for r in rows] == ["2000_filtered.csv", "2001_filtered.csv"]
    assert [r.QFLAG for r in rows] == [None, "I"] and rows[0].TIME == "0700"
    ids = write(tmp_path / "ids.txt", " A \nB\nA\n\n")
    assert sorted(r.STATION for r in sources.read_station_ids(spark, ids).collect()) == ["A", "B"]


def test_ingest_reads_each_file_once_and_keeps_listed_stations(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    ids = spark.createDataFrame([("A",)], "STATION string")
    write(source / "2000.csv", "A,20000101,TMAX,105,,,7,\nB,20000101,TMAX,10,,,7,\n")
    ingest_years(spark, str(source), target, progress, ids)
    write(source / "2001.csv", "A,20010101,PRCP,5,,,7,\nA,20010102,PRCP,5,,X,7,\n")
    for _ in range(2):
        ingest_years(spark, str(source), target, progress, ids)
    rows = sorted((r.STATION, r.DATE, r.VALUE, r.year) for r in spark.read.parquet(target).collect())
    assert rows == [("A", 20000101, 10.5, 2000), ("A", 20010101, 0.5, 2001)]


def test_clean_long_round_trip(spark, tmp_path, generated):
    path = str(tmp_path / "clean")
    part = generated.filter("STATION <= 'USC00000001'")
    sinks.write_clean_long(part, path)
    back = sources.read_observations(spark, path, "parquet")
    assert sorted(back.columns) == sorted(part.columns)
    assert back.select(*part.columns).exceptAll(part).count() == 0 and back.count() == part.count()
    years = {r.year for r in sources.read_year_range(spark, path, 2013, 2014).select("year").distinct().collect()}
    assert years == {2013, 2014}


def test_flat_export_formats(spark, tmp_path):
    df = spark.range(10, numPartitions=4)
    sinks.export_flat(df, str(tmp_path / "c"), single_file=True)
    assert len(list((tmp_path / "c").glob("part-*.csv"))) == 1
    sinks.export_flat(df, str(tmp_path / "j"), "json")
    assert len(list((tmp_path / "j").glob("part-*.json"))) == 4
    with pytest.raises(ValueError, match="Unsupported format"):
        sinks.export_flat(df, str(tmp_path / "x"), "xml")


def test_jdbc_modes():
    df = MagicMock()
    jdbc.export_jdbc(df, "t", "url", {"user": "u"}, mode="append")
    df.write.mode.assert_called_once_with("append")
    with pytest.raises(ValueError):
        jdbc.export_jdbc(df, "t", "url", {}, mode="upsert")


def test_results_document_keeps_nulls(spark):
    first = spark.createDataFrame([(None, 3)], "correlation double, sample_size long")
    second = spark.createDataFrame([(0.5,)], "correlation_days double")
    document = report.results_document({"H1": first, "H2": second}).first().document
    assert json.loads(document) == {
        "hypothesis_1_winter_precipitation": {"correlation": None, "sample_size": 3},
        "hypothesis_2_spring_summer_heat": {"correlation_days": 0.5},
    }


def test_metrics_in_long_form(spark):
    summary = spark.createDataFrame(
        [(0.5, None, 7, 3, "ok")],
        "correlation double, rate double, lag_days int, sample_size long, status string",
    )
    rows = sorted(map(tuple, report.summary_metrics_long(summary, "H1").collect()))
    assert rows == [("H1", "correlation", 0.5, 3), ("H1", "lag_days", 7.0, 3)]


def test_every_result_table_merges(spark):
    for table, spec in RESULT_TABLES.items():
        schema = results.result_schema(table)
        values = {"string": "k", "int": 1, "bigint": 1, "double": 1.5, "boolean": True}
        old = {f.name: values[f.dataType.simpleString()] for f in schema.fields}
        changed = {"int": 2, "bigint": 2, "double": 2.5, "boolean": False, "string": "z"}
        new = {
            f.name: old[f.name] if f.name in spec["keys"] else changed[f.dataType.simpleString()]
            for f in schema.fields
        }
        current = spark.createDataFrame([old], schema)
        updates = spark.createDataFrame([new], schema)
        row = results.merged_result(spark, table, updates, current).first().asDict()
        for name in spec["update"]:
            assert row[name] == new[name], (table, name)
        for name in spec["insert_only"]:
            assert row[name] == old[name], (table, name)


def test_runs_have_folders_of_their_own(spark, tmp_path):
    stations = spark.createDataFrame(
        [("A", 1.0, 0.0)], "STATION_ID string, LATITUDE double, ELEVATION double"
    )
    first, second, third = (f"{tmp_path}/run{i}" for i in range(3))
    assert results.read_result(spark, None, "stations") is None
    assert results.read_result(spark, first, "stations") is None
    nothing = {"H1": (None, None)}
    assert results.export_all_results(spark, first, nothing, stations=stations) == ["stations"]
    moved = spark.createDataFrame(
        [("A", 0.0), ("B", 2.0)], "STATION_ID string, LATITUDE double"
    )
    results.export_all_results(spark, second, nothing, stations=moved, previous=first)
    rows = {r.station_id: r.latitude for r in results.read_result(spark, second, "stations").collect()}
    assert rows == {"A": 0.0, "B": 2.0}
    # A run without news carries tables over; earlier runs stay as they were.
    assert results.export_all_results(spark, third, nothing, previous=second) == []
    assert results.read_result(spark, third, "stations").count() == 2
    assert results.read_result(spark, first, "stations").count() == 1


def test_two_runs_cannot_write_the_same_folder(spark, tmp_path):
    one, other = (
        spark.createDataFrame([(name, 1.0)], "STATION_ID string, LATITUDE double") for name in "AB"
    )
    folder = f"{tmp_path}/run"
    results.export_all_results(spark, folder, {}, stations=one)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        results.export_all_results(spark, folder, {}, stations=other)
    assert results.read_result(spark, folder, "stations").first().station_id == "A"


def test_counts_beyond_an_int_are_stored(spark):
    rows = spark.createDataFrame(
        [("H1", "m", 1.0, 3_000_000_000)],
        "hypothesis string, metric_name string, metric_value double, sample_size long",
    )
    assert results.as_result_rows(rows, "analysis_summary").first().sample_size == 3_000_000_000


def test_profile_lists_every_file(spark, tmp_path):
    for i in range(7):
        write(tmp_path / f"{i}.csv", "A,1\n" * (i + 1))
    df = spark.read.csv(f"{tmp_path}/*.csv")
    rows = quality.source_file_profile(df).collect()
    assert [r.records for r in rows] == list(range(1, 8))
    assert {r.total_bytes for r in rows} == {4 * 28} and rows[2].bytes == 12
    assert quality.source_file_profile(df, 5).count() == 5


def test_yearly_trend_rows(spark):
    trends = spark.createDataFrame([(2000, 1.5, 0)], "year int, avg_melt_doy double, num_stations int")
    rows = results.yearly_trend_rows(
        trends, "melt_doy", {"avg_value": "avg_melt_doy", "num_stations": "num_stations"}
    )
    assert tuple(rows.first()) == (2000, "melt_doy", 1.5, 0)


def test_generator_is_repeatable_and_complete(spark):
    first = generate_observations(spark, 2, 2)
    second = generate_observations(spark, 2, 2).repartition(3)
    assert first.count() == 2 * 2 * 365 * 6
    assert first.exceptAll(second).count() == 0
    means = {r.ELEMENT: r.m for r in first.groupBy("ELEMENT").agg(F.avg("VALUE").alias("m")).collect()}
    assert 16 < means["TMAX"] < 19 and 6 < means["TMIN"] < 9 and 2.5 < means["PRCP"] < 3.5
    assert first.filter("VALUE < 0 and ELEMENT in ('PRCP', 'SNOW', 'SNWD', 'AWND')").count() == 0


def test_observation_rows_helper(spark):
    assert observation_rows(spark, [("A", 20201231, "TMAX", 1.0)]).first().month == 12


def test_storing_checked_rows_does_not_sort_them(spark, tmp_path, monkeypatch):
    """Without two open writers Spark sorts all rows of a task by partition before it writes them."""
    lines = "".join(f"A,2020010{i % 9 + 1},TMAX,{i if i % 3 else ''},,,7,\n" for i in range(30))
    checked = sources.read_raw_checked(spark, write(tmp_path / "raw.csv", lines))
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    held, parquet = [], DataFrameWriter.parquet

    def watched(self, *args):
        held.append(spark.conf.get(writers))
        return parquet(self, *args)

    before = spark.conf.get(writers)
    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    sources.store_checked(checked, f"{tmp_path}/stored")
    assert held == ["2"] and spark.conf.get(writers) == before
    stored = spark.read.parquet(f"{tmp_path}/stored")
    sizes = {str(r.rejected).lower(): r["count"] for r in stored.groupBy("rejected").count().collect()}
    assert sizes == {"true": 10, "false": 20}
