"""Partition-wise upserts, corrected deliveries, rejected lines, buckets, state and documents."""

import gzip
import json

import pytest
from observation_tables import observation_rows
from pyspark.sql import functions as F

from stationlab.operators import quality, seasons, state, thresholds, windows
from stationlab.plans import heat, report, wind
from stationlab.sinks import files as sink_files
from stationlab.sinks import partitions
from stationlab.sources import files as source_files
from stationlab.streaming import ingest

SCHEMA = "station string, year int, a double, b double"


def files_of(path):
    return {p.parent.name: p.name for p in path.glob("year=*/*.parquet")}


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = tmp_path / "t"
    rows = [(s, y, 1.0, 1.0) for s in "AB" for y in range(2000, 2025)]
    schema = spark.createDataFrame([], SCHEMA).schema

    def upsert(updates):
        df = spark.createDataFrame(updates, SCHEMA)
        partitions.upsert_partitions(spark, str(path), df, ["station", "year"], ["a"], "year", schema)

    upsert(rows)
    before = files_of(path)
    upsert([("A", 2010, 5.0, 5.0), ("C", 2010, 6.0, 6.0), ("D", None, 7.0, 7.0)])
    after = files_of(path)
    assert {k for k in after if after[k] != before.get(k)} == {"year=2010", "year=__HIVE_DEFAULT_PARTITION__"}
    got = {(r.station, r.year): (r.a, r.b) for r in spark.read.schema(schema).parquet(str(path)).collect()}
    assert len(got) == 52 and got["A", 2010] == (5.0, 1.0) and got["B", 2010] == (1.0, 1.0)
    assert got["C", 2010] == (6.0, 6.0) and got["D", None] == (7.0, 7.0)
    # A NULL key matches nothing, as in a table with a unique key.
    upsert([("D", None, 8.0, 0.0)])
    assert spark.read.schema(schema).parquet(str(path)).filter("station = 'D'").count() == 2
    with pytest.raises(ValueError, match="one of the keys"):
        partitions.upsert_partitions(
            spark, str(path), spark.createDataFrame([], SCHEMA), ["station"], ["a"], "year", schema
        )


def deliver(folder, number, name, lines):
    place = folder / f"delivery={number}"
    place.mkdir(parents=True, exist_ok=True)
    with gzip.open(place / name, "wt") as out:
        out.write("".join(f"{line},,,7,\n" for line in lines))


def test_the_newest_delivery_of_a_year_counts(spark, tmp_path):
    source, target, checkpoint = (tmp_path / n for n in ("in", "out", "done"))

    def run():
        ingest.ingest_deliveries(spark, str(source), str(target), str(checkpoint), files_per_batch=1)
        rows = ingest.current_years(spark, str(target))
        return sorted((r.STATION, r.DATE, r.VALUE) for r in rows.collect())

    deliver(source, 1, "2000.csv.gz", ["A,20000101,AWND,1", "B,20000101,AWND,1"])
    deliver(source, 1, "2001a.csv.gz", ["A,20010101,AWND,1"])
    deliver(source, 1, "2001b.csv.gz", ["B,20010101,AWND,1"])
    first = [("A", 20000101, 1.0), ("A", 20010101, 1.0), ("B", 20000101, 1.0), ("B", 20010101, 1.0)]
    assert run() == first
    # The same file name, other values, fewer rows: the year is replaced as a whole.
    deliver(source, 3, "2000.csv.gz", ["A,20000101,AWND,9"])
    second = [("A", 20000101, 9.0), ("A", 20010101, 1.0), ("B", 20010101, 1.0)]
    assert run() == second and run() == second
    # An older delivery that arrives late changes nothing.
    deliver(source, 2, "2000.csv.gz", ["A,20000101,AWND,5", "C,20000101,AWND,5"])
    assert run() == second
    assert ingest.drop_superseded(spark, str(target)) == [(2000, 1), (2000, 2)]
    assert run() == second and ingest.drop_superseded(spark, str(target)) == []


def test_a_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    raw = spark.createDataFrame([("A", 20000101, "AWND", 3, None, None, "7", None, 1)], ingest.DELIVERED)
    write = ingest.batch_writer(str(tmp_path / "t"))
    for _ in range(2):
        write(raw, 5)
    assert ingest.current_years(spark, str(tmp_path / "t")).count() == 1


def test_kept_and_rejected_lines_are_all_lines(spark, tmp_path):
    good = ["A,20000101,TMAX,10,,,7,", "A,20000102,TMAX,11,,X,7,0700"]
    bad = ["A,20000103,TMAX", "A,x,TMAX,10,,,7,", "A,20000104,TMAX,10,,,7,,extra", "A,20000105,TMAX,ten,,,7,",
           ",20000106,TMAX,10,,,7,", "A,20000107,,10,,,7,", "A,20000108,TMAX,,,,7,", "A,,TMAX,1,,,7,"]
    (tmp_path / "one.csv").write_text("\n".join(good + bad[:4]) + "\n")
    (tmp_path / "two.csv").write_text("\n".join(bad[4:]) + "\n")
    checked = source_files.read_raw_checked(spark, f"{tmp_path}/*.csv")
    rejects = {r.line: (r.source_file, r.fault) for r in source_files.rejected_rows(checked).collect()}
    assert len(rejects) == 8 and source_files.kept_rows(checked).count() == 2
    assert rejects["A,20000103,TMAX"] == ("one.csv", "malformed line")
    assert {rejects[x][1] for x in bad[:4]} == {"malformed line"}
    assert sorted(f for _, f in rejects.values())[4:] == [
        "missing DATE", "missing ELEMENT", "missing STATION", "missing VALUE"
    ]
    assert source_files.kept_rows(checked).columns == source_files.read_raw_yearly(spark, str(tmp_path)).columns
    # Faults do not depend on the columns that are read.
    assert checked.groupBy("fault").count().filter("fault = 'malformed line'").first()["count"] == 4
    source_files.store_checked(checked, f"{tmp_path}/stored")
    sizes = {r.rejected: r.n for r in spark.read.parquet(f"{tmp_path}/stored").groupBy("rejected").agg(F.count("*").alias("n")).collect()}
    assert {str(k).lower(): n for k, n in sizes.items()} == {"true": 8, "false": 2}


def test_station_line_faults(spark, tmp_path):
    def line(key="US000000001", lat="  1.0", lon="-100.0", elevation="  5.0"):
        return f"{key:11s} {lat:>8s} {lon:>9s} {elevation:>6s} TX {'Name':30s}"

    lines = [line(), line(elevation=""), line(lat="north"), line(lon="x"), line(elevation="high"), line(key=""), line()[:60]]
    (tmp_path / "s.txt").write_text("\n".join(lines) + "\n")
    rows = source_files.read_stations_checked(spark, str(tmp_path / "s.txt")).collect()
    assert [r.fault for r in rows] == [
        None, None, "malformed LATITUDE", "malformed LONGITUDE", "malformed ELEVATION", "missing STATION_ID", "short line"
    ]


def exchanges(df):
    """Hash exchanges by station below the final aggregation."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning(STATION")


def test_analyses_over_buckets_do_not_shuffle_stations(spark, tmp_path, generated):
    name = "clustered_generated"
    sink_files.write_clustered(generated, name, f"{tmp_path}/{name}", 8)
    stored = spark.table(name)
    plain = generated.select("STATION", "DATE", "ELEMENT", "VALUE", "year", "month", "day")
    assert exchanges(wind.wind_moderation(plain)[1]) > 0
    for analysis in (lambda o: wind.wind_moderation(o)[1], lambda o: heat.heat_wave_metrics(heat.summer_flags(o, 0.9))):
        assert exchanges(analysis(stored)) == 0
        got, want = (sorted(map(str, analysis(o).collect())) for o in (stored, plain))
        assert len(got) == len(want)
    assert wind.wind_moderation(stored)[1].first().num_events == wind.wind_moderation(plain)[1].first().num_events
    spark.sql(f"DROP TABLE {name}")


def test_state_of_years_merges(spark, tmp_path, generated):
    old, new = generated.filter("year < 2019"), generated.filter("year >= 2019")
    state.write_state(state.state_of(old), f"{tmp_path}/state")
    merged = state.merged(state.read_state(spark, f"{tmp_path}/state"), state.state_of(new))
    got, want = (sorted(map(tuple, df.collect())) for df in (merged.profile(), quality.dataset_profile(generated)))
    assert got == want
    by = ["STATION", "ELEMENT"]
    got = {tuple(r[:2]): r.threshold for r in merged.percentiles(by, 0.9).collect()}
    want = {tuple(r[:2]): r.threshold for r in thresholds.percentile_by_group(generated, by, "VALUE", 0.9).collect()}
    assert got == pytest.approx(want)
    assert merged.duplicate_keys().first().duplicate_keys == 0
    twice = state.merged(state.state_of(new), state.state_of(new))
    assert twice.duplicate_keys().first().duplicate_keys == new.count()
    totals = seasons.seasonal_totals(generated, "PRCP", [4, 5], 10).select("STATION", "year", "total")
    parts = [state.moments_of(totals.filter(w), "total") for w in ("year < 2015", "year = 2015", "year > 2015", "year > 9999")]
    got = {r.STATION: (r.baseline, r["std"], r.n) for r in state.baseline_of(state.merged_moments(parts)).collect()}
    want = {r.STATION: (r.baseline, r["std"], r.n) for r in seasons.station_baseline(totals, "total").collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_state_of_odd_rows(spark):
    rows = [("A", 20200101, "TMAX", None), ("A", 20200101, "TMAX", float("nan")), (None, None, None, 1.0), ("A", 20200102, "TMAX", 4.0)]
    obs = observation_rows(spark, rows)
    both = state.merged(state.state_of(obs), state.state_of(obs.filter("1 = 0")))
    assert both.duplicate_keys().first().duplicate_keys == 1
    assert [r.threshold for r in both.percentiles(["STATION"], 0.5).collect()] == [4.0]
    empty = state.merged(state.state_of(obs.filter("1 = 0")))
    assert empty.percentiles(["STATION"], 0.5).count() == 0


def test_calendar_frames_see_gaps(spark):
    rows = [("A", d, "TMAX", v) for d, v in ((20191230, 1.0), (20191231, 2.0), (20200102, 4.0), (20200103, None), (20209999, 8.0))]
    daily = observation_rows(spark, rows).select("STATION", "DATE", "VALUE")
    got = {r.DATE: r for r in windows.lag_lead_features(daily, "VALUE", 2, calendar=True).collect()}
    assert (got[20200102].VALUE_lag_1, got[20200102].VALUE_lag_2, got[20200102].VALUE_lead_1) == (None, 2.0, None)
    assert (got[20191231].VALUE_lag_1, got[20191231].VALUE_lead_2) == (1.0, 4.0)
    assert got[20209999].VALUE_lag_1 is None and set(got[20209999].asDict()) == set(got[20200102].asDict())
    means = {r.DATE: (r.avg_before, r.avg_after) for r in windows.before_after_window(daily, "VALUE", 3, calendar=True, min_days=1).collect()}
    assert means[20200102] == (1.5, None) and means[20191230] == (None, 3.0) and means[20209999] == (None, None)
    whole = windows.before_after_window(daily, "VALUE", 1, calendar=True).collect()
    assert {r.DATE: r.avg_before for r in whole}[20191231] == 1.0


def test_missing_days_end_a_run(spark):
    # The median, 5, is not extreme; 9 is, on six days with a gap after the third.
    days = [20200601, 20200602, 20200603, 20200605, 20200606, 20200607]
    rows = [("A", d, "TMAX", 9.0) for d in days] + [("A", 20200700 + i, "TMAX", 5.0) for i in range(1, 9)]
    obs = observation_rows(spark, rows)
    lengths = lambda **o: sorted(r.run_length for r in windows.run_lengths(obs, 0.5, **o).collect())
    assert lengths() == [6] and lengths(calendar=True) == [3, 3]
    assert windows.heat_wave_flags(obs, 0.5, 4, calendar=True).filter("is_heat_wave_day").count() == 0


def test_documents_of_several_runs(spark, tmp_path):
    one = spark.createDataFrame([(0.5, 3, "ok")], "correlation double, sample_size long, status string")
    two = spark.createDataFrame([(None, 7)], "correlation double, sample_size long")
    documents = report.run_documents({"a": report.results_document({"H1": one}), "b": report.results_document({"H1": two, "H9": one})})
    documents.write.parquet(f"{tmp_path}/d")
    stored = spark.read.parquet(f"{tmp_path}/d")
    assert stored.schema["document"].dataType.simpleString() == "variant"
    found = report.document_metrics(stored, {"H1": ["correlation", "sample_size", "none"], "H9": ["correlation", "status"]})
    assert sorted(map(tuple, found.collect())) == [
        ("a", "H1", "correlation", 0.5), ("a", "H1", "sample_size", 3.0), ("b", "H1", "sample_size", 7.0), ("b", "H9", "correlation", 0.5)
    ]
    text = stored.filter("run = 'b'").select(F.to_json("document").alias("t")).first().t
    assert json.loads(text)["H9"]["status"] == "ok"
