import numpy as np
import pytest
from pyspark.sql import functions as F

from observation_tables import observation_rows
from stationlab.functions.dates import day_of_year, is_calendar_day
from stationlab.functions.scalars import elevation_bands
from stationlab.operators import joins, prep, quality, sampling
from stationlab.operators.upsert import keyed_merge


def test_dates_that_do_not_exist(spark):
    days = [20200229, 20210229, 20001231, 19000229, 20211231, 20210431, 20211301, 20210100]
    df = spark.createDataFrame([(d,) for d in days], "DATE int")
    rows = df.select("DATE", day_of_year("DATE").alias("doy"), is_calendar_day("DATE").alias("ok")).collect()
    assert [r.doy for r in rows] == [60, None, 366, None, 365, None, None, None]
    assert [r.ok for r in rows] == [r.doy is not None for r in rows]


def line(station="USC00000001", lat="40.1", lon="-100.5", elevation="123.4", state="CO", name="PLACE"):
    return f"{station:11s} {lat:>8s} {lon:>9s} {elevation:>6s} {state:2s} {name:30s}"


def test_fixed_width_lines(spark):
    lines = [
        line(),
        line("USC00000002", elevation=""),
        line("CAC00000003"),
        line("USC00000004", state="PR"),
        line("USC00000005")[:69],
        line("USC00000006", state="MD"),
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = {r.STATION_ID: r for r in prep.parse_stations_fixed_width(df).collect()}
    assert set(rows) == {"USC00000001", "USC00000002", "USC00000006"}
    first = rows["USC00000001"]
    assert (first.LATITUDE, first.LONGITUDE, first.ELEVATION) == (40.1, -100.5, 123.4)
    assert (first.STATE, first.NAME, first.REGION) == ("CO", "PLACE", "West")
    assert rows["USC00000002"].ELEVATION == 0.0
    assert rows["USC00000006"].REGION == "Northeast"


def test_region_replaces_an_incoming_one_and_keeps_unknown_states(spark):
    stations = spark.createDataFrame(
        [("A", "MD", "x"), ("B", "PR", "y"), ("C", None, "z")],
        "STATION_ID string, STATE string, REGION string",
    )
    found = {r.STATION_ID: r.REGION for r in joins.map_state_to_region(stations).collect()}
    assert found == {"A": "Southeast", "B": None, "C": None}
    obs = observation_rows(spark, [(s, 20200101, "PRCP", 1.0) for s in "ABCD"])
    for name in ("STATION_ID", "station_id", "STATION"):
        renamed = stations.withColumnRenamed("STATION_ID", name)
        rows = {r.STATION: r.REGION for r in joins.attach_region(obs, renamed).collect()}
        assert rows == {"A": "Southeast", "B": None, "C": None, "D": None}


def test_salted_lookup_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    table = spark.createDataFrame([("hot", 1), ("1", 2)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.salted_lookup(rows, table, ["k"])
        assert joined.count() == 5000
        assert joined.filter("v = 1").count() == 1667
        assert joins.salted_lookup(rows, table, ["k"], "inner").count() == 1668
        assert joins.salted_lookup(rows, table, ["k"], "left_semi").count() == 1668
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_elevation_limits(spark):
    df = spark.createDataFrame([(499.9,), (500.0,), (1499.9,), (1500.0,), (None,)], "ELEVATION double")
    labels = [r.elev_band for r in elevation_bands(df).orderBy("ELEVATION").collect()]
    assert labels == ["Low (<500m)", "Mid (500-1500m)", "Mid (500-1500m)", "High (>1500m)"]


def test_cleaning(spark):
    raw = spark.createDataFrame(
        [
            ("A", 20200101, "TMAX", 255, None),
            ("A", 20200101, "SNWD", 255, None),
            ("A", 20200101, "PRCP", None, None),
            ("A", 20200101, "TMIN", 10, "I"),
            ("A", 20200101, "WT01", 1, None),
        ],
        "STATION string, DATE int, ELEMENT string, VALUE int, QFLAG string",
    )
    found = {r.ELEMENT: r.VALUE for r in prep.clean_observations(raw).collect()}
    assert found == {"TMAX": 25.5, "SNWD": 255.0, "PRCP": None}


def test_quality_counts(spark):
    rows = [
        ("A", 20200101, "TMAX", 61.0), ("A", 20200101, "TMAX", 60.0), ("A", 20200101, "TMAX", 61.0),
        ("A", 20200102, "TMIN", -71.0), ("A", 20200102, "PRCP", -1.0), ("A", 20200102, "PRCP", None),
        ("B", 20200102, "PRCP", 1.0), ("B", 19990163, "PRCP", 1.0), ("B", -5, "PRCP", 1.0),
        ("B", -5, "PRCP", 1.0),
    ]
    obs = observation_rows(spark, rows)
    found = {r.issue: r.n for r in quality.validate_quality(obs).collect()}
    assert found == {
        "extreme_high_temperature": 2,
        "extreme_low_temperature": 1,
        "negative_precipitation": 1,
        "null_value": 1,
        "duplicate_keys": 4,
        "invalid_date": 3,
    }
    assert quality.count_distinct_keys(obs).first()["keys"] == 6
    assert quality.validate_quality(obs.filter("STATION = 'C'")).count() == 0


def test_missing_element_and_empty_input(spark):
    obs = observation_rows(spark, [("A", 20200101, "TMAX", 1.0), ("B", 20200101, "PRCP", 1.0)])
    rows = {r.ELEMENT: r for r in quality.coverage_key_elements(obs).collect()}
    assert rows["AWND"].records == 0 and rows["AWND"].pct_stations == 0.0
    assert rows["TMAX"].pct_records == 50.0 and rows["TMAX"].stations == 1
    empty = obs.filter("STATION = 'C'")
    assert [r.records for r in quality.coverage_key_elements(empty).collect()] == [0] * 5
    overall = quality.coverage_overall(empty).first()
    assert (overall.total_records, overall.total_stations, overall.min_year) == (0, 0, None)


@pytest.mark.parametrize(("n", "k"), [(53, 47), (10, 10), (5, 9), (9, 1), (1, 1), (100, 7), (7, 2)])
def test_even_spacing_equals_linspace(spark, n, k):
    rows = [(f"S{i:03d}", float((i * 37) % n // 2), "West") for i in range(n)]
    stations = spark.createDataFrame(rows, "STATION_ID string, ELEVATION double, REGION string")
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    expected = (
        rows if n <= k else [ordered[i] for i in np.linspace(0, n - 1, k, dtype=int)]
    )
    found = sampling.even_spaced_sample(stations, {"West": k}).collect()
    assert sorted(r.STATION_ID for r in found) == sorted(r[0] for r in expected)


def test_positions_of_a_group_that_spans_partitions(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("REGION"),
        F.lit(1.0).alias("ELEVATION"),
        F.format_string("S%05d", "id").alias("STATION_ID"),
    )
    numbered = sampling.numbered_within(df, "REGION", ["ELEVATION", "STATION_ID"]).toPandas()
    for _, part in numbered.groupby("REGION"):
        part = part.sort_values("STATION_ID")
        assert part.position.tolist() == list(range(len(part)))
        assert (part.group_size == len(part)).all()


def test_copies_are_numbered_over_several_tasks(spark):
    df = spark.range(4000, numPartitions=16).select(
        F.lit("West").alias("REGION"), F.lit(1.0).alias("ELEVATION"), F.lit("S").alias("STATION_ID")
    )
    numbered = sampling.numbered_within(df, "REGION", ["ELEVATION", "STATION_ID"])
    assert sorted(r.position for r in numbered.collect()) == list(range(4000))
    assert sampling.even_spaced_sample(df, {"West": 10}).count() == 10


def test_rows_of_a_hot_key_get_several_salts(spark):
    rows = spark.range(1000, numPartitions=8).select(F.lit("A").alias("k"), F.col("id").alias("DATE"))
    table = spark.createDataFrame([("A", "x")], "k string, w string")
    joined = joins.salted_lookup(rows, table.withColumn("seen", F.lit(1)), ["k"], salts=8)
    assert joined.count() == 1000 and joined.filter("w = 'x'").count() == 1000


def test_station_sample_keeps_whole_stations(spark):
    obs = observation_rows(spark, [(f"S{i}", 20200101 + d, "PRCP", 1.0) for i in range(60) for d in range(3)])
    kept = sampling.sample_observations(obs, 0.5)
    sizes = {r["count"] for r in kept.groupBy("STATION").count().collect()}
    assert sizes == {3} and 0 < kept.count() < obs.count()
    assert sampling.sample_observations(obs, 1.0) is obs
    ids = spark.range(1_000_000).select(F.format_string("S%07d", "id").alias("STATION"))
    assert 1 <= sampling.sample_observations(ids, 1e-5).count() <= 30
    with pytest.raises(ValueError):
        sampling.sample_observations(obs, 0.5, unit="day")


def test_merge_inserts_overwrites_and_folds_repeated_keys(spark):
    target = spark.createDataFrame(
        [("A", 1.0, "old"), ("B", 2.0, "old"), ("E", None, "old")], "k string, v double, note string"
    )
    updates = spark.createDataFrame(
        [("B", 20.0, "new", 1), ("C", 30.0, "first", 1), ("C", 31.0, "second", 2), ("D", None, "x", 1),
         ("A", None, "gone", 1)],
        "k string, v double, note string, seq int",
    )
    merged = keyed_merge(target, updates, ["k"], ["v"], ["seq"])
    assert merged.columns == target.columns
    assert sorted(map(tuple, merged.collect())) == [
        ("A", None, "old"), ("B", 20.0, "old"), ("C", 31.0, "first"), ("D", None, "x"),
        ("E", None, "old"),
    ]


def test_rows_of_equal_arrival_merge_repeatably(spark):
    target = spark.createDataFrame([], "k string, x int, y int")
    updates = [("A", 1, 5, 1), ("A", 2, 6, 1)]
    for rows in (updates, updates[::-1]):
        df = spark.createDataFrame(rows, "k string, x int, y int, seq int")
        assert tuple(keyed_merge(target, df, ["k"], ["x"], ["seq"]).first()) == ("A", 2, 5)


def test_a_quota_of_zero_takes_no_station(spark):
    rows = [(f"S{i}", float(i), r) for r in ("Northeast", "West") for i in range(5)]
    stations = spark.createDataFrame(rows, "STATION_ID string, ELEVATION double, REGION string")
    found = sampling.even_spaced_sample(stations, {"Northeast": 0, "West": 2}).collect()
    assert [(r.REGION, r.STATION_ID) for r in found] in (
        [("West", "S0"), ("West", "S4")], [("West", "S4"), ("West", "S0")],
    )


def test_invalid_dates_and_missing_keys_are_counted(spark):
    obs = spark.createDataFrame(
        [("A", 20230229, "TMAX", 1.0), ("A", 20240229, "TMAX", 1.0), ("A", 20241301, "PRCP", 1.0),
         (None, 20240101, "PRCP", 1.0), ("A", None, "PRCP", 1.0), ("A", 20240102, None, 1.0)],
        "STATION string, DATE int, ELEMENT string, VALUE double",
    )
    found = {r.issue: r.n for r in quality.validate_quality(obs).collect()}
    assert found == {"invalid_date": 2, "missing_key": 3}


def test_merge_without_an_order_keeps_keys_unique(spark):
    target = spark.createDataFrame([("A", 1.0)], "k string, v double")
    updates = spark.createDataFrame([("A", 3.0), ("A", 2.0), ("B", 5.0), ("B", 4.0)], "k string, v double")
    merged = keyed_merge(target, updates, ["k"], ["v"])
    assert sorted(map(tuple, merged.collect())) == [("A", 3.0), ("B", 5.0)]
