import random

import numpy as np
import pytest
from observation_tables import observation_rows

from stationlab.functions.dates import derive_date_parts
from stationlab.operators import windows
from stationlab.plans.heat import heat_wave_metrics


def summer(spark, values, station="A", start=20200601):
    """One reading per day from `start`; None skips nothing, it is a NULL reading."""
    return observation_rows(
        spark, [(station, start + i, "TMAX", v) for i, v in enumerate(values)]
    )


def brute_force(rows, p, min_run):
    """(station, date) -> heat-wave day, by walking the sorted rows of each station-year."""
    limits, result = {}, {}
    for station in {r[0] for r in rows}:
        known = [r[3] for r in rows if r[0] == station and r[3] is not None]
        limits[station] = np.quantile(known, p) if known else None
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1] // 10000), []).append(r)
    for (station, _), group in groups.items():
        group.sort(key=lambda r: (r[1], r[3] is not None, r[3]))
        flags = [
            r[3] is not None and limits[station] is not None and r[3] > limits[station]
            for r in group
        ]
        i = 0
        while i < len(group):
            j = i
            while j < len(group) and flags[j]:
                j += 1
            for k in range(i, max(j, i + 1)):
                hot = flags[k] and j - i >= min_run
                key = (station, group[k][1])
                result[key] = result.get(key, False) or hot
            i = max(j, i + 1)
    return result


# Threshold 0.5 over these values lies between 10 and 30.
@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([10, 30, 30, 10, 10, 10], []),
        ([10, 30, 30, 30, 10, 10, 10], [1, 2, 3]),
        ([30, 30, 30, 30, 10, 10, 10, 10, 10], [0, 1, 2, 3]),
        ([10, 10, 10, 10, 10, 30, 30, 30], [5, 6, 7]),
        ([10, 10, 10, 10, 30, 30, None, 30], []),
    ],
)
def test_runs_of_two_three_and_four(spark, values, expected):
    df = summer(spark, [None if v is None else float(v) for v in values])
    found = windows.heat_wave_flags(df, 0.5).filter("is_heat_wave_day").collect()
    assert sorted(r.DATE - 20200601 for r in found) == expected


def test_a_missing_day_does_not_break_a_run(spark):
    df = summer(spark, [10.0] * 6 + [30.0] * 4).filter("DATE <> 20200608")
    found = windows.heat_wave_flags(df, 0.5).filter("is_heat_wave_day").collect()
    assert sorted(r.DATE for r in found) == [20200607, 20200609, 20200610]


def test_a_run_ends_with_the_year(spark):
    rows = [("A", 20191229 + i, "TMAX", v) for i, v in enumerate([10.0, 30.0, 30.0])]
    rows += [("A", 20200101 + i, "TMAX", v) for i, v in enumerate([30.0, 10.0, 10.0, 10.0])]
    assert windows.run_lengths(observation_rows(spark, rows), 0.5).count() == 0


def test_flags_and_runs_equal_brute_force_with_duplicates(spark):
    rng = random.Random(5)
    rows = []
    for station in "ABC":
        for year in (2019, 2020):
            for day in range(1, 31):
                for _ in range(rng.choice([0, 1, 1, 1, 2, 3])):
                    value = rng.choice([None, 10.0, 20.0, 30.0, 31.0, 32.0, 33.0])
                    rows.append((station, year * 10000 + 600 + day, "TMAX", value))
    rows += [("D", 20200601, "TMAX", None)]
    df = observation_rows(spark, rows)
    flags = windows.heat_wave_flags(df, 0.6)
    found = {(r.STATION, r.DATE): r.is_heat_wave_day for r in flags.collect()}
    assert found == brute_force(rows, 0.6, 3)
    runs = windows.run_lengths(df, 0.6).collect()
    metrics = heat_wave_metrics(flags).collect()
    assert sum(r.run_length for r in runs) == sum(m.heat_wave_days for m in metrics)
    assert sum(m.summer_days for m in metrics) == len(rows)


def daily(spark, values):
    df = spark.createDataFrame(
        [("A", 20200101 + i, float(v)) for i, v in enumerate(values)],
        "STATION string, DATE int, temp_range double",
    )
    return derive_date_parts(df)


def test_frames_need_all_seven_rows(spark):
    rows = {
        r.DATE - 20200101: r
        for r in windows.before_after_window(daily(spark, range(15)), "temp_range").collect()
    }
    assert rows[6].avg_before is None and rows[6].avg_after == pytest.approx(10.0)
    assert rows[7].avg_before == pytest.approx(3.0) and rows[7].avg_after == pytest.approx(11.0)
    assert rows[7].change == pytest.approx(8.0)
    assert rows[8].avg_after is None


def test_lag_and_lead_columns(spark):
    rows = windows.lag_lead_features(daily(spark, [5, 6, 7]), "temp_range", 2).orderBy("DATE").collect()
    assert [r.temp_range_lag_1 for r in rows] == [None, 5.0, 6.0]
    assert [r.temp_range_lead_2 for r in rows] == [7.0, None, None]


def test_pivot_needs_all_elements_and_folds_duplicates(spark):
    rows = [
        ("A", 20200101, "TMAX", 9.0), ("A", 20200101, "TMIN", 1.0), ("A", 20200101, "AWND", 3.0),
        ("A", 20200101, "TMAX", 11.0),
        ("A", 20200102, "TMAX", 9.0), ("A", 20200102, "TMIN", 1.0),
        ("A", 20200103, "TMAX", None), ("A", 20200103, "TMIN", 1.0), ("A", 20200103, "AWND", 2.0),
    ]
    found = windows.pivot_wide(observation_rows(spark, rows)).orderBy("DATE").collect()
    assert [tuple(r) for r in found] == [
        ("A", 20200101, 11.0, 1.0, 3.0),
        ("A", 20200103, None, 1.0, 2.0),
    ]
