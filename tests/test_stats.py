import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlab.functions import stats
from stationlab.operators import seasons
from stationlab.operators.thresholds import percentile_by_group, threshold_join


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "x double, y double")


def test_correlation_of_a_constant_column_is_null(spark):
    row = one(stats.pearson_corr(pairs(spark, [(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)]), "x", "y"))
    assert row.correlation is None and row.n == 3


def test_correlation_of_one_pair_and_of_none_is_null(spark):
    assert one(stats.pearson_corr(pairs(spark, [(1.0, 2.0)]), "x", "y")).correlation is None
    empty = one(stats.pearson_corr(pairs(spark, []), "x", "y"))
    assert empty.correlation is None and empty.n == 0


def test_correlation_uses_complete_pairs_only(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (None, 9.0), (100.0, None), (4.0, 4.0)]
    row = one(stats.corr_significance(pairs(spark, rows), "x", "y"))
    xs, ys = np.array([1, 2, 3, 4.0]), np.array([2, 1, 5, 4.0])
    r = np.corrcoef(xs, ys)[0, 1]
    assert row.n == 4
    assert row.r == pytest.approx(r)
    assert row.t_stat == pytest.approx(r * math.sqrt(2 / (1 - r * r)))
    assert not row.significant_05


def test_perfect_and_short_correlations(spark):
    row = one(stats.corr_significance(pairs(spark, [(1.0, 1.0), (2.0, 2.0), (4.0, 4.0)]), "x", "y"))
    assert row.t_stat == math.inf and row.significant_01
    row = one(stats.corr_significance(pairs(spark, [(1.0, 1.0), (2.0, 2.0)]), "x", "y"))
    assert (row.r, row.n, row.t_stat, row.significant_05) == (None, 2, None, False)


def test_rate_without_cases_is_null(spark):
    df = pairs(spark, [(1.0, 1.0), (-2.0, 1.0)])
    row = one(stats.conditional_rate(df, F.col("y") > 0, F.col("x") > 5))
    assert (row.cases, row.hits, row.rate) == (0, 0, None)
    row = one(stats.conditional_rate(df, F.col("y") > 0, F.col("x") < 0))
    assert (row.cases, row.hits, row.rate) == (1, 1, 100.0)


def test_effect_size_with_and_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 7.0)], "g string, v double")
    row = one(stats.effect_size(df, "v", F.col("g") == "b", F.col("g") == "a"))
    assert row.effect_size == pytest.approx(4.0 / math.sqrt(2.0))
    flat = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 5.0), ("b", 5.0)], "g string, v double")
    assert one(stats.effect_size(flat, "v", F.col("g") == "b", F.col("g") == "a")).effect_size is None


def test_baseline_gates(spark):
    rows = [("A", y, float(y % 3)) for y in range(5)]
    rows += [("B", y, 1.0) for y in range(5)] + [("C", y, float(y)) for y in range(4)]
    df = spark.createDataFrame(rows, "STATION string, year int, v double")
    kept = seasons.standardized_anomaly(df, "v").select("STATION").distinct().collect()
    assert [r.STATION for r in kept] == ["A"]
    assert {r.STATION for r in seasons.with_baseline(df, "v").collect()} == {"A", "B"}


def test_trend_of_a_single_year_is_null(spark):
    df = spark.createDataFrame(
        [("A", 2000, 5.0), ("B", 2000, 1.0), ("B", 2002, 5.0)], "STATION string, year int, v double"
    )
    rows = {r.STATION: r for r in seasons.linear_trend(df, "v").collect()}
    assert rows["A"].slope is None
    assert rows["B"].slope == pytest.approx(2.0)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 0.95, 1.0])
def test_percentile_equals_numpy_on_skewed_groups(spark, p):
    """One group has nearly all rows, others one row, ties only, negatives, NULLs only."""
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.normal(0, 40, 20_000),
        "one": np.array([4.25]),
        "two": np.array([1.0, 2.0]),
        "ties": np.array([7.0] * 9 + [8.0]),
        "negative": -rng.exponential(1, 300),
        "tiny": rng.uniform(0, 1e-3, 100),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    rows += [("hot", None), ("nothing", None), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: r.threshold for r in percentile_by_group(df, ["g"], "v", p).collect()}
    assert set(found) == set(groups)
    for group, values in groups.items():
        assert found[group] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_weighted_percentile_equals_repeated_rows(spark):
    df = spark.createDataFrame([("g", 1.0, 3), ("g", 2.0, 1), ("g", 9.0, 4)], "g string, v double, n int")
    row = one(percentile_by_group(df, ["g"], "v", 0.4, weight=F.col("n")))
    assert row.threshold == pytest.approx(np.quantile([1, 1, 1, 2, 9, 9, 9, 9], 0.4))


def test_value_equal_to_the_threshold_is_not_above_it(spark):
    df = spark.createDataFrame([("A", 5.0), ("A", 5.0), ("A", 5.0), ("A", 6.0)], "STATION string, VALUE double")
    flags = sorted((r.VALUE, r.is_extreme) for r in threshold_join(df, "VALUE", 0.5).collect())
    assert flags == [(5.0, False)] * 3 + [(6.0, True)]


def test_nan_readings_are_unknown(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 2.0)], "g string, v double")
    assert one(percentile_by_group(df, ["g"], "v", 0.95)).threshold == pytest.approx(1.95)
