"""Row-order operators over daily tables.

All of them work on day grain: one row per station and date. The aggregation that gets there
is combined before the shuffle, so a station's window holds its calendar days and nothing
else, however many readings it had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stationlab.functions.dates import day_number
from stationlab.operators.thresholds import keyed


def pivot_wide(
    obs: DataFrame,
    elements: Sequence[str] = ("TMAX", "TMIN", "AWND"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per station and date with a column per element, where all rows are present.

    Presence counts rows, so a NULL reading keeps its day. Repeated readings of a day give
    their maximum. `keep` names further columns that the date decides, such as the season."""
    kept = obs.filter(F.col("ELEMENT").isin(*elements))
    is_element = {e: F.col("ELEMENT") == e for e in elements}
    values = [F.max(F.when(is_element[e], F.col("VALUE"))).alias(e) for e in elements]
    present = [F.max(is_element[e]).alias(f"_has_{e}") for e in elements]
    wide = kept.groupBy("STATION", "DATE", *keep).agg(*values, *present)
    complete = F.lit(True)
    for element in elements:
        complete = complete & F.col(f"_has_{element}")
    return wide.filter(complete).select("STATION", "DATE", *keep, *elements)


def lag_lead_columns(value: str, n: int, window: WindowSpec) -> dict[str, Column]:
    columns = {f"{value}_lag_{i}": F.lag(value, i).over(window) for i in range(1, n + 1)}
    columns |= {f"{value}_lead_{i}": F.lead(value, i).over(window) for i in range(1, n + 1)}
    return columns


def before_after_columns(
    value: str, n: int, window: WindowSpec, before: str, after: str
) -> dict[str, Column]:
    """Means of the n rows before and after; NULL unless all n are there and known."""

    def mean(start: int, end: int) -> Column:
        frame = window.rowsBetween(start, end)
        total, known = F.sum(value).over(frame), F.count(value).over(frame)
        return F.when(known == n, total / F.lit(float(n)))

    return {before: mean(-n, -1), after: mean(1, n)}


def by_station_date(by: Sequence[str] = ("STATION",)) -> WindowSpec:
    return Window.partitionBy(*by).orderBy("DATE")


CALENDAR = "_day_number"


def with_calendar(daily: DataFrame) -> DataFrame:
    return daily.withColumn(CALENDAR, day_number("DATE"))


def calendar_window(by: Sequence[str] = ("STATION",)) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(CALENDAR)


def calendar_day(value: str, days: int, window: WindowSpec) -> Column:
    """The value so many days later (before, if negative), NULL where that day has no row."""
    return F.max(value).over(window.rangeBetween(days, days))


def lag_lead_features(
    daily: DataFrame,
    value: str,
    n: int = 7,
    by: Sequence[str] = ("STATION",),
    calendar: bool = False,
) -> DataFrame:
    """Values of the n previous and n next rows of the station, as columns.

    With `calendar`, values of the n previous and next days: a day without a row is NULL, and so is
    all around a date that is no calendar day. `daily` has one row per station and date."""
    if calendar:
        window = calendar_window(by)
        known = F.col(CALENDAR).isNotNull()
        columns = {
            f"{value}_{side}_{i}": F.when(known, calendar_day(value, sign * i, window))
            for side, sign in (("lag", -1), ("lead", 1))
            for i in range(1, n + 1)
        }
        return with_calendar(daily).withColumns(columns).drop(CALENDAR)
    return daily.withColumns(lag_lead_columns(value, n, by_station_date(by)))


def before_after_window(
    daily: DataFrame,
    value: str,
    n: int = 7,
    by: Sequence[str] = ("STATION",),
    calendar: bool = False,
    min_days: int | None = None,
) -> DataFrame:
    """Means over the n previous and the n next rows, and the change between them.

    With `calendar`, over the known values of the n days before and after, NULL where fewer than
    `min_days` (all, if not given) are known."""
    if calendar:
        window, need = calendar_window(by), n if min_days is None else min_days

        def mean(start: int, end: int) -> Column:
            frame = window.rangeBetween(start, end)
            enough = F.col(CALENDAR).isNotNull() & (F.count(value).over(frame) >= need)
            return F.when(enough, F.avg(value).over(frame))

        daily = with_calendar(daily)
        columns = {"avg_before": mean(-n, -1), "avg_after": mean(1, n)}
    else:
        columns = before_after_columns(value, n, by_station_date(by), "avg_before", "avg_after")
    return (
        daily.withColumns(columns)
        .withColumn("change", F.col("avg_after") - F.col("avg_before"))
        .drop(CALENDAR)
    )


def extreme_days(
    obs: DataFrame, p: float, by: Sequence[str] = ("STATION",), threshold: str = "heat_threshold"
) -> DataFrame:
    """Day grain of readings against their station's percentile.

    Input rows are (STATION, DATE, VALUE, year). Output has one row per station and date:
    n_readings, n_extreme (strictly above the threshold), their sum and peak, and the sum,
    count and maximum of all known readings. NULL and NaN readings are unknown.

    Equal readings of a day are counted first, which Spark combines before the shuffle. What is
    left of a station is bounded by its calendar days and the steps of its instrument, so the
    percentile is a window over the station, and all that follows stays where the station is."""
    reading = F.when(~F.isnan(F.col("VALUE").cast("double")), F.col("VALUE"))
    readings = (
        keyed(obs, ["STATION", "year"])
        .groupBy("STATION", "year", "DATE", reading.alias("VALUE"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n, value = F.col("n"), F.col("VALUE")
    limit = F.percentile(value, F.lit(float(p)), n).over(Window.partitionBy(*by))
    extreme = value > F.col(threshold)
    return (
        readings.withColumn(threshold, limit)
        .groupBy("STATION", "year", "DATE")
        .agg(
            F.max(threshold).alias(threshold),
            F.sum(n).alias("n_readings"),
            F.coalesce(F.sum(F.when(extreme, n)), F.lit(0)).alias("n_extreme"),
            F.sum(F.when(extreme, value * n)).alias("sum_extreme"),
            F.sum(value * n).alias("sum_value"),
            F.sum(F.when(value.isNotNull(), n)).alias("n_known"),
            F.max(value).alias("max_value"),
        )
    )


def mark_runs(
    days: DataFrame, by: Sequence[str] = ("STATION", "year"), calendar: bool = False
) -> DataFrame:
    """Numbers the runs of consecutive extreme readings in date order.

    Within a day the readings below the threshold come first, so a day with one of them starts
    a new run, and a run is the extreme readings from there up to the next such day. With
    `calendar`, a day that does not follow on the one before starts a new run too. Adds run_id and
    run_length (extreme readings in the run)."""
    ordered = Window.partitionBy(*by).orderBy("DATE")
    broken = F.col("n_readings") > F.col("n_extreme")
    if calendar:
        days = with_calendar(days)
        days = days.withColumn("_gap", F.col(CALENDAR) - F.lag(CALENDAR).over(ordered))
        broken = broken | ~F.coalesce(F.col("_gap") == 1, F.lit(False))
    run = Window.partitionBy(*by, "run_id")
    return (
        days.withColumn(
            "run_id",
            F.sum(broken.cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn("run_length", F.sum("n_extreme").over(run))
        .drop(CALENDAR, "_gap")
    )


def heat_wave_flags(
    obs: DataFrame, percentile: float = 0.95, min_run: int = 3, calendar: bool = False
) -> DataFrame:
    """Days of (STATION, DATE, VALUE, year) readings with is_extreme and is_heat_wave_day.

    A day is a heat-wave day when its extreme readings lie in a run of at least `min_run`
    consecutive extreme rows of the station-year. Missing neighbours never count as extreme. With
    `calendar`, missing days end a run."""
    return mark_runs(extreme_days(obs, percentile), calendar=calendar).withColumns(
        {
            "is_extreme": F.col("n_extreme") > 0,
            "is_heat_wave_day": (F.col("n_extreme") > 0) & (F.col("run_length") >= min_run),
        }
    )


def run_lengths(
    obs: DataFrame, percentile: float = 0.95, min_run: int = 3, calendar: bool = False
) -> DataFrame:
    """Runs of at least `min_run` extreme rows, with start, end, length and peak. With `calendar`,
    missing days end a run."""
    return (
        mark_runs(extreme_days(obs, percentile), calendar=calendar)
        .filter(F.col("n_extreme") > 0)
        .groupBy("STATION", "year", "run_id")
        .agg(
            F.min("DATE").alias("run_start"),
            F.max("DATE").alias("run_end"),
            F.sum("n_extreme").alias("run_length"),
            F.max("max_value").alias("peak"),
        )
        .filter(F.col("run_length") >= min_run)
        .drop("run_id")
    )
