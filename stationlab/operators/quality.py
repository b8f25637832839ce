"""Coverage, validation and profile reports.

Every report starts with one aggregation that is combined before the shuffle and finishes on
station-sized or smaller tables. Exact counts of distinct days use bit masks: 64 dates share
one group and one long, so the shuffle carries a small fraction of the rows and no station can
overload a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stationlab.functions.dates import is_calendar_day, year_of
from stationlab.operators.joins import station_regions
from stationlab.schemas import ELEMENTS, KEY_ELEMENTS, REGIONS


def _rows() -> Column:
    return F.count(F.lit(1))


def _long_form(one_row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """One row per named column. Only for tables of a few rows."""
    return one_row.unpivot([], list(names), key, value)


def coverage_overall(obs: DataFrame) -> DataFrame:
    """Rows, stations and the first and last year, as one row."""
    return (
        obs.groupBy("STATION")
        .agg(_rows().alias("n"), F.min("year").alias("first"), F.max("year").alias("last"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
            F.count("STATION").alias("total_stations"),
            F.min("first").alias("min_year"),
            F.max("last").alias("max_year"),
        )
    )


def coverage_by_element(obs: DataFrame) -> DataFrame:
    """Rows of each element and their share of all rows, most frequent first."""
    everything = Window.partitionBy(F.lit(0))  # one row per element by then
    return (
        obs.groupBy("ELEMENT")
        .agg(_rows().alias("records"))
        .withColumn("share", F.col("records") / F.sum("records").over(everything))
        .orderBy(F.desc("records"), "ELEMENT")
    )


def coverage_key_elements(
    obs: DataFrame, elements: Sequence[str] = tuple(KEY_ELEMENTS)
) -> DataFrame:
    """Rows and stations of each listed element, with their shares in percent.

    An element that never occurs is reported with zeros."""
    per_station = obs.groupBy("STATION").agg(
        _rows().alias("n"), *[F.count_if(F.col("ELEMENT") == e).alias(e) for e in elements]
    )
    total, stations = F.coalesce(F.sum("n"), F.lit(0)), _rows()
    figures = [
        F.struct(
            F.lit(e).alias("ELEMENT"),
            F.coalesce(F.sum(e), F.lit(0)).alias("records"),
            F.coalesce(F.try_divide(F.sum(e) * 100.0, total), F.lit(0.0)).alias("pct_records"),
            F.count_if(F.col(e) > 0).alias("stations"),
            F.coalesce(
                F.try_divide(F.count_if(F.col(e) > 0) * 100.0, stations), F.lit(0.0)
            ).alias("pct_stations"),
        )
        for e in elements
    ]
    return per_station.agg(F.array(*figures).alias("figures")).select(F.inline("figures"))


def _date_mask(date: str = "DATE") -> tuple[Column, Column]:
    """(group, bit mask): the 64-date block of an integer date and its bit in that block."""
    return (
        F.expr(f"`{date}` div 64"),
        F.expr(f"bit_or(shiftleft(1L, cast(pmod(`{date}`, 64) as int)))"),
    )


def _distinct_dates(mask: str) -> Column:
    """Dates in a block; the block of NULL dates counts as one."""
    return F.coalesce(F.bit_count(mask), F.lit(1)).cast("long")


def date_blocks(obs: DataFrame) -> DataFrame:
    """Rows and the mask of dates per station, element and 64-date block. Tables of different rows
    merge: rows add up, masks are joined bit by bit."""
    block, mask = _date_mask()
    return obs.groupBy("STATION", "ELEMENT", block.alias("block")).agg(
        _rows().alias("n"), mask.alias("mask")
    )


def duplicates_of(blocks: DataFrame) -> DataFrame:
    """Rows beyond the first of each key, as one row, from date blocks."""
    extra = F.col("n") - _distinct_dates("mask")
    return blocks.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("duplicate_keys"))


def row_checks(
    max_tmax: float = 60.0, max_tmin: float = 50.0, min_tmax: float = -60.0, min_tmin: float = -70.0
) -> dict[str, Column]:
    """Tests of a single reading, by the name of the issue."""
    element, value = F.col("ELEMENT"), F.col("VALUE")
    is_tmax, is_tmin = element == "TMAX", element == "TMIN"
    return {
        "extreme_high_temperature": (is_tmax & (value > max_tmax))
        | (is_tmin & (value > max_tmin)),
        "extreme_low_temperature": (is_tmax & (value < min_tmax))
        | (is_tmin & (value < min_tmin)),
        "negative_precipitation": (element == "PRCP") & (value < 0),
        "null_value": value.isNull(),
        "invalid_date": F.col("DATE").isNotNull()
        & ~F.coalesce(is_calendar_day("DATE"), F.lit(False)),
        "missing_key": F.col("STATION").isNull() | F.col("DATE").isNull() | element.isNull(),
    }


class RowCounts:
    """Counts taken while readings pass by on their way to somewhere else, with `DataFrame.observe`.

    `watch` returns the readings to be written; once they are, `issues` and `coverage` give what
    `validate_quality` (but for duplicate keys, which need rows brought together) and
    `coverage_by_element` give, without another read."""

    def __init__(self, elements: Sequence[str] = tuple(ELEMENTS), **limits: float):
        self.observation = Observation()
        self.checks = row_checks(**limits)
        self.elements = list(elements)

    def watch(self, obs: DataFrame) -> DataFrame:
        counts = [F.count_if(test).alias(f"issue_{name}") for name, test in self.checks.items()]
        counts += [F.count_if(F.col("ELEMENT") == e).alias(f"element_{e}") for e in self.elements]
        return obs.observe(
            self.observation,
            _rows().alias("records"),
            F.min(year_of("DATE")).alias("min_year"),
            F.max(year_of("DATE")).alias("max_year"),
            *counts,
        )

    def figures(self) -> dict[str, int]:
        """All counts; waits for the first action on the watched readings."""
        return self.observation.get

    def issues(self, spark: SparkSession) -> DataFrame:
        found = [(name, self.figures()[f"issue_{name}"]) for name in self.checks]
        return spark.createDataFrame([r for r in found if r[1]], "issue string, n long")

    def coverage(self, spark: SparkSession) -> DataFrame:
        figures = self.figures()
        total = figures["records"]
        rows = [(e, figures[f"element_{e}"]) for e in self.elements]
        found = [(e, n, n / total) for e, n in sorted(rows, key=lambda r: (-r[1], r[0])) if n]
        return spark.createDataFrame(found, "ELEMENT string, records long, share double")


def validate_quality(
    obs: DataFrame,
    max_tmax: float = 60.0,
    max_tmin: float = 50.0,
    min_tmax: float = -60.0,
    min_tmin: float = -70.0,
) -> DataFrame:
    """Issues found and how many rows each concerns; checks without hits are left out.

    Duplicates are rows beyond the first of each (STATION, DATE, ELEMENT). A date is invalid if it
    is no calendar day; a key is missing if one of its three parts is."""
    checks = row_checks(max_tmax, max_tmin, min_tmax, min_tmin)
    block, mask = _date_mask()
    per_block = obs.groupBy("STATION", "ELEMENT", block.alias("_block")).agg(
        _rows().alias("_rows"),
        mask.alias("_mask"),
        *[F.count_if(test).alias(name) for name, test in checks.items()],
    )
    totals = per_block.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks],
        F.coalesce(F.sum(F.col("_rows") - _distinct_dates("_mask")), F.lit(0)).alias(
            "duplicate_keys"
        ),
    )
    return _long_form(totals, [*checks, "duplicate_keys"], "issue", "n").filter("n > 0")


def count_distinct_keys(obs: DataFrame) -> DataFrame:
    """Distinct stations, elements and (STATION, DATE, ELEMENT) keys, as one row."""
    block, mask = _date_mask()
    return (
        obs.groupBy("STATION", "ELEMENT", block.alias("_block"))
        .agg(mask.alias("_mask"))
        .groupBy("STATION", "ELEMENT")
        .agg(F.sum(_distinct_dates("_mask")).alias("keys"))
        .agg(
            F.count_distinct("STATION").alias("stations"),
            F.count_distinct("ELEMENT").alias("elements"),
            F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"),
        )
    )


def dataset_profile(obs: DataFrame) -> DataFrame:
    """Long-form profile (section, key, value): overall figures, rows per element and year.

    The readings are read once. Their counts per station, element and year are summed by
    station, by element and by year together, and the stations are then summed up."""
    return profile_of(profile_cube(obs))


def profile_cube(obs: DataFrame) -> DataFrame:
    """Rows and first and last date per station, element and year. Cubes of different rows merge."""
    return obs.groupBy("STATION", "ELEMENT", "year").agg(
        _rows().alias("n"), F.min("DATE").alias("first"), F.max("DATE").alias("last")
    )


def profile_of(cube: DataFrame) -> DataFrame:
    """The profile from a cube."""
    sets = [[F.col("STATION")], [F.col("ELEMENT")], [F.col("year")]]
    section = (
        F.when(F.grouping("ELEMENT") == 0, "element")
        .when(F.grouping("year") == 0, "year")
        .otherwise("overall")
    )
    key = F.coalesce(F.col("ELEMENT"), F.col("year").cast("string"))
    figures = (
        cube.groupingSets(sets, "STATION", "ELEMENT", "year")
        .agg(
            section.alias("section"),
            F.sum("n").alias("n"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .groupBy("section", key.alias("key"))
        .agg(
            F.sum("n").cast("double").alias("n"),
            _rows().cast("double").alias("stations"),
            F.min("first").cast("double").alias("first"),
            F.max("last").cast("double").alias("last"),
        )
        .withColumn(
            "years",
            F.count_if(F.col("section") == "year")
            .over(Window.partitionBy(F.lit(0)))  # one row per element and year by then
            .cast("double"),
        )
    )
    overall = {
        "records": F.col("n"),
        "stations": F.col("stations"),
        "years": F.col("years"),
        "min_date": F.col("first"),
        "max_date": F.col("last"),
        "records_per_station": F.try_divide("n", "stations"),
    }

    def entry(name: Column, value: Column) -> Column:
        return F.struct(name.alias("key"), value.alias("value"))

    entries = F.when(
        F.col("section") == "overall",
        F.array(*[entry(F.lit(name), value) for name, value in overall.items()]),
    ).otherwise(F.array(entry(F.col("key"), F.col("n"))))
    return figures.select("section", F.inline(entries))


def expected_vs_actual(
    obs: DataFrame, days: int = 365, years: int = 25, active: float = 0.6
) -> DataFrame:
    """Rows against stations x days x years x active share, and their ratio in percent."""
    expected = F.col("total_stations") * F.lit(float(days * years)) * F.lit(active)
    return coverage_overall(obs).select(
        expected.alias("expected_records"),
        F.col("total_records").alias("actual_records"),
        F.try_divide(F.col("total_records") * 100.0, expected).alias("ratio_pct"),
    )


def column_coverage(
    df: DataFrame, exclude: Sequence[str] = ("STATION", "DATE", "year")
) -> DataFrame:
    """Percent of known values per column."""
    names = [c for c in df.columns if c not in exclude]
    shares = df.agg(
        *[F.try_divide(F.count(c) * 100.0, _rows()).alias(c) for c in names]
    )
    return _long_form(shares, names, "column_name", "coverage_pct")


def yearly_counts(obs: DataFrame) -> DataFrame:
    return obs.groupBy("year").agg(_rows().alias("records"))


def first_last_years(obs: DataFrame, n: int = 5) -> DataFrame:
    """The first n and the last n years with their rows."""
    years = Window.partitionBy(F.lit(0))  # one row per year by then
    return (
        yearly_counts(obs)
        .withColumns(
            {
                "_first": F.row_number().over(years.orderBy("year")),
                "_last": F.row_number().over(years.orderBy(F.desc("year"))),
            }
        )
        .filter((F.col("_first") <= n) | (F.col("_last") <= n))
        .select("year", "records")
    )


def top_stations(obs: DataFrame, n: int = 10) -> DataFrame:
    """The stations with most rows."""
    return (
        obs.groupBy("STATION")
        .agg(_rows().alias("records"))
        .orderBy(F.desc("records"), "STATION")
        .limit(n)
    )


def station_selection_stats(stations: DataFrame) -> DataFrame:
    """Elevation, latitude and longitude ranges and the number of states."""
    return stations.agg(
        _rows().alias("stations"),
        F.min("ELEVATION").alias("min_elevation"),
        F.max("ELEVATION").alias("max_elevation"),
        F.avg("ELEVATION").alias("mean_elevation"),
        F.min("LATITUDE").alias("min_latitude"),
        F.max("LATITUDE").alias("max_latitude"),
        F.min("LONGITUDE").alias("min_longitude"),
        F.max("LONGITUDE").alias("max_longitude"),
        F.count_distinct("STATE").alias("states"),
    )


def expectation_report(
    obs: DataFrame,
    stations: DataFrame,
    records: tuple[int, int] = (20_000_000, 30_000_000),
    min_stations: int = 4000,
    prcp_pct: float = 80.0,
    years: tuple[int, int] = (2000, 2024),
    regions: Sequence[str] = tuple(REGIONS),
) -> DataFrame:
    """Pass or fail of the dataset's stated expectations, with the observed figure.

    PRCP coverage is the percentage of stations that report it."""
    per_station = (
        obs.groupBy("STATION")
        .agg(
            _rows().alias("n"),
            F.count_if(F.col("ELEMENT") == "PRCP").alias("prcp"),
            F.collect_set(F.when(F.col("year").between(*years), F.col("year"))).alias("years"),
        )
        .join(station_regions(stations), "STATION", "left")
    )
    by_region = per_station.groupBy("REGION").agg(
        F.sum("n").alias("n"),
        _rows().alias("stations"),
        F.count_if(F.col("prcp") > 0).alias("with_prcp"),
        F.array_distinct(F.flatten(F.collect_set("years"))).alias("years"),
    )
    figures = by_region.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("record_count"),
        F.coalesce(F.sum("stations"), F.lit(0)).cast("double").alias("station_count"),
        F.try_divide(F.sum("with_prcp") * 100.0, F.sum("stations")).alias("prcp_coverage_pct"),
        F.size(F.array_distinct(F.flatten(F.collect_list("years"))))
        .cast("double")
        .alias("years_present"),
        F.count_if(F.col("REGION").isin(*regions)).cast("double").alias("regions_present"),
    )
    rules = {
        "record_count": F.col("observed").between(*records),
        "station_count": F.col("observed") >= min_stations,
        "prcp_coverage_pct": F.col("observed") > prcp_pct,
        "years_present": F.col("observed") == years[1] - years[0] + 1,
        "regions_present": F.col("observed") == len(regions),
    }
    passed = F.lit(False)
    for rule, test in rules.items():
        passed = F.when(F.col("rule") == rule, test).otherwise(passed)
    return _long_form(figures, list(rules), "rule", "observed").withColumn(
        "passed", F.coalesce(passed, F.lit(False))
    )


def source_file_profile(df: DataFrame, first: int | None = None) -> DataFrame:
    """Rows and bytes per input file of a file-based table, in file order, with the bytes of all
    files together; `first` keeps the first few files only."""
    files = (
        df.select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        .groupBy("file_name")
        .agg(_rows().alias("records"), F.max("bytes").alias("bytes"))
        .withColumn("total_bytes", F.sum("bytes").over(Window.partitionBy(F.lit(0))))
        .orderBy("file_name")
    )
    return files if first is None else files.limit(first)
