"""Column functions over integer dates of the form YYYYMMDD."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.schemas import SEASONS


def year_of(date: str = "DATE") -> Column:
    return F.expr(f"cast(`{date}` div 10000 as int)")


def month_of(date: str = "DATE") -> Column:
    return F.expr(f"cast((`{date}` % 10000) div 100 as int)")


def day_of(date: str = "DATE") -> Column:
    return F.expr(f"cast(`{date}` % 100 as int)")


def derive_date_parts(df: DataFrame, date: str = "DATE") -> DataFrame:
    """Adds year, month and day, each an int."""
    return df.withColumns({"year": year_of(date), "month": month_of(date), "day": day_of(date)})


def day_of_year(date: str | Column = "DATE") -> Column:
    """Day of the year, NULL where the integer names no calendar day."""
    column = F.col(date) if isinstance(date, str) else date
    return F.dayofyear(F.try_to_date(column.cast("string"), "yyyyMMdd"))


def day_number(date: str = "DATE") -> Column:
    """Days since 1970-01-01, NULL where the integer names no calendar day."""
    parts = [F.expr(f"cast(`{date}` div 10000 as int)"), month_of(date), day_of(date)]
    return F.when(is_calendar_day(date), F.unix_date(F.make_date(*parts)))


def is_calendar_day(date: str = "DATE") -> Column:
    """True where the integer names a day that exists. Plain arithmetic, so that it costs
    nothing per row next to parsing text; most days are decided by being 28 or less."""
    year, month, day = year_of(date), month_of(date), day_of(date)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    length = (
        F.when(month.isin(4, 6, 9, 11), 30)
        .when(month == 2, F.when(leap, 29).otherwise(28))
        .otherwise(31)
    )
    return month.between(1, 12) & (day >= 1) & ((day <= 28) | (day <= length))


def season_filter(df: DataFrame, months: Iterable[int], month: str = "month") -> DataFrame:
    """Rows whose month is in the given set."""
    return df.filter(F.col(month).isin(*months))


def season_name(month: Column) -> Column:
    """Winter, Spring, Summer or Fall."""
    label = None
    for name, months in SEASONS.items():
        test = month.isin(*months)
        label = F.when(test, name) if label is None else label.when(test, name)
    return label
