"""Hand-made observations for the tests."""

from stationlab.functions.dates import derive_date_parts


def observation_rows(spark, rows):
    """Rows of (STATION, DATE, ELEMENT, VALUE) with date parts."""
    return derive_date_parts(
        spark.createDataFrame(rows, "STATION string, DATE int, ELEMENT string, VALUE double")
    )
