import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def generated(spark):
    """Eight years of twelve generated stations, computed once."""
    from stationlab.sources.generator import generate_observations

    frame = generate_observations(spark, 12, 8, 2012).cache()
    frame.count()
    return frame


@pytest.fixture(scope="session")
def generated_stations(spark, generated):
    """Metadata of the generated stations: three regions, one unknown state."""
    states = ["TX", "OK", "AZ", "NM", "CA", "NV", "OR", "WA", "ME", "NY", "VT", "PR"]
    rows = [
        (f"USC{i:08d}", 30.0 + i, -100.0 - i, 200.0 * i, state, f"Station {i}")
        for i, state in enumerate(states)
    ]
    return spark.createDataFrame(
        rows,
        "STATION_ID string, LATITUDE double, LONGITUDE double, ELEVATION double,"
        " STATE string, NAME string",
    )
