"""Table schemas and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

OBSERVATION = T.StructType(
    [
        T.StructField("STATION", T.StringType(), False),
        T.StructField("DATE", T.IntegerType(), False),
        T.StructField("ELEMENT", T.StringType(), False),
        T.StructField("VALUE", T.DoubleType(), True),
    ]
)

# As stored in Parquet, partitioned by year.
STORED_OBSERVATION = T.StructType([*OBSERVATION.fields, T.StructField("year", T.IntegerType())])

RAW_DAILY = T.StructType(
    [
        T.StructField("STATION", T.StringType()),
        T.StructField("DATE", T.IntegerType()),
        T.StructField("ELEMENT", T.StringType()),
        T.StructField("VALUE", T.IntegerType()),
        T.StructField("MFLAG", T.StringType()),
        T.StructField("QFLAG", T.StringType()),
        T.StructField("SFLAG", T.StringType()),
        T.StructField("TIME", T.StringType()),
    ]
)

STATION = T.StructType(
    [
        T.StructField("STATION_ID", T.StringType()),
        T.StructField("LATITUDE", T.DoubleType()),
        T.StructField("LONGITUDE", T.DoubleType()),
        T.StructField("ELEVATION", T.DoubleType()),
        T.StructField("STATE", T.StringType()),
        T.StructField("NAME", T.StringType()),
        T.StructField("REGION", T.StringType()),
    ]
)

# Fields of the station text file as (first character, length), 1-based.
STATION_TEXT_FIELDS = {
    "STATION_ID": (1, 11),
    "LATITUDE": (13, 8),
    "LONGITUDE": (22, 9),
    "ELEVATION": (32, 6),
    "STATE": (39, 2),
    "NAME": (42, 30),
}

# The elements kept by cleaning, and those stored in tenths of a unit.
ELEMENTS = ["TMAX", "TMIN", "PRCP", "SNOW", "SNWD", "AWND"]
TENTHS_ELEMENTS = ["TMAX", "TMIN", "PRCP"]
KEY_ELEMENTS = ["TMAX", "TMIN", "PRCP", "AWND", "SNWD"]

# States of each region for the analyses.
REGION_STATES = {
    "Northeast": ["ME", "NH", "VT", "MA", "RI", "CT", "NY", "NJ", "PA"],
    "Southeast": [
        "DE", "MD", "VA", "WV", "NC", "SC", "GA", "FL", "AL", "MS", "LA", "AR", "TN",
        "KY",
    ],
    "Midwest": ["OH", "IN", "IL", "MI", "WI", "MN", "IA", "MO", "ND", "SD", "NE", "KS"],
    "Southwest": ["TX", "OK", "NM", "AZ"],
    "West": ["CA", "NV", "UT", "CO", "WY", "MT", "ID", "OR", "WA"],
    "Alaska": ["AK"],
    "Hawaii": ["HI"],
}
REGIONS = list(REGION_STATES)

# States that station selection counts to another region.
SELECTION_OVERRIDES = {"MD": "Northeast", "DE": "Northeast"}

# Stations wanted per region by the even-spaced selection.
SELECTION_QUOTAS = {
    "Northeast": 770,
    "Southeast": 963,
    "Midwest": 1100,
    "Southwest": 770,
    "West": 1045,
    "Alaska": 426,
    "Hawaii": 426,
}

# Stations per region of the random map sample.
MAP_QUOTAS = {
    "Northeast": 25,
    "Southeast": 35,
    "Midwest": 50,
    "Southwest": 50,
    "West": 50,
    "Alaska": 50,
    "Hawaii": 5,
}

# Months of each season.
SEASONS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
}
EARLY_WINTER = [11, 12]
LATE_WINTER = [2, 3]
SPRING = [3, 4, 5]
SUMMER = [6, 7, 8]
SNOW_SEASON = [1, 2, 3, 4, 5]
LATE_SPRING = [4, 5]

# Elevation band labels, each with its exclusive upper limit in metres.
ELEVATION_BANDS = [("Low (<500m)", 500.0), ("Mid (500-1500m)", 1500.0), ("High (>1500m)", None)]


def state_regions(selection: bool = False) -> list[tuple[str, str]]:
    """(STATE, REGION) pairs; `selection` uses the map of the station selection step."""
    pairs = {s: region for region, states in REGION_STATES.items() for s in states}
    if selection:
        pairs.update(SELECTION_OVERRIDES)
    return sorted(pairs.items())


# Result tables: key columns, the columns an update may overwrite, and the columns that are
# written on first insert only. Fixed values.
RESULT_TABLES = {
    "h1_winter_precipitation": {
        "keys": ["station_id", "year"],
        "update": ["early_winter_prcp", "late_winter_prcp", "early_anomaly", "late_anomaly"],
        "insert_only": ["baseline_early", "baseline_late"],
    },
    "h2_spring_summer_heat": {
        "keys": ["station_id", "year"],
        "update": [
            "spring_avg_tmax",
            "spring_temp_anomaly",
            "heat_wave_days",
            "max_heat_wave_temp",
            "extreme_days",
        ],
        "insert_only": [],
    },
    "h3_wind_moderation": {
        "keys": ["station_id", "event_date"],
        "update": ["awnd", "temp_range", "avg_range_before", "avg_range_after", "range_change"],
        "insert_only": [],
    },
    "h4_snowmelt_precipitation": {
        "keys": ["station_id", "year"],
        "update": ["snowmelt_doy", "melt_anomaly_days", "spring_prcp", "prcp_anomaly_std"],
        "insert_only": ["baseline_melt_doy", "melt_anomaly_std", "baseline_spring_prcp"],
    },
    "analysis_summary": {
        "keys": ["hypothesis", "metric_name"],
        "update": ["metric_value", "sample_size"],
        "insert_only": ["description"],
    },
    "stations": {
        "keys": ["station_id"],
        "update": ["latitude", "longitude", "elevation", "state", "name", "region"],
        "insert_only": [],
    },
    "yearly_trends": {
        "keys": ["year", "metric_name"],
        "update": ["avg_value", "min_value", "max_value", "std_value", "num_stations"],
        "insert_only": [],
    },
    "regional_results": {
        "keys": ["hypothesis", "region"],
        "update": ["correlation", "sample_size", "effect_size", "significant"],
        "insert_only": [],
    },
}
