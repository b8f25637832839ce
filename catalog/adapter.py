"""The given tables seen as station observations.

Each view exists twice: as a DataFrame for the queries and as DuckDB text for the checks.
Every value is a whole number, so that sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlab.functions.dates import derive_date_parts
from stationlab.operators.joins import map_state_to_region
from stationlab.schemas import ELEMENTS, state_regions

STATES = "ME,NY,PA,DE,MD,FL,TX,OK,NM,AZ,CA,NV,UT,CO,WA,OH,IN,IL,MN,KS,AK,HI,VA,TN,PR"
RAW_ELEMENTS = "TMAX,TMIN,PRCP,SNOW,SNWD,AWND,WT01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def station_id(key: str):
    return F.concat(F.lit("US"), F.lpad(F.col(key).cast("string"), 9, "0"))


def ship_date():
    day = F.col("l_shipdate").cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def percent(column: str):
    """Nearest whole percent of a share that is not negative."""
    return F.floor(F.col(column) * 100 + 0.5).cast("int")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier nation and ship date, with a column per element."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
        F.col("l_suppkey") == F.col("s_suppkey"),
    )
    days = lines.groupBy("s_nationkey", "l_shipdate").agg(
        F.max("l_quantity").cast("double").alias("TMAX"),
        F.min("l_quantity").cast("double").alias("TMIN"),
        F.sum(percent("l_discount")).cast("double").alias("PRCP"),
        F.max(percent("l_tax")).cast("double").alias("SNOW"),
        F.greatest(F.max(percent("l_tax")) - 3, F.lit(0)).cast("double").alias("SNWD"),
        F.floor(F.max("l_extendedprice") / 1000).cast("double").alias("AWND"),
    )
    return days.select(
        station_id("s_nationkey").alias("STATION"), ship_date().alias("DATE"), *ELEMENTS
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table in long form, with date parts."""
    return derive_date_parts(
        daily(spark, sf_dir).unpivot(["STATION", "DATE"], ELEMENTS, "ELEMENT", "VALUE")
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unclean readings with flags, NULLs, negatives, duplicates and an unwanted element."""
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        station_id("l_suppkey").alias("STATION"),
        ship_date().alias("DATE"),
        F.element_at(F.array(*map(F.lit, RAW_ELEMENTS.split(","))), F.col("l_linenumber")).alias(
            "ELEMENT"
        ),
        F.when(F.col("l_orderkey") % 97 == 0, None)
        .when(F.col("l_orderkey") % 89 == 0, -quantity)
        .otherwise(quantity)
        .alias("VALUE"),
        F.lit(None).cast("string").alias("MFLAG"),
        F.when(F.col("l_returnflag") == "R", "I").alias("QFLAG"),
        F.lit("7").alias("SFLAG"),
        F.lit(None).cast("string").alias("TIME"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw readings as lines of their yearly files, some cut, garbled or incomplete."""
    rows = raw(spark, sf_dir).filter("VALUE IS NOT NULL").withColumn("key", (F.col("DATE") % 100 + F.col("VALUE")) % 20)
    empty, day = F.lit(""), F.col("DATE").cast("string")
    fields = [
        F.when(F.col("key") == 3, empty).otherwise(F.col("STATION")),
        F.when(F.col("key") == 5, empty).when(F.col("key") == 6, "x").otherwise(day),
        F.col("ELEMENT"),
        F.when(F.col("key") == 7, empty).otherwise(F.col("VALUE").cast("string")),
    ]
    line = F.concat_ws(",", *fields)
    rest = F.concat(F.lit(",,"), F.coalesce("QFLAG", empty), F.lit(",7,"))
    cut = F.when(F.col("key") == 9, line).when(F.col("key") == 10, F.concat(line, rest, F.lit(",,")))
    return rows.select(cut.otherwise(F.concat(line, rest)).alias("value"))


def _state(key: str):
    return F.split_part(F.lit(STATES), F.lit(","), F.col(key) + 1).alias("STATE")


def stations_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations; elevations have ties and one state is unknown."""
    return table(spark, sf_dir, "customer").select(
        station_id("c_custkey").alias("STATION_ID"),
        F.col("c_nationkey").cast("double").alias("LATITUDE"),
        (-F.col("c_nationkey")).cast("double").alias("LONGITUDE"),
        F.floor((F.col("c_acctbal") + 1000) / 4).cast("double").alias("ELEVATION"),
        _state("c_nationkey"),
        F.col("c_name").alias("NAME"),
    )


def stations_demo_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_state_to_region(stations_demo(spark, sf_dir))


def obs_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the stations in `observations`."""
    return table(spark, sf_dir, "nation").select(
        station_id("n_nationkey").alias("STATION_ID"),
        F.col("n_nationkey").cast("double").alias("LATITUDE"),
        (-F.col("n_nationkey")).cast("double").alias("LONGITUDE"),
        (F.col("n_nationkey") * 80).cast("double").alias("ELEVATION"),
        _state("n_nationkey"),
        F.col("n_name").alias("NAME"),
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer stations as fixed-width text, with blank elevations, foreign ids and short
    lines among them."""
    key = F.col("c_custkey")
    country = F.when(key % 7 == 0, "CA").otherwise("US")
    elevation = F.floor((F.col("c_acctbal") + 1000) / 4).cast("string")
    line = F.concat(
        country,
        F.lpad(key.cast("string"), 9, "0"),
        F.lit(" "),
        F.lpad(F.col("c_nationkey").cast("string"), 8, " "),
        F.lit(" "),
        F.lpad((-F.col("c_nationkey")).cast("string"), 9, " "),
        F.lit(" "),
        F.lpad(F.when(key % 10 == 0, "").otherwise(elevation), 6, " "),
        F.lit(" "),
        _state("c_nationkey"),
        F.lit(" "),
        F.rpad("c_name", 30, " "),
    )
    return table(spark, sf_dir, "customer").select(
        F.when(key % 11 == 0, F.substring(line, 1, 60)).otherwise(line).alias("value")
    )


def _region_values(selection: bool) -> str:
    return ", ".join(f"('{s}', '{r}')" for s, r in state_regions(selection))


# DuckDB text of the views. A check lists the views it needs.
VIEWS = {
    "daily": """daily AS (
  SELECT concat('US', lpad(CAST(s_nationkey AS VARCHAR), 9, '0')) AS STATION,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS DATE,
         CAST(max(l_quantity) AS DOUBLE) AS TMAX,
         CAST(min(l_quantity) AS DOUBLE) AS TMIN,
         CAST(sum(CAST(round(l_discount * 100) AS INTEGER)) AS DOUBLE) AS PRCP,
         CAST(max(CAST(round(l_tax * 100) AS INTEGER)) AS DOUBLE) AS SNOW,
         CAST(greatest(max(CAST(round(l_tax * 100) AS INTEGER)) - 3, 0) AS DOUBLE) AS SNWD,
         CAST(floor(max(l_extendedprice) / 1000) AS DOUBLE) AS AWND
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)""",
    "obs": """obs AS (
  SELECT STATION, DATE, ELEMENT, VALUE, DATE // 10000 AS year,
         (DATE % 10000) // 100 AS month, DATE % 100 AS day
  FROM (SELECT * FROM daily
        UNPIVOT (VALUE FOR ELEMENT IN (TMAX, TMIN, PRCP, SNOW, SNWD, AWND))))""",
    "raw": f"""raw AS (
  SELECT concat('US', lpad(CAST(l_suppkey AS VARCHAR), 9, '0')) AS STATION,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS DATE,
         split_part('{RAW_ELEMENTS}', ',', l_linenumber) AS ELEMENT,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL
              WHEN l_orderkey % 89 = 0 THEN -CAST(l_quantity AS INTEGER)
              ELSE CAST(l_quantity AS INTEGER) END AS VALUE,
         CASE WHEN l_returnflag = 'R' THEN 'I' END AS QFLAG
  FROM lineitem)""",
    "cleaned": """cleaned AS (
  SELECT STATION, DATE, ELEMENT,
         CASE WHEN ELEMENT IN ('TMAX', 'TMIN', 'PRCP') THEN CAST(VALUE AS DOUBLE) / 10
              ELSE CAST(VALUE AS DOUBLE) END AS VALUE
  FROM raw
  WHERE QFLAG IS NULL AND ELEMENT IN ('TMAX', 'TMIN', 'PRCP', 'SNOW', 'SNWD', 'AWND'))""",
    "stations_demo": f"""stations_demo AS (
  SELECT concat('US', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS STATION_ID,
         CAST(c_nationkey AS DOUBLE) AS LATITUDE, -CAST(c_nationkey AS DOUBLE) AS LONGITUDE,
         CAST(floor((c_acctbal + 1000) / 4) AS DOUBLE) AS ELEVATION,
         split_part('{STATES}', ',', c_nationkey + 1) AS STATE, c_name AS NAME
  FROM customer)""",
    "obs_stations": f"""obs_stations AS (
  SELECT concat('US', lpad(CAST(n_nationkey AS VARCHAR), 9, '0')) AS STATION_ID,
         CAST(n_nationkey AS DOUBLE) AS LATITUDE, -CAST(n_nationkey AS DOUBLE) AS LONGITUDE,
         CAST(n_nationkey * 80 AS DOUBLE) AS ELEVATION,
         split_part('{STATES}', ',', n_nationkey + 1) AS STATE, n_name AS NAME
  FROM nation)""",
    "region_map": f"region_map(STATE, REGION) AS (VALUES {_region_values(False)})",
    "selection_map": f"selection_map(STATE, REGION) AS (VALUES {_region_values(True)})",
    "demo_regions": """demo_regions AS (
  SELECT s.*, m.REGION FROM stations_demo s LEFT JOIN region_map m ON s.STATE = m.STATE)""",
    "obs_regions": """obs_regions AS (
  SELECT s.STATION_ID AS STATION, m.REGION, s.ELEVATION
  FROM obs_stations s LEFT JOIN region_map m ON s.STATE = m.STATE)""",
}
