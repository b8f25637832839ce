"""DuckDB SQL for the registered queries, written along another route where one is at hand:
joins where the library uses windows or conditional aggregates, neighbour comparison where it
numbers runs, plain ordering where it partitions."""

from __future__ import annotations

from catalog.adapter import RAW_ELEMENTS, STATES, VIEWS
from stationlab.schemas import MAP_QUOTAS

SQL: dict[str, str] = {}

MIN_DAYS = 10
HEAT = 0.70
REGION_ROWS = 1000

VIEWS = {
    **VIEWS,
    # Winters: two halves joined, baselines joined back.
    "winter_pairs": f"""half AS (
  SELECT STATION, year, month >= 11 AS is_early, sum(VALUE) AS prcp, count(*) AS days
  FROM obs WHERE ELEMENT = 'PRCP' AND month IN (11, 12, 2, 3) GROUP BY ALL
  HAVING count(*) >= {MIN_DAYS}),
winter_pairs AS (
  SELECT l.STATION, l.year, e.prcp AS early_winter_prcp, l.prcp AS late_winter_prcp
  FROM half e JOIN half l ON e.STATION = l.STATION AND e.year + 1 = l.year
  WHERE e.is_early AND NOT l.is_early)""",
    "winters": """winter_base AS (
  SELECT STATION, avg(early_winter_prcp) AS baseline_early, avg(late_winter_prcp) AS baseline_late,
         stddev_samp(early_winter_prcp) AS std_early, stddev_samp(late_winter_prcp) AS std_late,
         count(*) AS num_years
  FROM winter_pairs GROUP BY STATION HAVING count(*) >= 5),
winters AS (
  SELECT p.STATION, p.year, early_winter_prcp, late_winter_prcp, baseline_early, baseline_late,
         std_early, std_late, num_years,
         (early_winter_prcp - baseline_early) / nullif(std_early, 0) AS early_anomaly,
         (late_winter_prcp - baseline_late) / nullif(std_late, 0) AS late_anomaly
  FROM winter_pairs p JOIN winter_base b ON p.STATION = b.STATION WHERE std_early > 0)""",
    # Heat waves: quantile_cont and neighbour flags on rows.
    "flags": f"""summer AS (
  SELECT * FROM obs WHERE ELEMENT = 'TMAX' AND month IN (6, 7, 8)),
limits AS (
  SELECT STATION, quantile_cont(VALUE, {HEAT}) AS heat_threshold FROM summer GROUP BY STATION),
extreme AS (
  SELECT s.*, heat_threshold, VALUE > heat_threshold AS is_extreme
  FROM summer s JOIN limits l ON s.STATION = l.STATION),
flags AS (
  SELECT STATION, year, DATE, VALUE, heat_threshold, is_extreme,
         is_extreme AND (
           (coalesce(lag(is_extreme) OVER w, false) AND coalesce(lead(is_extreme) OVER w, false))
           OR (coalesce(lead(is_extreme) OVER w, false)
               AND coalesce(lead(is_extreme, 2) OVER w, false))
           OR (coalesce(lag(is_extreme) OVER w, false)
               AND coalesce(lag(is_extreme, 2) OVER w, false))) AS is_heat_wave_day
  FROM extreme WINDOW w AS (PARTITION BY STATION, year ORDER BY DATE))""",
    "heat_metrics": """heat_metrics AS (
  SELECT STATION, year, count(*) FILTER (is_heat_wave_day) AS heat_wave_days,
         max(VALUE) FILTER (is_heat_wave_day) AS max_heat_wave_temp,
         avg(VALUE) FILTER (is_heat_wave_day) AS avg_heat_wave_temp,
         count(*) FILTER (is_extreme) AS extreme_days, count(*) AS summer_days
  FROM flags GROUP BY STATION, year)""",
    "heat": f"""springs AS (
  SELECT STATION, year, avg(VALUE) AS spring_avg_tmax, count(*) AS spring_days,
         stddev_samp(VALUE) AS spring_temp_std
  FROM obs WHERE ELEMENT = 'TMAX' AND month IN (3, 4, 5) GROUP BY STATION, year
  HAVING count(*) >= {MIN_DAYS}),
spring_base AS (
  SELECT STATION, avg(spring_avg_tmax) AS baseline_spring_temp,
         stddev_samp(spring_avg_tmax) AS std_spring_temp, count(*) AS num_years
  FROM springs GROUP BY STATION HAVING count(*) >= 5),
heat AS (
  SELECT s.*, baseline_spring_temp, std_spring_temp, num_years,
         (spring_avg_tmax - baseline_spring_temp) / std_spring_temp AS spring_temp_anomaly,
         coalesce(heat_wave_days, 0) AS heat_wave_days, max_heat_wave_temp, avg_heat_wave_temp,
         coalesce(extreme_days, 0) AS extreme_days, summer_days
  FROM springs s JOIN spring_base b ON s.STATION = b.STATION
  LEFT JOIN heat_metrics h ON s.STATION = h.STATION AND s.year = h.year
  WHERE std_spring_temp > 0)""",
    # Wind: three-way self-join, sums of seven neighbours.
    "wide": """wide AS (
  SELECT a.STATION, a.DATE, a.VALUE AS TMAX, b.VALUE AS TMIN, c.VALUE AS AWND,
         a.VALUE - b.VALUE AS temp_range, CASE WHEN a.month IN (12, 1, 2) THEN 'Winter'
           WHEN a.month IN (3, 4, 5) THEN 'Spring' WHEN a.month IN (6, 7, 8) THEN 'Summer'
           ELSE 'Fall' END AS season, 'all' AS everything
  FROM obs a JOIN obs b ON a.STATION = b.STATION AND a.DATE = b.DATE
  JOIN obs c ON a.STATION = c.STATION AND a.DATE = c.DATE
  WHERE a.ELEMENT = 'TMAX' AND b.ELEMENT = 'TMIN' AND c.ELEMENT = 'AWND'
    AND a.VALUE - b.VALUE > 0)""",
    # Snowmelt: each side with its own baseline, then joined.
    "melt": """melt_all AS (
  SELECT STATION, year,
         CAST(max(dayofyear(strptime(CAST(DATE AS VARCHAR), '%Y%m%d'))) AS INTEGER) AS snowmelt_doy,
         count(*) AS snow_days, max(VALUE) AS max_snow_depth, avg(VALUE) AS avg_snow_depth
  FROM obs WHERE ELEMENT = 'SNWD' AND month <= 5 AND VALUE > 0 GROUP BY STATION, year),
melt AS (SELECT * FROM melt_all WHERE snow_days >= 10)""",
    "melt_rain": f"""rain AS (
  SELECT STATION, year, sum(VALUE) AS spring_prcp, count(*) AS spring_prcp_days,
         avg(VALUE) AS avg_daily_prcp
  FROM obs WHERE ELEMENT = 'PRCP' AND month IN (4, 5) GROUP BY STATION, year
  HAVING count(*) >= {MIN_DAYS}),
melt_base AS (
  SELECT STATION, avg(snowmelt_doy) AS baseline_melt_doy, stddev_samp(snowmelt_doy) AS std_melt_doy,
         count(*) AS years_with_snow, avg(snow_days) AS avg_snow_days
  FROM melt GROUP BY STATION HAVING count(*) >= 5 AND stddev_samp(snowmelt_doy) > 0),
rain_base AS (
  SELECT STATION, avg(spring_prcp) AS baseline_spring_prcp,
         stddev_samp(spring_prcp) AS std_spring_prcp, count(*) AS prcp_years
  FROM rain GROUP BY STATION HAVING count(*) >= 5 AND stddev_samp(spring_prcp) > 0),
melt_rain AS (
  SELECT m.*, baseline_melt_doy, std_melt_doy, years_with_snow, avg_snow_days,
         snowmelt_doy - baseline_melt_doy AS melt_anomaly_days,
         (snowmelt_doy - baseline_melt_doy) / std_melt_doy AS melt_anomaly_std,
         spring_prcp, spring_prcp_days, avg_daily_prcp,
         baseline_spring_prcp, std_spring_prcp, prcp_years,
         spring_prcp - baseline_spring_prcp AS prcp_anomaly_mm,
         (spring_prcp - baseline_spring_prcp) / std_spring_prcp AS prcp_anomaly_std
  FROM melt m JOIN melt_base mb ON m.STATION = mb.STATION
  JOIN rain r ON m.STATION = r.STATION AND m.year = r.year
  JOIN rain_base rb ON r.STATION = rb.STATION)""",
    "yearly_rain": f"""yearly_rain AS (
  SELECT STATION, year, sum(VALUE) AS total FROM obs
  WHERE ELEMENT = 'PRCP' AND month IN (4, 5) GROUP BY STATION, year
  HAVING count(*) >= {MIN_DAYS})""",
    "rain_anomaly": """rain_anomaly AS (
  SELECT y.*, baseline, std, n, total - baseline AS difference, (total - baseline) / std AS anomaly
  FROM yearly_rain y JOIN (
    SELECT STATION, avg(total) AS baseline, stddev_samp(total) AS std, count(*) AS n
    FROM yearly_rain GROUP BY STATION) b ON y.STATION = b.STATION
  WHERE n >= 5 AND std > 0)""",
}

OBS = ("daily", "obs")
RAW = ("raw",)
WINTERS = (*OBS, "winter_pairs", "winters")
HEATS = (*OBS, "flags", "heat_metrics", "heat")
MELTS = (*OBS, "melt", "melt_rain")
OBS_REGIONS = ("obs_stations", "region_map", "obs_regions")
DEMO_REGIONS = ("stations_demo", "region_map", "demo_regions")


def wind_views(group: str, name: str) -> str:
    """Views `{name}_days` and `{name}` (the events), with thresholds and frames per group."""
    w = f"(PARTITION BY STATION, {group} ORDER BY DATE)"
    neighbours = ", ".join(
        f"{kind}(temp_range, {i}) OVER {w} AS temp_range_{kind}_{i}"
        for kind in ("lag", "lead")
        for i in range(1, 8)
    )
    before = " + ".join(f"temp_range_lag_{i}" for i in range(1, 8))
    after = " + ".join(f"temp_range_lead_{i}" for i in range(1, 8))
    return f"""{name}_limits AS (
  SELECT STATION, {group}, quantile_cont(AWND, 0.9) AS wind_threshold, avg(AWND) AS avg_wind,
         count(*) AS total_days
  FROM wide GROUP BY STATION, {group} HAVING count(*) >= 100),
{name}_days AS (SELECT *, {neighbours} FROM wide),
{name} AS (
  SELECT d.*, wind_threshold, avg_wind, total_days, AWND > wind_threshold AS is_high_wind,
         ({before}) / 7 AS avg_range_before, ({after}) / 7 AS avg_range_after,
         ({after}) / 7 - ({before}) / 7 AS range_change
  FROM {name}_days d JOIN {name}_limits l ON d.STATION = l.STATION AND d.{group} = l.{group}
  WHERE AWND > wind_threshold AND {before} IS NOT NULL AND {after} IS NOT NULL)"""


VIEWS["events"] = wind_views("everything", "events")
VIEWS["season_events"] = wind_views("season", "season_events")
WINDS = (*OBS, "wide", "events")


def corr(x: str, y: str) -> str:
    return f"CASE WHEN isfinite(corr({y}, {x})) THEN corr({y}, {x}) END"


def rate(event: str, given: str) -> str:
    return (
        f"100.0 * count(*) FILTER (({event}) AND ({given}))"
        f" / nullif(count(*) FILTER ({given}), 0)"
    )


WINTER_SUMMARY = f"""{corr('early_anomaly', 'late_anomaly')} AS correlation,
  count(*) AS sample_size,
  {rate('late_anomaly > 0', 'early_anomaly < -1')} AS compensation_rate,
  {rate('late_anomaly < 0', 'early_anomaly > 1')} AS reverse_compensation_rate,
  count(*) FILTER (early_anomaly < -1) AS dry_early_cases,
  count(*) FILTER (early_anomaly > 1) AS wet_early_cases"""

HEAT_SUMMARY = f"""{corr('spring_temp_anomaly', 'heat_wave_days')} AS correlation_days,
  {corr('spring_temp_anomaly', 'max_heat_wave_temp')} AS correlation_intensity,
  {corr('spring_temp_anomaly', 'extreme_days')} AS correlation_extreme_days,
  avg(heat_wave_days) FILTER (spring_temp_anomaly > 1) AS avg_hw_warm_spring,
  avg(heat_wave_days) FILTER (spring_temp_anomaly < -1) AS avg_hw_cool_spring,
  avg(extreme_days) FILTER (spring_temp_anomaly > 1) AS avg_extreme_warm_spring,
  avg(extreme_days) FILTER (spring_temp_anomaly < -1) AS avg_extreme_cool_spring,
  count(*) FILTER (spring_temp_anomaly > 1) AS warm_spring_cases,
  count(*) FILTER (spring_temp_anomaly < -1) AS cool_spring_cases,
  count(*) AS sample_size, CAST(70 AS DOUBLE) AS heat_threshold_percentile"""

WIND_SUMMARY = f"""avg(avg_range_before) AS avg_range_before,
  avg(avg_range_after) AS avg_range_after, avg(range_change) AS avg_range_change,
  stddev_samp(range_change) AS std_range_change, count(*) AS num_events,
  {rate('range_change < 0', 'true')} AS moderation_rate, CAST(7 AS INTEGER) AS lag_days,
  CASE WHEN count(*) = 0 THEN 'No complete events' ELSE 'ok' END AS status"""

MELT_SUMMARY = f"""{corr('snowmelt_doy', 'spring_prcp')} AS correlation,
  {corr('melt_anomaly_std', 'prcp_anomaly_std')} AS correlation_standardized,
  {corr('melt_anomaly_days', 'spring_prcp')} AS correlation_days,
  avg(prcp_anomaly_std) FILTER (melt_anomaly_std < -1) AS early_melt_prcp_anomaly,
  avg(prcp_anomaly_std) FILTER (melt_anomaly_std > 1) AS late_melt_prcp_anomaly,
  count(*) FILTER (melt_anomaly_std < -1) AS early_melt_cases,
  count(*) FILTER (melt_anomaly_std > 1) AS late_melt_cases,
  {rate('prcp_anomaly_std < 0', 'melt_anomaly_std < -1')} AS early_dry_rate,
  {rate('prcp_anomaly_std > 0', 'melt_anomaly_std > 1')} AS late_wet_rate,
  count(*) AS sample_size, count(DISTINCT STATION) AS num_stations, 'ok' AS status"""

# Doubles of the composite tables, to be rounded like the queries' results.
WINTER_DOUBLES = (
    "baseline_early baseline_late std_early std_late early_anomaly late_anomaly"
)
WINTER_SUMMARY_DOUBLES = "correlation compensation_rate reverse_compensation_rate"
HEAT_DOUBLES = (
    "spring_avg_tmax spring_temp_std baseline_spring_temp std_spring_temp spring_temp_anomaly"
    " avg_heat_wave_temp"
)
HEAT_SUMMARY_DOUBLES = (
    "correlation_days correlation_intensity correlation_extreme_days avg_hw_warm_spring"
    " avg_hw_cool_spring avg_extreme_warm_spring avg_extreme_cool_spring"
)
WIND_SUMMARY_DOUBLES = (
    "avg_range_before avg_range_after avg_range_change std_range_change moderation_rate"
)
MELT_DOUBLES = (
    "avg_snow_depth baseline_melt_doy std_melt_doy avg_snow_days melt_anomaly_days"
    " melt_anomaly_std avg_daily_prcp baseline_spring_prcp std_spring_prcp prcp_anomaly_mm"
    " prcp_anomaly_std"
)
MELT_SUMMARY_DOUBLES = (
    "correlation correlation_standardized correlation_days early_melt_prcp_anomaly"
    " late_melt_prcp_anomaly early_dry_rate late_wet_rate"
)


def check(name: str, views: tuple[str, ...], sql: str, doubles: str = "") -> None:
    """Registers the SQL of a query; the named double columns are rounded to six digits."""
    needed = list(dict.fromkeys(views))
    with_clause = f"WITH {', '.join(VIEWS[v] for v in needed)}\n" if needed else ""
    if doubles:
        columns = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in doubles.split())
        sql = f"SELECT * REPLACE ({columns}) FROM ({sql})"
    SQL[name] = with_clause + sql


# Sources and sinks.
OBS_ROWS = "SELECT STATION, DATE, ELEMENT, VALUE, year, month, day FROM obs"
DATED = "DATE // 10000 AS year, (DATE % 10000) // 100 AS month, DATE % 100 AS day"
check("read_observations", OBS, OBS_ROWS)
check(
    "read_observations_sampled",
    RAW,
    f"""SELECT STATION, DATE, ELEMENT, CAST(VALUE AS DOUBLE) AS VALUE, {DATED}
FROM raw WHERE substr(md5(concat(STATION, '42')), 1, 4) < '8000'""",
)
check("read_raw_yearly", RAW, "SELECT STATION, DATE, ELEMENT, VALUE, CAST(NULL AS VARCHAR) AS MFLAG, QFLAG, '7' AS SFLAG, CAST(NULL AS VARCHAR) AS TIME FROM raw")
check(
    "read_filtered_years",
    RAW,
    """SELECT STATION, DATE // 10000 AS year, CAST(DATE // 10000 AS INTEGER) AS file_year,
       count(*) AS records, count(QFLAG) AS flagged, CAST(sum(VALUE) AS BIGINT) AS value_sum,
       CAST(sum(DATE) AS BIGINT) AS date_sum
FROM raw GROUP BY 1, 2""",
)
check(
    "parse_stations_fixed_width",
    ("selection_map",),
    f"""SELECT * FROM (
  SELECT concat('US', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS STATION_ID,
         CAST(c_nationkey AS DOUBLE) AS LATITUDE, -CAST(c_nationkey AS DOUBLE) AS LONGITUDE,
         CASE WHEN c_custkey % 10 = 0 THEN 0.0
              ELSE CAST(floor((c_acctbal + 1000) / 4) AS DOUBLE) END AS ELEVATION,
         split_part('{STATES}', ',', c_nationkey + 1) AS STATE, c_name AS NAME
  FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0)
JOIN selection_map USING (STATE)""",
    "LATITUDE LONGITUDE ELEVATION",
)
check("read_station_ids", ("stations_demo",), "SELECT STATION_ID AS STATION FROM stations_demo")
check("read_station_metadata", DEMO_REGIONS, "SELECT * FROM demo_regions", "LATITUDE LONGITUDE")
check("write_station_list", DEMO_REGIONS, "SELECT *, STATION_ID AS STATION FROM demo_regions")
check("station_listing", DEMO_REGIONS, "SELECT * FROM demo_regions")
check(
    "station_listing_first",
    DEMO_REGIONS,
    "SELECT * FROM demo_regions ORDER BY STATION_ID LIMIT 50",
)
check("incremental_year_ingest", (*RAW, "cleaned"), "SELECT * FROM cleaned")
check("write_clean_long", (*RAW, "cleaned"), f"SELECT *, {DATED} FROM cleaned")
check(
    "read_year_range",
    (*RAW, "cleaned"),
    f"SELECT *, {DATED} FROM cleaned WHERE DATE BETWEEN 19960101 AND 19981231",
)
check(
    "export_flat",
    OBS,
    """SELECT ELEMENT, year, avg(VALUE) AS avg_VALUE, stddev_samp(VALUE) AS std_VALUE,
       min(VALUE) AS min_VALUE, max(VALUE) AS max_VALUE, count(*) AS n
FROM obs GROUP BY ELEMENT, year""",
    "avg_VALUE std_VALUE",
)


def metric_rows(hypothesis: str, names: list[str], source: str, size: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{hypothesis}' AS hypothesis, '{n}' AS metric_name,"
        f" CAST({n} AS DOUBLE) AS metric_value, {size} AS sample_size FROM {source}"
        for n in names
    )


SUMMARY_VIEWS = {
    "H1": (WINTERS, WINTER_SUMMARY, "winters"),
    "H2": (HEATS, HEAT_SUMMARY, "heat"),
    "H3": (WINDS, WIND_SUMMARY, "events"),
    "H4": (MELTS, MELT_SUMMARY, "melt_rain"),
}
for _name, (_views, _summary, _table) in SUMMARY_VIEWS.items():
    VIEWS[f"sum_{_name}"] = f"sum_{_name} AS (SELECT {_summary} FROM {_table})"
ALL_SUMMARIES = tuple(
    v for name, (views, _, _) in SUMMARY_VIEWS.items() for v in (*views, f"sum_{name}")
)


def columns_of(summary: str) -> list[str]:
    """Names behind AS at the end of each output column, without status."""
    import re

    names = re.findall(r" AS (\w+)(?=,|\s*$)", summary)
    return [n for n in names if n not in ("status", "DOUBLE", "INTEGER")]


METRICS = {name: columns_of(spec[1]) for name, spec in SUMMARY_VIEWS.items()}
LONG_ROWS = " UNION ALL ".join(
    metric_rows(
        name,
        [m for m in metrics if m != "sample_size"],
        f"sum_{name}",
        "CAST(NULL AS BIGINT)" if name == "H3" else "sample_size",
    )
    for name, metrics in METRICS.items()
)
check(
    "summary_metrics_long",
    (*WINTERS, "sum_H1"),
    "SELECT * FROM ("
    + metric_rows("H1", [m for m in METRICS["H1"] if m != "sample_size"], "sum_H1", "sample_size")
    + ") WHERE metric_value IS NOT NULL",
    "metric_value",
)
DOCUMENT_NAMES = {
    "H1": "hypothesis_1_winter_precipitation",
    "H2": "hypothesis_2_spring_summer_heat",
    "H3": "hypothesis_3_wind_moderation",
    "H4": "hypothesis_4_snowmelt_precipitation",
}
check(
    "results_document",
    ALL_SUMMARIES,
    "SELECT hypothesis, metric_name, metric_value FROM ("
    + " UNION ALL ".join(
        metric_rows(DOCUMENT_NAMES[name], metrics, f"sum_{name}", "NULL")
        for name, metrics in METRICS.items()
    )
    + ") WHERE metric_value IS NOT NULL",
    "metric_value",
)
check(
    "export_all_results",
    ALL_SUMMARIES,
    "SELECT hypothesis, metric_name, metric_value, sample_size"
    f" FROM ({LONG_ROWS}) WHERE metric_value IS NOT NULL",
    "metric_value",
)
check(
    "keyed_upsert",
    WINTERS,
    """SELECT coalesce(o.STATION, n.STATION) AS STATION, coalesce(o.year, n.year) AS year,
       coalesce(n.early_winter_prcp + 2, o.early_winter_prcp) AS early_winter_prcp,
       coalesce(n.late_winter_prcp + 2, o.late_winter_prcp) AS late_winter_prcp,
       coalesce(o.baseline_early, n.baseline_early + 1) AS baseline_early
FROM (SELECT * FROM winters WHERE year <= 1998) o
FULL OUTER JOIN (SELECT * FROM winters WHERE year >= 1997) n
  ON o.STATION = n.STATION AND o.year = n.year""",
    "baseline_early",
)

# Projections, filters and scalars.
check("derive_date_parts", ("daily",), f"SELECT STATION, DATE, {DATED} FROM daily")
check(
    "day_of_year",
    ("daily",),
    """SELECT STATION, DATE,
       CAST(dayofyear(strptime(CAST(DATE AS VARCHAR), '%Y%m%d')) AS INTEGER) AS doy,
       CAST(dayofyear(try_strptime(CAST(DATE + 70 AS VARCHAR), '%Y%m%d')) AS INTEGER)
         AS shifted_doy
FROM daily""",
)
check("season_filter", OBS, f"{OBS_ROWS} WHERE DATE // 100 % 100 IN (4, 5)")
check("clean_observations", (*RAW, "cleaned"), "SELECT * FROM cleaned")
check(
    "us_known_region_filter",
    ("stations_demo", "selection_map"),
    """SELECT s.*, REGION FROM stations_demo s JOIN selection_map m ON s.STATE = m.STATE
WHERE STATION_ID LIKE 'US%'""",
)
check("map_state_to_region", DEMO_REGIONS, "SELECT * FROM demo_regions")
check("region_fallback", ("daily",), "SELECT STATION, DATE, 'Unknown' AS REGION FROM daily")
BAND = (
    "CASE WHEN ELEVATION < 500 THEN 'Low (<500m)' WHEN ELEVATION < 1500 THEN 'Mid (500-1500m)'"
    " ELSE 'High (>1500m)' END AS elev_band"
)
check(
    "elevation_bands",
    ("stations_demo",),
    f"SELECT STATION_ID, ELEVATION, {BAND} FROM stations_demo WHERE ELEVATION IS NOT NULL",
)
check(
    "diurnal_range",
    ("daily",),
    "SELECT STATION, DATE, TMAX - TMIN AS temp_range FROM daily WHERE TMAX > TMIN",
)
check(
    "standardized_anomaly",
    (*OBS, "yearly_rain", "rain_anomaly"),
    "SELECT * FROM rain_anomaly",
    "baseline std difference anomaly",
)
check(
    "fill_missing_counts",
    ("raw", "stations_demo"),
    """SELECT s.STATION_ID AS STATION,
       CAST(coalesce(sum(VALUE) FILTER (ELEMENT = 'SNOW'), 0) AS BIGINT) AS snow,
       CAST(sum(VALUE) FILTER (ELEMENT = 'WT01') AS BIGINT) AS weather
FROM stations_demo s LEFT JOIN raw r ON s.STATION_ID = r.STATION GROUP BY 1""",
)
check(
    "effect_size",
    OBS,
    """SELECT ELEMENT, mean_first, mean_second, n_first, n_second,
  (mean_first - mean_second)
    / nullif(sqrt((ss_first + ss_second) / (n_first + n_second - 2)), 0) AS effect_size
FROM (SELECT ELEMENT, avg(VALUE) FILTER (summer) AS mean_first,
        avg(VALUE) FILTER (NOT summer) AS mean_second,
        count(VALUE) FILTER (summer) AS n_first, count(VALUE) FILTER (NOT summer) AS n_second,
        count(VALUE) FILTER (summer) * var_pop(VALUE) FILTER (summer) AS ss_first,
        count(VALUE) FILTER (NOT summer) * var_pop(VALUE) FILTER (NOT summer) AS ss_second
      FROM (SELECT *, month >= 6 AS summer FROM obs WHERE month BETWEEN 3 AND 8)
      GROUP BY ELEMENT)""",
    "mean_first mean_second effect_size",
)

# Joins.
check(
    "pivot_wide",
    (*RAW, "cleaned"),
    """SELECT a.STATION, a.DATE, a.VALUE AS TMAX, b.VALUE AS TMIN
FROM (SELECT STATION, DATE, max(VALUE) AS VALUE FROM cleaned WHERE ELEMENT = 'TMAX'
      GROUP BY ALL) a
JOIN (SELECT STATION, DATE, max(VALUE) AS VALUE FROM cleaned WHERE ELEMENT = 'TMIN'
      GROUP BY ALL) b ON a.STATION = b.STATION AND a.DATE = b.DATE""",
)
check(
    "shifted_year_join",
    (*OBS, "winter_pairs"),
    """SELECT STATION, year, early_winter_prcp AS early_total, late_winter_prcp AS late_total
FROM winter_pairs""",
)
check(
    "baseline_join_back",
    (*OBS, "yearly_rain"),
    """SELECT y.*, baseline, std, n FROM yearly_rain y JOIN (
  SELECT STATION, avg(total) AS baseline, stddev_samp(total) AS std, count(*) AS n
  FROM yearly_rain GROUP BY STATION) b ON y.STATION = b.STATION WHERE n >= 5""",
    "baseline std",
)
check(
    "threshold_join",
    ("daily",),
    """SELECT d.STATION, DATE, AWND, threshold, AWND > threshold AS is_high_wind
FROM daily d JOIN (SELECT STATION, quantile_cont(AWND, 0.9) AS threshold FROM daily
                   GROUP BY STATION) t ON d.STATION = t.STATION""",
    "threshold",
)
check(
    "spring_heat_left_join",
    HEATS,
    """SELECT STATION, year, spring_avg_tmax, spring_days, heat_wave_days, max_heat_wave_temp,
       extreme_days, summer_days FROM heat""",
    "spring_avg_tmax",
)
check(
    "melt_precip_join",
    MELTS,
    """SELECT STATION, year, snowmelt_doy, snow_days, spring_prcp, spring_prcp_days,
       baseline_melt_doy, baseline_spring_prcp FROM melt_rain""",
    "baseline_melt_doy baseline_spring_prcp",
)
check(
    "attach_region",
    (*OBS, *OBS_REGIONS),
    """SELECT o.STATION, DATE, ELEMENT, VALUE, year, month, day, REGION
FROM obs o LEFT JOIN obs_regions r ON o.STATION = r.STATION""",
)
check(
    "attach_elevation",
    (*OBS, *OBS_REGIONS),
    f"""SELECT o.STATION, DATE, ELEMENT, VALUE, ELEVATION, {BAND}
FROM obs o JOIN obs_regions r ON o.STATION = r.STATION""",
)
check(
    "station_semi_join",
    (*RAW, *DEMO_REGIONS),
    """SELECT STATION, DATE, ELEMENT, VALUE FROM raw
WHERE STATION IN (SELECT STATION_ID FROM demo_regions WHERE REGION = 'West')""",
)

# Aggregations.
check(
    "seasonal_totals",
    OBS,
    f"""SELECT STATION, year, sum(VALUE) AS total, count(*) AS days, avg(VALUE) AS daily_mean
FROM obs WHERE ELEMENT = 'PRCP' AND month IN (11, 12) GROUP BY STATION, year
HAVING count(*) >= {MIN_DAYS}""",
    "daily_mean",
)
check(
    "seasonal_means",
    OBS,
    f"""SELECT STATION, year, avg(VALUE) AS mean, count(*) AS days, stddev_samp(VALUE) AS std
FROM obs WHERE ELEMENT = 'TMAX' AND month IN (3, 4, 5) GROUP BY STATION, year
HAVING count(*) >= {MIN_DAYS}""",
    "mean std",
)
check(
    "station_baseline",
    (*OBS, "yearly_rain"),
    """SELECT STATION, avg(total) AS baseline, stddev_samp(total) AS std, count(*) AS n
FROM yearly_rain GROUP BY STATION HAVING count(*) >= 5 AND stddev_samp(total) > 0""",
    "baseline std",
)
check(
    "percentile_threshold",
    RAW,
    """SELECT STATION, quantile_cont(CAST(VALUE AS DOUBLE), 0.95) AS threshold, 'ALL' AS ELEMENT
FROM raw WHERE VALUE IS NOT NULL GROUP BY STATION
UNION ALL
SELECT STATION, quantile_cont(CAST(VALUE AS DOUBLE), 0.9), ELEMENT
FROM raw WHERE VALUE IS NOT NULL GROUP BY STATION, ELEMENT""",
    "threshold",
)
check(
    "heat_wave_metrics",
    (*OBS, "flags", "heat_metrics"),
    "SELECT * FROM heat_metrics",
    "avg_heat_wave_temp",
)
check("snowmelt_dates", (*OBS, "melt"), "SELECT * FROM melt_all", "avg_snow_depth")
check(
    "event_summary",
    WINDS,
    """SELECT avg(avg_range_before) AS avg_range_before, avg(avg_range_after) AS avg_range_after,
       avg(range_change) AS avg_range_change, stddev_samp(range_change) AS std_range_change,
       count(*) AS num_events FROM events""",
    "avg_range_before avg_range_after avg_range_change std_range_change",
)
check(
    "pearson_corr",
    ("daily",),
    f"SELECT STATION, {corr('TMAX', 'AWND')} AS correlation, count(*) AS n FROM daily"
    " GROUP BY STATION",
    "correlation",
)
check(
    "corr_significance",
    ("daily",),
    f"""SELECT STATION, r, n, t_stat, coalesce(abs(t_stat) > 1.96, false) AS significant_05,
       coalesce(abs(t_stat) > 2.576, false) AS significant_01
FROM (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t_stat FROM (
  SELECT STATION, {corr('PRCP', 'SNWD')} AS r, count(*) AS n FROM daily GROUP BY STATION))""",
    "r t_stat",
)
check(
    "conditional_rate",
    ("daily",),
    f"""SELECT STATION, count(*) FILTER (TMAX > 40) AS cases,
       count(*) FILTER (TMAX > 40 AND AWND > 50) AS hits, {rate('AWND > 50', 'TMAX > 40')} AS rate
FROM daily GROUP BY STATION""",
    "rate",
)
check(
    "tail_comparison",
    (*OBS, "yearly_rain", "rain_anomaly"),
    """SELECT *, mean_upper / mean_lower AS ratio FROM (
  SELECT avg(total) FILTER (anomaly > 1) AS mean_upper,
         avg(total) FILTER (anomaly < -1) AS mean_lower,
         count(*) FILTER (anomaly > 1) AS upper_cases,
         count(*) FILTER (anomaly < -1) AS lower_cases
  FROM rain_anomaly)""",
    "mean_upper mean_lower ratio",
)
check(
    "coverage_overall",
    OBS,
    """SELECT count(*) AS total_records, count(DISTINCT STATION) AS total_stations,
       min(year) AS min_year, max(year) AS max_year FROM obs""",
)
check(
    "coverage_by_element",
    RAW,
    """SELECT ELEMENT, count(*) AS records, count(*) / (SELECT count(*) FROM raw) AS share
FROM raw GROUP BY ELEMENT""",
    "share",
)
check(
    "coverage_key_elements",
    RAW,
    """SELECT e.ELEMENT, count(r.STATION) AS records,
       100.0 * count(r.STATION) / (SELECT count(*) FROM raw) AS pct_records,
       count(DISTINCT r.STATION) AS stations,
       100.0 * count(DISTINCT r.STATION)
         / (SELECT count(DISTINCT STATION) FROM raw) AS pct_stations
FROM (VALUES ('TMAX'), ('TMIN'), ('PRCP'), ('AWND'), ('SNWD'), ('EVAP')) e(ELEMENT)
LEFT JOIN raw r ON e.ELEMENT = r.ELEMENT
GROUP BY e.ELEMENT""",
    "pct_records pct_stations",
)
check(
    "validate_quality",
    RAW,
    """SELECT * FROM (
  SELECT 'extreme_high_temperature' AS issue, count(*) AS n FROM raw
  WHERE ELEMENT IN ('TMAX', 'TMIN') AND VALUE > 45
  UNION ALL SELECT 'extreme_low_temperature', count(*) FROM raw
  WHERE ELEMENT IN ('TMAX', 'TMIN') AND VALUE < -45
  UNION ALL SELECT 'negative_precipitation', count(*) FROM raw WHERE ELEMENT = 'PRCP' AND VALUE < 0
  UNION ALL SELECT 'null_value', count(*) FROM raw WHERE VALUE IS NULL
  UNION ALL SELECT 'duplicate_keys',
    (SELECT count(*) FROM raw)
      - (SELECT count(*) FROM (SELECT DISTINCT STATION, DATE, ELEMENT FROM raw)))
WHERE n > 0""",
)
check(
    "heat_wave_trends",
    (*OBS, "flags"),
    """SELECT year, CAST(sum(CASE WHEN is_heat_wave_day THEN 1 ELSE 0 END) AS BIGINT)
         AS total_hw_days, count(*) FILTER (is_heat_wave_day) AS hw_day_count,
       avg(VALUE) AS avg_summer_temp, max(VALUE) AS max_summer_temp
FROM flags GROUP BY year""",
    "avg_summer_temp",
)
check(
    "snowmelt_trends",
    (*OBS, "melt"),
    """SELECT year, avg(snowmelt_doy) AS avg_melt_doy, stddev_samp(snowmelt_doy) AS std_melt_doy,
       min(snowmelt_doy) AS earliest_melt, max(snowmelt_doy) AS latest_melt,
       count(*) AS num_stations
FROM melt_all GROUP BY year""",
    "avg_melt_doy std_melt_doy",
)
check(
    "timeseries_rollup",
    (*OBS, *OBS_REGIONS),
    """SELECT REGION, ELEMENT, year, avg(VALUE) AS avg_VALUE, stddev_samp(VALUE) AS std_VALUE,
       min(VALUE) AS min_VALUE, max(VALUE) AS max_VALUE, count(*) AS n
FROM obs o LEFT JOIN obs_regions r ON o.STATION = r.STATION GROUP BY REGION, ELEMENT, year""",
    "avg_VALUE std_VALUE",
)
check(
    "linear_trend",
    (*OBS, "yearly_rain"),
    """SELECT STATION, CASE WHEN isfinite(slope) THEN slope END AS slope,
       CASE WHEN isfinite(slope) THEN intercept END AS intercept, n
FROM (SELECT STATION, regr_slope(total, year) AS slope, regr_intercept(total, year) AS intercept,
             CAST(regr_count(total, year) AS BIGINT) AS n
      FROM yearly_rain GROUP BY STATION)""",
    "slope intercept",
)
check(
    "dataset_profile",
    OBS,
    """SELECT 'overall' AS section, key, value FROM (
  SELECT CAST(count(*) AS DOUBLE) AS records, CAST(count(DISTINCT STATION) AS DOUBLE) AS stations,
         CAST(count(DISTINCT year) AS DOUBLE) AS years, CAST(min(DATE) AS DOUBLE) AS min_date,
         CAST(max(DATE) AS DOUBLE) AS max_date,
         count(*) / count(DISTINCT STATION) AS records_per_station FROM obs)
UNPIVOT (value FOR key IN (records, stations, years, min_date, max_date, records_per_station))
UNION ALL SELECT 'element', ELEMENT, CAST(count(*) AS DOUBLE) FROM obs GROUP BY ELEMENT
UNION ALL SELECT 'year', CAST(year AS VARCHAR), CAST(count(*) AS DOUBLE) FROM obs GROUP BY year""",
    "value",
)
check(
    "expected_vs_actual",
    OBS,
    """SELECT expected_records, actual_records, 100.0 * actual_records / expected_records AS ratio_pct
FROM (SELECT count(DISTINCT STATION) * CAST(365 * 7 AS DOUBLE) * CAST(0.6 AS DOUBLE)
        AS expected_records, count(*) AS actual_records FROM obs)""",
    "expected_records ratio_pct",
)
check(
    "column_coverage",
    RAW,
    """SELECT column_name, coverage_pct FROM (
  SELECT 100.0 * count(ELEMENT) / count(*) AS ELEMENT, 100.0 * count(VALUE) / count(*) AS VALUE,
         CAST(0 AS DOUBLE) AS MFLAG, 100.0 * count(QFLAG) / count(*) AS QFLAG,
         CAST(100 AS DOUBLE) AS SFLAG, CAST(0 AS DOUBLE) AS TIME FROM raw)
UNPIVOT (coverage_pct FOR column_name IN (ELEMENT, VALUE, MFLAG, QFLAG, SFLAG, TIME))""",
    "coverage_pct",
)
check(
    "expectation_report",
    (*OBS, *OBS_REGIONS),
    """SELECT 'record_count' AS rule, CAST(count(*) AS DOUBLE) AS observed,
       count(*) BETWEEN 100000 AND 1000000000 AS passed FROM obs
UNION ALL SELECT 'station_count', CAST(count(DISTINCT STATION) AS DOUBLE),
       count(DISTINCT STATION) >= 20 FROM obs
UNION ALL SELECT 'prcp_coverage_pct', p, p > 80 FROM (
  SELECT 100.0 * count(DISTINCT CASE WHEN ELEMENT = 'PRCP' THEN STATION END)
           / count(DISTINCT STATION) AS p FROM obs)
UNION ALL SELECT 'years_present', CAST(count(DISTINCT year) AS DOUBLE), count(DISTINCT year) = 8
FROM obs WHERE year BETWEEN 1995 AND 2002
UNION ALL SELECT 'regions_present', CAST(count(DISTINCT REGION) AS DOUBLE),
       count(DISTINCT REGION) = 7
FROM obs o JOIN obs_regions r ON o.STATION = r.STATION""",
    "observed",
)
check(
    "source_file_profile", (), """SELECT 'lineitem.parquet' AS file_name, count(*) AS records, true AS has_bytes
FROM lineitem
UNION ALL SELECT 'orders.parquet', count(*), true FROM orders"""
)
check(
    "station_selection_stats",
    ("stations_demo",),
    """SELECT count(*) AS stations, min(ELEVATION) AS min_elevation, max(ELEVATION) AS max_elevation,
       avg(ELEVATION) AS mean_elevation, min(LATITUDE) AS min_latitude,
       max(LATITUDE) AS max_latitude, min(LONGITUDE) + 0.0 AS min_longitude,
       max(LONGITUDE) + 0.0 AS max_longitude, count(DISTINCT STATE) AS states
FROM stations_demo""",
    "mean_elevation",
)

# Windows.
check(
    "heat_wave_flags",
    (*OBS, "flags"),
    """SELECT STATION, year, DATE, heat_threshold, VALUE AS max_value, is_extreme, is_heat_wave_day
FROM flags""",
    "heat_threshold",
)
check(
    "run_lengths",
    (*OBS, "flags"),
    """SELECT STATION, year, min(DATE) AS run_start, max(DATE) AS run_end,
       count(*) AS run_length, max(VALUE) AS peak
FROM (SELECT *, row_number() OVER (PARTITION BY STATION, year ORDER BY DATE)
        - row_number() OVER (PARTITION BY STATION, year, is_extreme ORDER BY DATE) AS island
      FROM flags)
WHERE is_extreme GROUP BY STATION, year, island HAVING count(*) >= 3""",
)
check(
    "lag_lead_features",
    ("daily",),
    "SELECT STATION, DATE, AWND, "
    + ", ".join(
        f"{kind}(AWND, {i}) OVER (PARTITION BY STATION ORDER BY DATE) AS AWND_{kind}_{i}"
        for kind in ("lag", "lead")
        for i in range(1, 8)
    )
    + " FROM daily",
)
check(
    "before_after_window",
    ("daily",),
    """SELECT STATION, DATE, temp_range, avg_before, avg_after, avg_after - avg_before AS change
FROM (SELECT STATION, DATE, temp_range,
  CASE WHEN count(*) OVER b = 7 THEN avg(temp_range) OVER b END AS avg_before,
  CASE WHEN count(*) OVER a = 7 THEN avg(temp_range) OVER a END AS avg_after
  FROM (SELECT STATION, DATE, TMAX - TMIN AS temp_range FROM daily WHERE TMAX > TMIN)
  WINDOW b AS (PARTITION BY STATION ORDER BY DATE ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         a AS (PARTITION BY STATION ORDER BY DATE ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING))""",
    "avg_before avg_after change",
)
check(
    "high_wind_events",
    WINDS,
    "SELECT * EXCLUDE (season, everything) FROM events",
    "wind_threshold avg_wind avg_range_before avg_range_after range_change",
)
check(
    "even_spaced_sample",
    DEMO_REGIONS,
    """SELECT STATION_ID, LATITUDE, LONGITUDE, ELEVATION, STATE, NAME, REGION FROM (
  SELECT s.*, k, row_number() OVER (PARTITION BY REGION ORDER BY ELEVATION, STATION_ID) - 1 AS p,
         count(*) OVER (PARTITION BY REGION) AS n
  FROM demo_regions s
  JOIN (VALUES ('Northeast', 53), ('Southeast', 47), ('Midwest', 1), ('West', 2),
               ('Alaska', 100000), ('Southwest', 0), ('Hawaii', 3)) q(REGION, k) USING (REGION)) t
WHERE n <= k OR (k = 1 AND p = 0) OR (k > 1 AND p = n - 1)
   OR (k > 1 AND p IN (SELECT CAST(floor(i * ((t.n - 1)::DOUBLE / (t.k - 1)::DOUBLE)) AS BIGINT)
                       FROM range(0, 100000) r(i) WHERE i < t.k - 1))""",
)
check(
    "regional_random_sample",
    DEMO_REGIONS,
    f"""SELECT STATION_ID, LATITUDE, LONGITUDE, ELEVATION, STATE, NAME, REGION FROM (
  SELECT s.*, quota, row_number() OVER (PARTITION BY REGION
           ORDER BY md5(concat(STATION_ID, '42')), STATION_ID) AS place
  FROM demo_regions s
  JOIN (VALUES {", ".join(f"('{r}', {k})" for r, k in MAP_QUOTAS.items())}) q(REGION, quota)
    USING (REGION))
WHERE place <= quota""",
)
check(
    "first_last_years",
    OBS,
    """SELECT year, count(*) AS records FROM obs
WHERE year IN (SELECT DISTINCT year FROM obs ORDER BY year LIMIT 2)
   OR year IN (SELECT DISTINCT year FROM obs ORDER BY year DESC LIMIT 2)
GROUP BY year""",
)

# Sort, limit and sets.
check(
    "top_stations",
    RAW,
    """SELECT STATION, count(*) AS records FROM raw GROUP BY STATION
ORDER BY records DESC, STATION LIMIT 10""",
)
check(
    "union_years",
    OBS,
    """SELECT STATION, DATE, ELEMENT, VALUE, year, month,
       CASE WHEN year = 1995 THEN day END AS day FROM obs""",
)
check("distinct_keys", RAW, "SELECT DISTINCT STATION, DATE, ELEMENT FROM raw")
check(
    "distinct_key_counts",
    RAW,
    """SELECT count(DISTINCT STATION) AS stations, count(DISTINCT ELEMENT) AS elements,
       (SELECT count(*) FROM (SELECT DISTINCT STATION, DATE, ELEMENT FROM raw)) AS keys
FROM raw""",
)

# Composite analyses.
check("winter_precip_lag", WINTERS, "SELECT * FROM winters", WINTER_DOUBLES)
check(
    "winter_precip_lag_summary",
    (*WINTERS, "sum_H1"),
    "SELECT * FROM sum_H1",
    WINTER_SUMMARY_DOUBLES,
)
check("spring_summer_heat", HEATS, "SELECT * FROM heat", HEAT_DOUBLES)
check(
    "spring_summer_heat_summary", (*HEATS, "sum_H2"), "SELECT * FROM sum_H2", HEAT_SUMMARY_DOUBLES
)
check("wind_moderation", (*WINDS, "sum_H3"), "SELECT * FROM sum_H3", WIND_SUMMARY_DOUBLES)
check("snowmelt_precip", MELTS, "SELECT * FROM melt_rain", MELT_DOUBLES)
check(
    "snowmelt_precip_summary", (*MELTS, "sum_H4"), "SELECT * FROM sum_H4", MELT_SUMMARY_DOUBLES
)
check(
    "winter_precip_by_region",
    (*WINTERS, *OBS_REGIONS),
    f"""SELECT REGION, {WINTER_SUMMARY} FROM winters w JOIN obs_regions r ON w.STATION = r.STATION
WHERE REGION IS NOT NULL GROUP BY REGION""",
    WINTER_SUMMARY_DOUBLES,
)
check(
    "wind_by_season",
    (*OBS, "wide", "season_events"),
    f"""SELECT s.season, avg_range_before, avg_range_after, avg_range_change, std_range_change,
       coalesce(num_events, 0) AS num_events, moderation_rate, CAST(7 AS INTEGER) AS lag_days,
       coalesce(status, 'No complete events') AS status
FROM (SELECT DISTINCT season FROM wide) s
LEFT JOIN (SELECT season, {WIND_SUMMARY} FROM season_events GROUP BY season) e
  ON s.season = e.season""",
    WIND_SUMMARY_DOUBLES,
)
check(
    "snowmelt_by_elevation",
    (*MELTS, *OBS_REGIONS),
    f"""SELECT elev_band, {MELT_SUMMARY} FROM (
  SELECT m.*, {BAND} FROM melt_rain m JOIN obs_regions r ON m.STATION = r.STATION)
GROUP BY elev_band""",
    MELT_SUMMARY_DOUBLES,
)

VIEWS["regional"] = f"""region_size AS (
  SELECT REGION FROM obs o JOIN obs_regions r ON o.STATION = r.STATION
  WHERE REGION IS NOT NULL GROUP BY REGION HAVING count(*) >= {REGION_ROWS}),
reg1 AS (SELECT REGION, {WINTER_SUMMARY}
  FROM winters w JOIN obs_regions r ON w.STATION = r.STATION GROUP BY REGION),
reg2 AS (SELECT REGION, {HEAT_SUMMARY}
  FROM heat h JOIN obs_regions r ON h.STATION = r.STATION GROUP BY REGION),
reg3 AS (SELECT REGION, {WIND_SUMMARY}
  FROM events e JOIN obs_regions r ON e.STATION = r.STATION GROUP BY REGION),
reg4 AS (SELECT REGION, {MELT_SUMMARY}
  FROM melt_rain JOIN obs_regions USING (STATION) GROUP BY REGION),
regional AS (
  SELECT 'H1_winter_precipitation' AS hypothesis, s.REGION AS region, correlation,
         coalesce(sample_size, 0) AS sample_size, compensation_rate,
         CAST(NULL AS DOUBLE) AS avg_hw_warm, CAST(NULL AS DOUBLE) AS avg_hw_cool,
         CAST(NULL AS DOUBLE) AS avg_range_change, CAST(NULL AS DOUBLE) AS moderation_rate,
         CAST(NULL AS BIGINT) AS num_events, CAST(NULL AS DOUBLE) AS early_melt_prcp,
         'ok' AS status
  FROM region_size s LEFT JOIN reg1 USING (REGION)
  UNION ALL SELECT 'H2_spring_summer_heat', s.REGION, correlation_days, coalesce(sample_size, 0),
         NULL, avg_hw_warm_spring, avg_hw_cool_spring, NULL, NULL, NULL, NULL, 'ok'
  FROM region_size s LEFT JOIN reg2 USING (REGION)
  UNION ALL SELECT 'H3_wind_moderation', s.REGION, NULL, NULL, NULL, NULL, NULL, avg_range_change,
         moderation_rate, num_events, NULL, coalesce(status, 'No complete events')
  FROM region_size s LEFT JOIN reg3 USING (REGION)
  UNION ALL SELECT 'H4_snowmelt_precipitation', s.REGION, correlation, sample_size, NULL, NULL,
         NULL, NULL, NULL, NULL, early_melt_prcp_anomaly, coalesce(status, 'No overlapping data')
  FROM region_size s LEFT JOIN reg4 USING (REGION))"""
REGIONAL = (*WINTERS, *HEATS, *WINDS, *MELTS, *OBS_REGIONS, "regional")
check(
    "regional_consistency",
    REGIONAL,
    "SELECT * FROM regional",
    "correlation compensation_rate avg_hw_warm avg_hw_cool avg_range_change moderation_rate"
    " early_melt_prcp",
)
check(
    "regional_results_table",
    REGIONAL,
    """SELECT hypothesis, region, correlation,
       coalesce(sample_size, num_events) AS sample_size,
       coalesce(moderation_rate, compensation_rate) AS effect_size,
       coalesce(abs(correlation) > 0.1, false)
         OR coalesce(coalesce(moderation_rate, compensation_rate) > 55, false)
         AS significant
FROM regional WHERE status = 'ok'""",
    "correlation effect_size",
)
check(
    "direction_consistency",
    REGIONAL,
    """SELECT hypothesis, regions, positive, negative,
       greatest(positive, negative) / nullif(regions, 0) AS majority_share,
       CASE WHEN regions >= 2 THEN greatest(positive, negative) / regions > 0.5 END AS consistent
FROM (SELECT hypothesis, count(coalesce(correlation, avg_range_change)) AS regions,
             count(*) FILTER (coalesce(correlation, avg_range_change) > 0) AS positive,
             count(*) FILTER (coalesce(correlation, avg_range_change) < 0) AS negative
      FROM regional GROUP BY hypothesis)""",
    "majority_share",
)
VERDICTS = {
    "H1": ("correlation", "< -0.1"),
    "H2": ("correlation_days", "> 0.1"),
    "H3": ("moderation_rate", "> 55"),
    "H4": ("correlation", "> 0.1"),
}
check(
    "support_verdict",
    ALL_SUMMARIES,
    " UNION ALL ".join(
        f"SELECT '{h}' AS hypothesis, '{m}' AS metric_name, CAST({m} AS DOUBLE) AS metric_value,"
        f" CASE WHEN {m} {test} THEN 'SUPPORTED' ELSE 'NOT SUPPORTED' END AS verdict FROM sum_{h}"
        for h, (m, test) in VERDICTS.items()
    ),
    "metric_value",
)
REPORT = {
    "H1": "correlation sample_size compensation_rate",
    "H2": "correlation_days correlation_intensity avg_hw_warm_spring avg_hw_cool_spring",
    "H3": "num_events avg_range_before avg_range_after avg_range_change moderation_rate",
    "H4": "correlation sample_size early_melt_prcp_anomaly late_melt_prcp_anomaly",
}
REPORT_COLUMNS = list(dict.fromkeys(" ".join(REPORT.values()).split()))
check(
    "summary_report",
    ALL_SUMMARIES,
    " UNION ALL ".join(
        f"SELECT '{h}' AS hypothesis, "
        + ", ".join(
            f"CAST({c if c in names.split() else 'NULL'} AS DOUBLE) AS {c}" for c in REPORT_COLUMNS
        )
        + f" FROM sum_{h}"
        for h, names in REPORT.items()
    ),
    " ".join(REPORT_COLUMNS),
)

# Merged result tables: where the rows of each come from, and its number columns there.
TREND_ROWS = """SELECT avg(VALUE) AS avg_value, max(VALUE) AS max_value, NULL AS std_value,
         NULL AS min_value, NULL AS num_stations FROM flags GROUP BY year
  UNION ALL SELECT sum(CASE WHEN is_heat_wave_day THEN 1 ELSE 0 END), NULL, NULL, NULL, NULL
  FROM flags GROUP BY year
  UNION ALL SELECT avg(snowmelt_doy), max(snowmelt_doy), stddev_samp(snowmelt_doy),
         min(snowmelt_doy), count(*) FROM melt_all GROUP BY year"""
MERGED = {
    "h1_winter_precipitation": (
        "winters",
        "early_winter_prcp late_winter_prcp early_anomaly late_anomaly baseline_early baseline_late",
    ),
    "h2_spring_summer_heat": (
        "heat",
        "spring_avg_tmax spring_temp_anomaly heat_wave_days max_heat_wave_temp extreme_days",
    ),
    "h3_wind_moderation": (
        "(SELECT *, AWND AS awnd FROM events)",
        "awnd temp_range avg_range_before avg_range_after range_change",
    ),
    "h4_snowmelt_precipitation": (
        "melt_rain",
        "snowmelt_doy melt_anomaly_days spring_prcp prcp_anomaly_std baseline_melt_doy"
        " melt_anomaly_std baseline_spring_prcp",
    ),
    "analysis_summary": (
        f"(SELECT * FROM ({LONG_ROWS}) WHERE metric_value IS NOT NULL)",
        "metric_value sample_size",
    ),
    "stations": ("obs_stations", "latitude longitude elevation"),
    "yearly_trends": (f"({TREND_ROWS})", "avg_value min_value max_value std_value num_stations"),
    "regional_results": (
        """(SELECT correlation, coalesce(sample_size, num_events) AS sample_size,
         coalesce(moderation_rate, compensation_rate) AS effect_size
  FROM regional WHERE status = 'ok')""",
        "correlation sample_size effect_size",
    ),
}
check(
    "result_table_merges",
    (*REGIONAL, *ALL_SUMMARIES),
    "SELECT table_name, item, round(total, 3) + 0.0 AS total FROM ("
    + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{item}' AS item, CAST({value} AS DOUBLE) AS total"
        f" FROM {rows}"
        for table, (rows, items) in MERGED.items()
        for item, value in [("records", "count(*)"), *[(i, f"sum({i})") for i in items.split()]]
    )
    + ") WHERE total IS NOT NULL",
)

# Corrected years, rejected lines, stored counts and state.
check(
    "corrected_year_ingest",
    (*RAW, "cleaned"),
    """SELECT STATION, DATE, ELEMENT,
       CASE WHEN ELEMENT IN ('TMAX', 'TMIN', 'PRCP') THEN CAST(moved AS DOUBLE) / 10
            ELSE CAST(moved AS DOUBLE) END AS VALUE
FROM (SELECT *, VALUE + CASE WHEN DATE // 10000 = 1997 THEN 1 ELSE 0 END AS moved FROM raw)
WHERE QFLAG IS NULL AND ELEMENT IN ('TMAX', 'TMIN', 'PRCP', 'SNOW', 'SNWD', 'AWND')""",
)
check(
    "raw_line_faults",
    RAW,
    """SELECT fault <> 'none' AS rejected, fault, count(*) AS lines,
       CAST(sum(CASE WHEN fault = 'none' THEN VALUE END) AS BIGINT) AS value_sum,
       CAST(sum(CASE WHEN fault <> 'none' THEN chars END) AS BIGINT) AS rejected_chars
FROM (SELECT VALUE, CASE WHEN key IN (6, 9, 10) THEN 'malformed line' WHEN key = 3 THEN 'missing STATION'
               WHEN key = 5 THEN 'missing DATE' WHEN key = 7 THEN 'missing VALUE' ELSE 'none' END AS fault,
             length(STATION) * (key <> 3)::INT
             + CASE key WHEN 5 THEN 0 WHEN 6 THEN 1 ELSE 8 END + length(ELEMENT)
             + length(VALUE::VARCHAR) * (key <> 7)::INT + 3
             + CASE WHEN key = 9 THEN 0 ELSE 4 + length(coalesce(QFLAG, '')) + 1 END
             + CASE WHEN key = 10 THEN 2 ELSE 0 END AS chars
      FROM (SELECT *, (DATE % 100 + VALUE) % 20 AS key FROM raw WHERE VALUE IS NOT NULL))
GROUP BY ALL""",
)
check(
    "station_line_faults",
    (),
    """SELECT CASE WHEN chars < 70 THEN 'short line' ELSE 'none' END AS fault, count(*) AS lines,
       CAST(sum(chars) AS BIGINT) AS chars
FROM (SELECT CASE WHEN c_custkey % 11 = 0 THEN 60 ELSE 71 END AS chars FROM customer) GROUP BY ALL""",
)
SQL["clustered_observations"] = SQL["wind_moderation"]
check(
    "quality_while_writing",
    RAW,
    """SELECT * FROM (
  SELECT 'extreme_high_temperature' AS item, count(*) AS n FROM raw
  WHERE ELEMENT IN ('TMAX', 'TMIN') AND VALUE > 45
  UNION ALL SELECT 'extreme_low_temperature', count(*) FROM raw
  WHERE ELEMENT IN ('TMAX', 'TMIN') AND VALUE < -45
  UNION ALL SELECT 'negative_precipitation', count(*) FROM raw WHERE ELEMENT = 'PRCP' AND VALUE < 0
  UNION ALL SELECT 'null_value', count(*) FROM raw WHERE VALUE IS NULL
  UNION ALL SELECT ELEMENT, count(*) FROM raw GROUP BY ELEMENT)
WHERE n > 0""",
)
check(
    "run_documents",
    ALL_SUMMARIES,
    "SELECT run, hypothesis, metric_name, metric_value FROM ("
    + " UNION ALL ".join(
        f"SELECT '{run}' AS run, * FROM ("
        + " UNION ALL ".join(
            metric_rows(name, METRICS[name], f"sum_{name}", "NULL") for name in names
        )
        + ")"
        for run, names in (("first", METRICS), ("second", ("H1", "H3")))
    )
    + ") WHERE metric_value IS NOT NULL",
    "metric_value",
)
check(
    "partition_upsert",
    WINTERS,
    """SELECT STATION, year, early_winter_prcp + (year = 1998)::INT AS early_winter_prcp,
       late_winter_prcp + (year = 1998)::INT AS late_winter_prcp, year = 1998 AS rewritten
FROM winters""",
)
SQL["percentile_from_state"] = SQL["percentile_threshold"]
SQL["baseline_from_state"] = SQL["station_baseline"]
check(
    "profile_from_state",
    RAW,
    """SELECT 'overall' AS section, key, value FROM (
  SELECT CAST(count(*) AS DOUBLE) AS records, CAST(count(DISTINCT STATION) AS DOUBLE) AS stations,
         CAST(count(DISTINCT DATE // 10000) AS DOUBLE) AS years, CAST(min(DATE) AS DOUBLE) AS min_date,
         CAST(max(DATE) AS DOUBLE) AS max_date,
         count(*) / count(DISTINCT STATION) AS records_per_station FROM raw)
UNPIVOT (value FOR key IN (records, stations, years, min_date, max_date, records_per_station))
UNION ALL SELECT 'element', ELEMENT, CAST(count(*) AS DOUBLE) FROM raw GROUP BY ELEMENT
UNION ALL SELECT 'year', CAST(DATE // 10000 AS VARCHAR), CAST(count(*) AS DOUBLE) FROM raw GROUP BY ALL
UNION ALL SELECT 'duplicates', 'keys', CAST((SELECT count(*) FROM raw)
  - (SELECT count(*) FROM (SELECT DISTINCT STATION, DATE, ELEMENT FROM raw)) AS DOUBLE)""",
    "value",
)
DAY = "CAST(strptime(CAST(DATE AS VARCHAR), '%Y%m%d') AS DATE)"
check(
    "run_lengths_calendar",
    (*OBS, "flags"),
    f"""SELECT STATION, year, min(DATE) AS run_start, max(DATE) AS run_end,
       count(*) AS run_length, max(VALUE) AS peak
FROM (SELECT *, {DAY} - CAST(row_number() OVER (PARTITION BY STATION, year ORDER BY DATE) AS INTEGER)
        AS island FROM flags WHERE is_extreme)
GROUP BY STATION, year, island HAVING count(*) >= 2""",
)
check(
    "lag_lead_calendar",
    ("daily",),
    f"""SELECT STATION, DATE, AWND, """
    + ", ".join(
        f"max(AWND) OVER (PARTITION BY STATION ORDER BY {DAY} RANGE BETWEEN INTERVAL {i} DAY {way}"
        f" AND INTERVAL {i} DAY {way}) AS AWND_{kind}_{i}"
        for kind, way in (("lag", "PRECEDING"), ("lead", "FOLLOWING"))
        for i in range(1, 4)
    )
    + " FROM daily WHERE DATE % 3 <> 0",
)
check(
    "before_after_calendar",
    ("daily",),
    f"""SELECT STATION, DATE, temp_range, avg_before, avg_after, avg_after - avg_before AS change
FROM (SELECT STATION, DATE, temp_range,
  CASE WHEN count(*) OVER b >= 3 THEN avg(temp_range) OVER b END AS avg_before,
  CASE WHEN count(*) OVER a >= 3 THEN avg(temp_range) OVER a END AS avg_after
  FROM (SELECT STATION, DATE, TMAX - TMIN AS temp_range FROM daily WHERE TMAX > TMIN AND DATE % 3 <> 0)
  WINDOW b AS (PARTITION BY STATION ORDER BY {DAY} RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING),
         a AS (PARTITION BY STATION ORDER BY {DAY} RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL 7 DAY FOLLOWING))""",
    "avg_before avg_after change",
)
