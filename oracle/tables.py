"""Tables the expected results are built from, in dependency order.

Written apart from the Spark models and in other terms where there is a choice:
two aggregates and a full outer join for demand, plain distinct counts for
coverage, joins before grouping in the views.
"""

from __future__ import annotations

import re

from ridelake.sources import feeds

AS_OF = "DATE '2024-01-30'"
NOW = "TIMESTAMP '2024-01-30 23:59:59'"
NOW_TEXT = "2024-01-30 23:59:59+00"
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

COUNTERS = (
    "num_bikes_available num_ebikes_available num_bikes_disabled num_docks_available "
    "num_docks_disabled num_scooters_available num_scooters_unavailable"
).split()


def key(*parts: str) -> str:
    texts = ", '-', ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULL_TOKEN}')" for p in parts)
    return f"md5(concat({texts}))"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def favourite(source: str, keys: str, value: str, name: str) -> str:
    """Most frequent value per key; null counts, lowest value wins ties."""
    return f"""
SELECT DISTINCT ON ({keys}) {keys}, {value} AS {name}
FROM (SELECT {keys}, {value}, count(*) AS votes FROM {source} GROUP BY ALL)
ORDER BY {keys}, votes DESC, {value} ASC NULLS LAST"""


def half(side: str, at: str, role: str) -> str:
    hour = f"hour({at})"
    tests = {
        f"member_trips_{side}": "member_casual = 'member'",
        f"casual_trips_{side}": "member_casual = 'casual'",
        f"ebike_trips_{side}": "rideable_type = 'electric_bike'",
        f"classic_bike_trips_{side}": "rideable_type = 'classic_bike'",
        f"morning_rush_trips_{side}": f"{hour} IN (6, 7, 8, 9)",
        f"evening_rush_trips_{side}": f"{hour} IN (16, 17, 18, 19)",
        f"midday_trips_{side}": f"{hour} IN (10, 11, 12, 13, 14, 15)",
        f"night_trips_{side}": f"{hour} >= 20 OR {hour} <= 5",
    }
    counts = ",\n  ".join(f"count(*) FILTER (WHERE {t}) AS {n}" for n, t in tests.items())
    return f"""
SELECT {role}_station_id AS station_id, CAST({at} AS DATE) AS date_day,
  count(*) AS trips_{side},
  {counts}
FROM stg_trips WHERE {role}_station_id IS NOT NULL GROUP BY ALL"""


def zero(names: str) -> str:
    return ", ".join(f"coalesce({n}, 0) AS {n}" for n in names.split())


def moving(name: str, column: str, rows: int) -> str:
    return (
        f"avg({column}) OVER (PARTITION BY station_id ORDER BY date_day "
        f"ROWS {rows - 1} PRECEDING) AS {name}"
    )


BEFORE = "OVER (PARTITION BY station_id ORDER BY date_day)"

SUPPLY = (
    "typical_capacity max_capacity min_capacity avg_bikes_available avg_ebikes_available "
    "avg_docks_available avg_occupancy_ratio occupancy_volatility avg_utilization_percentage "
    "utilization_volatility avg_ebike_ratio pct_time_empty pct_time_full pct_time_operational "
    "operational_health_score rebalancing_need data_quality"
).split()
WEATHER = (
    "temperature_mean temperature_max temperature_min precipitation_sum rain_sum snowfall_sum "
    "wind_speed_max weather_condition temperature_range is_raining is_snowing is_freezing is_windy "
    "precipitation_intensity weather_severity_score is_ideal_biking_weather is_poor_biking_weather"
).split()
STARTED = (
    "trips_started trips_ended net_trips member_trips_started casual_trips_started "
    "ebike_trips_started classic_bike_trips_started morning_rush_trips_started "
    "evening_rush_trips_started"
).split()
CALENDAR = """
  isodow({d}) % 7 + 1 AS day_of_week, strftime({d}, '%A') AS day_name,
  isodow({d}) >= 6 AS is_weekend, month({d}) AS month, strftime({d}, '%B') AS month_name,
  quarter({d}) AS quarter, year({d}) AS year, CAST(strftime({d}, '%U') AS BIGINT) AS week_of_year"""

T: dict[str, str] = {}
T["trips_raw"] = feeds.TRIPS_SQL.format(events="events")
T["weather_raw"] = feeds.WEATHER_SQL.format(events="events")
T["numbered_status"] = feeds.NUMBERED_STATUS_SQL.format(events="events")
T["status_raw"] = feeds.STATUS_SQL.format(events="events")

T["stg_trips"] = """
SELECT * FROM trips_raw WHERE ride_id IS NOT NULL AND ended_at > started_at"""

T["stg_weather"] = """
SELECT DISTINCT ON (weather_date) * REPLACE (
  CAST(weather_code AS BIGINT) AS weather_code,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude)
FROM weather_raw ORDER BY weather_date, loaded_at DESC"""

T["stg_station_status"] = f"""
SELECT * REPLACE ({', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in COUNTERS)},
  is_installed = 1 AS is_installed, is_renting = 1 AS is_renting, is_returning = 1 AS is_returning)
FROM status_raw WHERE station_id IS NOT NULL AND last_reported IS NOT NULL"""

T["sized"] = f"""
SELECT *, {' + '.join(COUNTERS)} AS total_capacity,
  num_bikes_available + num_ebikes_available AS rideable
FROM stg_station_status WHERE is_installed"""

T["station_metrics"] = f"""
SELECT station_id, legacy_id, time_bucket(INTERVAL 5 MINUTE, last_reported) AS reported_at_5min,
  last_reported, {', '.join(COUNTERS)}, total_capacity,
  {ratio('rideable + num_scooters_available', 'total_capacity')} AS occupancy_ratio,
  {ratio('total_capacity - num_docks_available', 'total_capacity')} AS utilization_percentage,
  rideable = 0 AS is_empty, num_docks_available = 0 AS is_full,
  is_installed, is_renting, is_returning,
  CASE WHEN is_renting AND is_returning THEN
         CASE WHEN rideable = 0 THEN 'empty' WHEN num_docks_available = 0 THEN 'full' ELSE 'operational' END
       WHEN is_renting THEN 'not_returning'
       WHEN is_returning THEN 'not_renting'
       ELSE 'out_of_service' END AS operational_status,
  {ratio('num_ebikes_available', 'rideable')} AS ebike_ratio,
  api_last_updated, ingestion_timestamp
FROM sized"""

T["metric_days"] = "SELECT *, CAST(reported_at_5min AS DATE) AS date_day FROM station_metrics"
T["usual_capacity"] = favourite(
    "metric_days", "station_id, date_day", "total_capacity", "typical_capacity"
)
T["station_daily"] = f"""
SELECT station_id, date_day, any_value(typical_capacity) AS typical_capacity,
  max(total_capacity) AS max_capacity, min(total_capacity) AS min_capacity,
  {', '.join(f"avg({c}) AS avg_{c[4:]}" for c in COUNTERS)},
  max(num_bikes_available) AS max_bikes_available, max(num_docks_available) AS max_docks_available,
  max(num_scooters_available) AS max_scooters_available,
  min(num_bikes_available) AS min_bikes_available, min(num_docks_available) AS min_docks_available,
  min(num_scooters_available) AS min_scooters_available,
  avg(occupancy_ratio) AS avg_occupancy_ratio, stddev_samp(occupancy_ratio) AS occupancy_volatility,
  min(occupancy_ratio) AS min_occupancy_ratio, max(occupancy_ratio) AS max_occupancy_ratio,
  avg(utilization_percentage) AS avg_utilization_percentage,
  stddev_samp(utilization_percentage) AS utilization_volatility,
  avg(ebike_ratio) AS avg_ebike_ratio,
  avg(CAST(is_empty AS INT)) AS pct_time_empty, avg(CAST(is_full AS INT)) AS pct_time_full,
  avg(CAST(operational_status = 'operational' AS INT)) AS pct_time_operational,
  avg(CAST(operational_status = 'out_of_service' AS INT)) AS pct_time_out_of_service,
  count(*) AS total_observations, count(DISTINCT reported_at_5min) AS unique_5min_intervals,
  count(DISTINCT reported_at_5min) / 288.0 AS time_coverage_ratio,
  bool_and(is_installed) AS was_installed_all_day, bool_or(is_renting) AS was_renting_any_time,
  bool_or(is_returning) AS was_returning_any_time,
  min(last_reported) AS first_reported_at, max(last_reported) AS last_reported_at,
  CAST(CASE WHEN pct_time_operational < 0.5 THEN 0 WHEN pct_time_operational < 0.7 THEN 50
       WHEN pct_time_operational < 0.8 THEN 70 WHEN pct_time_operational < 0.9 THEN 80
       WHEN pct_time_operational < 0.95 THEN 90 ELSE 100 END AS BIGINT) AS operational_health_score,
  CASE WHEN pct_time_empty + pct_time_full <= 0.3 THEN 'low'
       WHEN pct_time_empty + pct_time_full <= 0.5 THEN 'medium' ELSE 'high' END AS rebalancing_need,
  CASE WHEN time_coverage_ratio >= 0.95 THEN 'excellent' WHEN time_coverage_ratio >= 0.8 THEN 'good'
       WHEN time_coverage_ratio >= 0.5 THEN 'fair' ELSE 'poor' END AS data_quality
FROM metric_days JOIN usual_capacity USING (station_id, date_day) GROUP BY station_id, date_day"""

T["ride_minutes"] = """
SELECT start_station_id AS station_id, CAST(started_at AS DATE) AS date_day,
  datesub('minute', started_at, ended_at) AS m, hour(started_at) AS h
FROM stg_trips WHERE start_station_id IS NOT NULL"""
T["arrivals"] = """
SELECT end_station_id AS station_id, CAST(ended_at AS DATE) AS date_day, hour(ended_at) AS h
FROM stg_trips WHERE end_station_id IS NOT NULL"""
T["out_half"] = half("started", "started_at", "start")
T["in_half"] = half("ended", "ended_at", "end")
T["out_peak"] = favourite("ride_minutes", "station_id, date_day", "h", "peak_start_hour")
T["in_peak"] = favourite("arrivals", "station_id, date_day", "h", "peak_end_hour")
T["durations"] = """
SELECT station_id, date_day, avg(m) AS avg_trip_duration_minutes,
  quantile_disc(m, 0.5) AS median_trip_duration_minutes,
  quantile_disc(m, 0.95) AS p95_trip_duration_minutes,
  min(m) AS min_trip_duration_minutes, max(m) AS max_trip_duration_minutes,
  stddev_samp(m) AS stddev_trip_duration_minutes
FROM ride_minutes GROUP BY ALL"""

_SPLIT = "member_trips casual_trips ebike_trips classic_bike_trips morning_rush_trips evening_rush_trips midday_trips night_trips".split()
_ALL = ["trips_started", "trips_ended", *[f"{n}_{s}" for n in _SPLIT for s in ("started", "ended")]]
T["demand_daily"] = f"""
SELECT *, trips_started - trips_ended AS net_trips,
  {ratio('member_trips_started', 'trips_started')} AS member_pct_started,
  {ratio('casual_trips_started', 'trips_started')} AS casual_pct_started,
  {ratio('ebike_trips_started', 'trips_started')} AS ebike_pct_started,
  CASE WHEN trips_started - trips_ended > 10 THEN 'net_source'
       WHEN trips_ended - trips_started > 10 THEN 'net_sink'
       WHEN trips_started + trips_ended = 0 THEN 'inactive' ELSE 'balanced' END AS station_flow_pattern,
  {ratio('morning_rush_trips_started + evening_rush_trips_started', 'trips_started')} AS rush_hour_intensity
FROM (
  SELECT station_id, date_day, {zero(' '.join(_ALL))},
    avg_trip_duration_minutes, median_trip_duration_minutes, p95_trip_duration_minutes,
    min_trip_duration_minutes, max_trip_duration_minutes, stddev_trip_duration_minutes,
    peak_start_hour, peak_end_hour
  FROM out_half FULL JOIN in_half USING (station_id, date_day)
  LEFT JOIN durations USING (station_id, date_day)
  LEFT JOIN out_peak USING (station_id, date_day)
  LEFT JOIN in_peak USING (station_id, date_day))"""

T["weather_enrich"] = """
SELECT station_daily.*, temperature_max, temperature_min, temperature_mean, precipitation_sum,
  rain_sum, snowfall_sum, precipitation_hours, weather_code, wind_speed_max, wind_gusts_max,
  CASE WHEN weather_code IS NULL THEN 'unknown' WHEN weather_code = 0 THEN 'clear'
       WHEN weather_code <= 3 THEN 'partly_cloudy'
       WHEN weather_code IN (45, 48) THEN 'foggy'
       WHEN weather_code IN (51, 53, 55, 56, 57) THEN 'drizzle'
       WHEN weather_code IN (61, 63, 65, 66, 67, 80, 81, 82) THEN 'rain'
       WHEN weather_code IN (71, 73, 75, 77, 85, 86) THEN 'snow'
       WHEN weather_code IN (95, 96, 99) THEN 'thunderstorm' ELSE 'other' END AS weather_condition,
  CASE WHEN temperature_mean >= 27 THEN 'hot' WHEN temperature_mean >= 18 THEN 'warm'
       WHEN temperature_mean >= 10 THEN 'mild' WHEN temperature_mean >= 0 THEN 'cold'
       WHEN temperature_mean < 0 THEN 'freezing' ELSE 'unknown' END AS temperature_range,
  precipitation_sum > 0 AS is_raining, snowfall_sum > 0 AS is_snowing,
  temperature_mean <= 0 AS is_freezing, wind_speed_max > 32 AS is_windy,
  CASE WHEN precipitation_sum = 0 THEN 'none' WHEN precipitation_sum < 0.1 THEN 'light'
       WHEN precipitation_sum < 0.3 THEN 'moderate' ELSE 'heavy' END AS precipitation_intensity,
  CAST(20 * coalesce(CAST(precipitation_sum > 0 AS INT), 0) + 30 * coalesce(CAST(snowfall_sum > 0 AS INT), 0)
    + 25 * coalesce(CAST(temperature_mean < 0 AS INT), 0) + 15 * coalesce(CAST(temperature_mean > 32 AS INT), 0)
    + 10 * coalesce(CAST(wind_speed_max > 32 AS INT), 0) AS BIGINT) AS weather_severity_score,
  coalesce(weather_code <= 3 AND temperature_mean >= 13 AND temperature_mean <= 24
    AND precipitation_sum = 0 AND wind_speed_max < 24, false) AS is_ideal_biking_weather,
  coalesce(precipitation_sum > 0.3, false) OR coalesce(snowfall_sum > 0, false)
    OR coalesce(temperature_mean < 0 OR temperature_mean > 32, false)
    OR coalesce(wind_speed_max > 40, false) AS is_poor_biking_weather
FROM station_daily LEFT JOIN stg_weather ON weather_date = date_day"""

T["supply_demand"] = f"""
SELECT station_id, date_day, {', '.join(SUPPLY)}, {zero(' '.join(STARTED))},
  avg_trip_duration_minutes, median_trip_duration_minutes, p95_trip_duration_minutes,
  member_pct_started, ebike_pct_started, station_flow_pattern, rush_hour_intensity,
  {', '.join(WEATHER)}
FROM weather_enrich FULL JOIN demand_daily USING (station_id, date_day)"""

T["balanced"] = f"""
SELECT *, {ratio('trips_started', 'avg_bikes_available')} AS trips_per_bike_ratio,
  {ratio('trips_started', 'typical_capacity')} AS demand_capacity_ratio,
  CASE WHEN avg_bikes_available = 0 THEN 100.0 WHEN trips_started = 0 THEN -100.0
       WHEN avg_bikes_available IS NOT NULL
       THEN least(100.0, greatest(-100.0, 50 * (trips_started / avg_bikes_available - 1)))
  END AS supply_demand_balance_score,
  trips_started + trips_ended AS total_trip_activity,
  {CALENDAR.format(d='date_day')}
FROM supply_demand"""

T["moving"] = f"""
SELECT *, {moving('avg_bikes_available_7d', 'avg_bikes_available', 7)},
  {moving('avg_occupancy_ratio_7d', 'avg_occupancy_ratio', 7)},
  {moving('avg_utilization_7d', 'avg_utilization_percentage', 7)},
  {moving('avg_pct_time_empty_7d', 'pct_time_empty', 7)},
  {moving('avg_pct_time_full_7d', 'pct_time_full', 7)},
  {moving('avg_trips_started_7d', 'trips_started', 7)},
  {moving('avg_trips_ended_7d', 'trips_ended', 7)},
  {moving('avg_total_activity_7d', 'total_trip_activity', 7)},
  {moving('avg_trips_started_28d', 'trips_started', 28)},
  {moving('avg_occupancy_ratio_28d', 'avg_occupancy_ratio', 28)},
  lag(trips_started) {BEFORE} AS trips_started_prev_day,
  lag(avg_occupancy_ratio) {BEFORE} AS occupancy_ratio_prev_day,
  lag(trips_started, 7) {BEFORE} AS trips_started_same_day_last_week
FROM balanced"""

T["station_daily_fact"] = f"""
SELECT *, trips_started - trips_started_prev_day AS trips_started_change_dod,
  trips_started - trips_started_same_day_last_week AS trips_started_change_wow,
  100 * {ratio('trips_started - avg_trips_started_7d', 'avg_trips_started_7d')}
    AS trips_started_deviation_pct_7d,
  CASE WHEN trips_started > avg_trips_started_7d * 1.2::DOUBLE THEN 'surge'
       WHEN trips_started > avg_trips_started_7d * 1.1::DOUBLE THEN 'above_average'
       WHEN trips_started < avg_trips_started_7d * 0.8::DOUBLE THEN 'decline'
       WHEN trips_started < avg_trips_started_7d * 0.9::DOUBLE THEN 'below_average'
       ELSE 'stable' END AS demand_trend
FROM moving"""

T["places"] = """
SELECT start_station_id AS station_id, start_station_name AS station_name,
  start_lat AS latitude, start_lng AS longitude
FROM stg_trips WHERE start_station_id IS NOT NULL AND start_station_name IS NOT NULL
UNION
SELECT end_station_id, end_station_name, end_lat, end_lng
FROM stg_trips WHERE end_station_id IS NOT NULL AND end_station_name IS NOT NULL"""
T["place_names"] = favourite("places", "station_id", "station_name", "name")
T["place_lats"] = favourite("places", "station_id", "latitude", "lat")
T["place_lngs"] = favourite("places", "station_id", "longitude", "lng")
T["station_master"] = f"""
SELECT station_id, name AS station_name, lat AS latitude, lng AS longitude,
  CAST(NULL AS BIGINT) AS capacity, CAST(NULL AS VARCHAR) AS region, true AS is_active,
  {NOW} AS updated_at
FROM place_names JOIN place_lats USING (station_id) JOIN place_lngs USING (station_id)"""

T["dim_station"] = f"""
SELECT {key('station_id', f"'{NOW_TEXT}'")} AS station_key, station_id, station_name, latitude,
  longitude, capacity, coalesce(region, 'Unknown') AS region, is_active,
  CASE WHEN latitude IS NULL THEN 'Unknown' WHEN latitude <= 40.65::DOUBLE THEN
         CASE WHEN longitude < -74 THEN 'Brooklyn' ELSE 'Queens' END
       WHEN latitude <= 40.7::DOUBLE THEN 'Lower Manhattan'
       WHEN latitude <= 40.75::DOUBLE THEN 'Midtown Manhattan'
       WHEN latitude <= 40.8::DOUBLE THEN 'Upper Manhattan' ELSE 'Bronx' END AS borough,
  CASE WHEN capacity >= 50 THEN 'large' WHEN capacity >= 30 THEN 'medium'
       WHEN capacity >= 15 THEN 'small' ELSE 'micro' END AS station_size,
  {NOW} AS effective_date, CAST(NULL AS TIMESTAMP) AS end_date, true AS is_current, updated_at
FROM station_master
UNION ALL
SELECT md5('-1'), '-1', 'Unknown Station', NULL, NULL, NULL, 'Unknown', false, 'Unknown', 'unknown',
  TIMESTAMP '1900-01-01 00:00:00', NULL, true, NULL"""

T["fact_span"] = """
SELECT min(date_day) AS lo, max(date_day) AS hi FROM (
  SELECT date_day FROM metric_days UNION ALL SELECT date_day FROM ride_minutes
  UNION ALL SELECT date_day FROM arrivals)"""
T["date_spine"] = """
SELECT CAST(d AS DATE) AS full_date
FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS d FROM fact_span)"""
T["dim_date"] = f"""
SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, full_date,
  day(full_date) AS day_of_month, dayofyear(full_date) AS day_of_year,
  {CALENDAR.format(d='full_date')},
  strftime(full_date, '%a') AS day_name_short, weekofyear(full_date) AS iso_week_of_year,
  (day(full_date) + 6) // 7 AS week_of_month, strftime(full_date, '%b') AS month_name_short,
  'Q' || quarter(full_date) AS quarter_name, year(full_date) AS fiscal_year,
  quarter(full_date) AS fiscal_quarter, isodow(full_date) <= 5 AS is_weekday,
  day(full_date) = 1 AS is_month_start, day(full_date + 1) = 1 AS is_month_end,
  day(full_date) = 1 AND month(full_date) IN (1, 4, 7, 10) AS is_quarter_start,
  day(full_date + 1) = 1 AND month(full_date) IN (3, 6, 9, 12) AS is_quarter_end,
  day(full_date) = 1 AND month(full_date) = 1 AS is_year_start,
  day(full_date) = 31 AND month(full_date) = 12 AS is_year_end,
  datediff('day', {AS_OF}, full_date) AS days_from_today,
  CAST((CAST(date_trunc('week', full_date + 1) AS DATE) - CAST(date_trunc('week', {AS_OF} + 1) AS DATE)) // 7 AS BIGINT) AS weeks_from_today,
  datediff('month', {AS_OF}, full_date) AS months_from_today,
  CASE month(full_date) // 3 % 4 WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer'
       ELSE 'Fall' END AS season,
  month(full_date) IN (5, 6, 7, 8, 9) AS is_peak_biking_season,
  strftime(full_date, '%m%d') >= '0615' AND strftime(full_date, '%m%d') <= '0831' AS is_summer_vacation
FROM date_spine"""

T["dim_time"] = """
SELECT h AS time_key, h AS hour, CASE WHEN h % 12 = 0 THEN 12 ELSE h % 12 END AS hour_12,
  CASE WHEN h >= 12 THEN 'PM' ELSE 'AM' END AS am_pm,
  concat(CASE WHEN h % 12 = 0 THEN 12 ELSE h % 12 END, ':00 ', CASE WHEN h >= 12 THEN 'PM' ELSE 'AM' END) AS hour_name,
  CASE WHEN h <= 5 THEN 'late_night' WHEN h <= 9 THEN 'morning_rush' WHEN h <= 15 THEN 'midday'
       WHEN h <= 19 THEN 'evening_rush' ELSE 'evening' END AS time_bucket,
  h IN (7, 8, 9, 16, 17, 18, 19) AS is_rush_hour, h IN (6, 7, 8, 9) AS is_morning_rush,
  h IN (16, 17, 18, 19) AS is_evening_rush, h >= 9 AND h <= 17 AS is_business_hours,
  h >= 7 AND h <= 22 AS is_peak_biking_hours,
  CASE WHEN h <= 5 THEN 'night' WHEN h <= 13 THEN 'morning' WHEN h <= 19 THEN 'afternoon'
       ELSE 'evening' END AS shift
FROM range(24) AS r(h)"""

T["dim_user_type"] = """
SELECT * FROM (VALUES
  (1::BIGINT, 'casual', 'Casual Rider', 'Pay-per-ride user without subscription', false),
  (2::BIGINT, 'member', 'Member', 'Annual or monthly subscription holder with unlimited rides', true),
  (3::BIGINT, 'unknown', 'Unknown', 'User type not specified or missing', NULL)
) AS u(user_type_key, user_type_id, user_type_name, user_type_description, has_subscription)"""

T["fct_trips"] = f"""
SELECT md5(ride_id) AS trip_key, ride_id AS trip_id,
  coalesce(a.station_key, md5('-1')) AS start_station_key,
  coalesce(b.station_key, md5('-1')) AS end_station_key,
  CAST(strftime(started_at, '%Y%m%d') AS BIGINT) AS start_date_key,
  CAST(strftime(ended_at, '%Y%m%d') AS BIGINT) AS end_date_key,
  hour(started_at) AS start_hour_key, hour(ended_at) AS end_hour_key,
  coalesce(user_type_key, 3) AS user_type_key, started_at, ended_at,
  datesub('minute', started_at, ended_at) AS trip_duration_minutes,
  datesub('second', started_at, ended_at) AS trip_duration_seconds,
  round(12742 * asin(sqrt(
    sin((end_lat - start_lat) * 3.14159265359::DOUBLE / 360) ** 2
    + cos(start_lat * 3.14159265359::DOUBLE / 180) * cos(end_lat * 3.14159265359::DOUBLE / 180)
    * sin((end_lng - start_lng) * 3.14159265359::DOUBLE / 360) ** 2)), 2) AS trip_distance_km,
  start_lat AS start_latitude, start_lng AS start_longitude,
  end_lat AS end_latitude, end_lng AS end_longitude, rideable_type AS bike_type,
  start_station_id = end_station_id AS is_round_trip,
  datesub('minute', started_at, ended_at) < 5 AS is_short_trip,
  datesub('minute', started_at, ended_at) > 60 AS is_long_trip
FROM stg_trips
LEFT JOIN dim_station a ON a.station_id = start_station_id
LEFT JOIN dim_station b ON b.station_id = end_station_id
LEFT JOIN dim_user_type ON user_type_id = member_casual"""

_ADDED = (
    "trips_started trips_ended net_trips total_trip_activity member_trips_started casual_trips_started "
    "ebike_trips_started classic_bike_trips_started morning_rush_trips_started evening_rush_trips_started"
).split()
_AVERAGED = (
    "avg_bikes_available avg_ebikes_available avg_docks_available avg_occupancy_ratio occupancy_volatility "
    "avg_utilization_percentage utilization_volatility avg_ebike_ratio pct_time_empty pct_time_full "
    "pct_time_operational trips_per_bike_ratio demand_capacity_ratio supply_demand_balance_score "
    "avg_bikes_available_7d avg_occupancy_ratio_7d avg_utilization_7d avg_pct_time_empty_7d "
    "avg_pct_time_full_7d avg_trips_started_7d avg_trips_ended_7d avg_total_activity_7d "
    "avg_trips_started_28d avg_occupancy_ratio_28d trips_started_prev_day occupancy_ratio_prev_day "
    "trips_started_same_day_last_week trips_started_change_dod trips_started_change_wow "
    "trips_started_deviation_pct_7d"
).split()
_HIGHEST = (
    "typical_capacity max_capacity min_capacity operational_health_score avg_trip_duration_minutes "
    "median_trip_duration_minutes p95_trip_duration_minutes member_pct_started ebike_pct_started "
    "rush_hour_intensity temperature_mean temperature_max temperature_min precipitation_sum rain_sum "
    "snowfall_sum wind_speed_max temperature_range precipitation_intensity weather_severity_score "
    "rebalancing_need data_quality station_flow_pattern weather_condition is_raining is_snowing "
    "is_freezing is_windy is_ideal_biking_weather is_poor_biking_weather demand_trend day_of_week "
    "day_name is_weekend month month_name quarter year week_of_year"
).split()
T["fct_station_day"] = f"""
SELECT coalesce(d.station_key, md5('-1')) AS station_key,
  CAST(strftime(date_day, '%Y%m%d') AS BIGINT) AS date_key, date_day,
  {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in _ADDED)},
  {', '.join(f'avg({c}) AS {c}' for c in _AVERAGED)},
  {', '.join(f'max({c}) AS {c}' for c in _HIGHEST)}
FROM station_daily_fact LEFT JOIN dim_station d USING (station_id) GROUP BY 1, 2, 3"""

T["station_operations"] = f"""
SELECT *, row_number() OVER (PARTITION BY date_day ORDER BY trips_started DESC, station_id) AS daily_activity_rank
FROM (
  SELECT full_date AS date_day, d.day_name, d.is_weekend, d.month_name, d.year, s.station_id, station_name,
    latitude, longitude, capacity, region, avg_bikes_available, avg_ebikes_available,
    avg_docks_available, avg_occupancy_ratio, avg_utilization_percentage AS avg_utilization_pct,
    occupancy_volatility, pct_time_empty, pct_time_full, operational_health_score, rebalancing_need,
    trips_started, trips_ended, net_trips, station_flow_pattern, typical_capacity, max_capacity,
    min_capacity, avg_bikes_available_7d AS rolling_7d_avg_bikes,
    avg_occupancy_ratio_7d AS rolling_7d_avg_occupancy,
    avg_utilization_7d AS rolling_7d_avg_utilization,
    trips_started_change_dod AS day_over_day_trips_change,
    trips_started_change_wow AS week_over_week_trips_change, full_date = {AS_OF} AS is_current_day,
    CASE rebalancing_need WHEN 'high' THEN '🔴 High Priority' WHEN 'medium' THEN '🟡 Medium Priority'
      ELSE '🟢 Low Priority' END AS priority_indicator,
    CASE WHEN trips_started < 5 THEN 'Very Low' WHEN trips_started < 20 THEN 'Low'
      WHEN trips_started < 50 THEN 'Medium' WHEN trips_started < 100 THEN 'High'
      ELSE 'Very High' END AS activity_category
  FROM fct_station_day f JOIN dim_station s USING (station_key) JOIN dim_date d USING (date_key)
  WHERE full_date BETWEEN {AS_OF} - 30 AND {AS_OF})"""

T["last_reports"] = f"""
SELECT DISTINCT ON (station_id) *, datesub('minute', last_reported, {NOW}) AS age,
  num_bikes_available <= 3 AS few_bikes, num_docks_available <= 3 AS few_docks
FROM station_metrics WHERE last_reported >= {NOW} - INTERVAL 24 HOUR
ORDER BY station_id, last_reported DESC"""
T["realtime_status"] = """
SELECT m.station_id, station_name, latitude, longitude, capacity, region,
  CASE WHEN capacity >= 50 THEN 'Large' WHEN capacity >= 30 THEN 'Medium'
    WHEN capacity >= 15 THEN 'Small' ELSE 'Micro' END AS station_type,
  CASE WHEN region IS NULL THEN 'Unknown' ELSE region END AS borough,
  CASE WHEN capacity >= 50 THEN 'extra_large' WHEN capacity >= 35 THEN 'large'
    WHEN capacity >= 25 THEN 'medium' WHEN capacity >= 15 THEN 'small' ELSE 'unknown' END AS station_size,
  num_bikes_available, num_ebikes_available, num_bikes_disabled, num_docks_available,
  num_docks_disabled, num_scooters_available, num_scooters_unavailable,
  num_bikes_available + num_ebikes_available AS total_bikes_available, total_capacity,
  round(occupancy_ratio, 3) AS occupancy_ratio,
  round(100 * utilization_percentage, 1) AS utilization_pct, is_installed, is_renting, is_returning,
  coalesce(is_empty, false) AS eightd_has_available_keys,
  CASE WHEN is_renting AND is_returning THEN 'Operational' WHEN is_renting THEN 'Not Returning'
    WHEN is_returning THEN 'Not Renting' ELSE 'Out of Service' END AS operational_status,
  CASE WHEN is_empty THEN 'Empty' WHEN is_full THEN 'Full' WHEN few_bikes THEN 'Low Bikes'
    WHEN few_docks THEN 'Low Docks' ELSE 'Available' END AS availability_status,
  CASE WHEN is_empty OR is_full THEN 'high' WHEN few_bikes OR few_docks THEN 'medium'
    ELSE 'low' END AS rebalancing_need,
  CASE WHEN is_empty OR is_full THEN '🔴 High Priority'
    WHEN few_bikes OR few_docks THEN '🟡 Medium Priority' ELSE '🟢 Low Priority' END AS priority_indicator,
  last_reported, api_last_updated, ingestion_timestamp, age AS minutes_since_last_report,
  CASE WHEN age > 60 THEN 'Very Stale' WHEN age > 30 THEN 'Stale' WHEN age > 10 THEN 'Recent'
    ELSE 'Fresh' END AS data_freshness
FROM last_reports r LEFT JOIN station_master m ON m.station_id = r.station_id"""

T["trip_cube"] = f"""
SELECT full_date AS date_day, d.day_name, d.is_weekend, d.month_name, d.quarter, d.year, d.week_of_year,
  t.hour AS hour_of_day, time_bucket AS time_of_day_name, is_rush_hour, user_type_name,
  has_subscription AS is_member, bike_type AS rideable_type, count(*) AS trip_count,
  avg(trip_duration_minutes) AS avg_trip_duration, min(trip_duration_minutes) AS min_trip_duration,
  max(trip_duration_minutes) AS max_trip_duration,
  stddev_samp(trip_duration_minutes) AS stddev_trip_duration,
  count(*) FILTER (WHERE trip_duration_minutes < 5) AS very_short_trips,
  count(*) FILTER (WHERE trip_duration_minutes BETWEEN 5 AND 14) AS short_trips,
  count(*) FILTER (WHERE trip_duration_minutes BETWEEN 15 AND 29) AS medium_trips,
  count(*) FILTER (WHERE trip_duration_minutes BETWEEN 30 AND 59) AS long_trips,
  count(*) FILTER (WHERE trip_duration_minutes >= 60) AS very_long_trips,
  count(*) FILTER (WHERE has_subscription) AS member_trips,
  count(*) FILTER (WHERE NOT has_subscription) AS casual_trips,
  count(*) FILTER (WHERE bike_type = 'electric_bike') AS electric_bike_trips,
  count(*) FILTER (WHERE bike_type = 'classic_bike') AS classic_bike_trips,
  count(DISTINCT start_station_key) AS unique_start_stations,
  count(DISTINCT end_station_key) AS unique_end_stations
FROM fct_trips f JOIN dim_date d ON d.date_key = start_date_key
JOIN dim_time t ON t.time_key = start_hour_key JOIN dim_user_type USING (user_type_key)
WHERE full_date BETWEEN {AS_OF} - 90 AND {AS_OF} GROUP BY ALL"""
_MIX = "100.0 * {0}_trips / trip_count AS {0}_pct"
T["trip_analytics_daily"] = f"""
SELECT *, {', '.join(_MIX.format(n) for n in ('member', 'casual', 'electric_bike', 'classic_bike'))},
  row_number() OVER (PARTITION BY date_day
    ORDER BY trip_count DESC, hour_of_day, user_type_name, rideable_type) AS hourly_rank_by_day,
  row_number() OVER (
    ORDER BY date_day DESC, trip_count DESC, hour_of_day, user_type_name, rideable_type) AS overall_rank
FROM trip_cube"""

T["route_cube"] = f"""
SELECT a.station_id AS start_station_id, a.station_name AS start_station_name,
  a.latitude AS start_latitude, a.longitude AS start_longitude, b.station_id AS end_station_id,
  b.station_name AS end_station_name, b.latitude AS end_latitude, b.longitude AS end_longitude,
  user_type_name, has_subscription AS is_member, bike_type AS rideable_type, count(*) AS trip_count,
  avg(trip_duration_minutes) AS avg_duration_minutes, min(trip_duration_minutes) AS min_duration_minutes,
  max(trip_duration_minutes) AS max_duration_minutes,
  count(*) FILTER (WHERE has_subscription) AS member_trips,
  count(*) FILTER (WHERE NOT has_subscription) AS casual_trips,
  count(*) FILTER (WHERE bike_type = 'electric_bike') AS electric_trips,
  count(*) FILTER (WHERE bike_type = 'classic_bike') AS classic_trips
FROM fct_trips f LEFT JOIN dim_station a ON a.station_key = start_station_key
LEFT JOIN dim_station b ON b.station_key = end_station_key
JOIN dim_date d ON d.date_key = start_date_key JOIN dim_user_type USING (user_type_key)
WHERE full_date BETWEEN {AS_OF} - 30 AND {AS_OF} AND start_station_key <> end_station_key GROUP BY ALL"""
T["routes"] = f"""
SELECT *, {', '.join(_MIX.format(n) for n in ('member', 'casual', 'electric', 'classic'))},
  row_number() OVER (ORDER BY trip_count DESC, start_station_id, end_station_id, user_type_name,
    rideable_type) AS popularity_rank,
  CASE WHEN trip_count < 20 THEN 'Very Low' WHEN trip_count < 100 THEN 'Low'
    WHEN trip_count < 500 THEN 'Moderate' WHEN trip_count < 1000 THEN 'Popular'
    ELSE 'Very Popular' END AS route_popularity_category
FROM route_cube"""

_FLAGS = "is_ideal_biking_weather is_poor_biking_weather is_raining is_snowing is_freezing is_windy".split()
T["network_days"] = f"""
SELECT full_date AS date_day, d.day_name, d.is_weekend, d.month_name, season, d.year, d.quarter,
  max(temperature_mean) AS temperature_celsius, max(temperature_range) AS temperature_range,
  max(precipitation_sum) AS precipitation_mm, max(wind_speed_max) AS wind_speed_kmh,
  max(weather_condition) AS weather_condition, max(weather_severity_score) AS weather_severity_score,
  {', '.join(f'CAST(max(CAST({c} AS INT)) AS BIGINT) AS {c}' for c in _FLAGS)},
  CAST(sum(trips_started) AS BIGINT) AS total_trips_started,
  CAST(sum(trips_ended) AS BIGINT) AS total_trips_ended,
  avg(avg_trip_duration_minutes) AS avg_trip_duration, avg(avg_bikes_available) AS avg_bikes_available,
  avg(avg_utilization_percentage) AS avg_utilization_pct,
  avg(operational_health_score) AS avg_health_score, count(DISTINCT station_key) AS stations_reporting
FROM fct_station_day f JOIN dim_date d USING (date_key)
WHERE full_date BETWEEN {AS_OF} - 90 AND {AS_OF} GROUP BY ALL"""
T["weather_impact"] = f"""
SELECT *, CASE WHEN is_ideal_biking_weather = 1 THEN 'Ideal Weather'
    WHEN is_poor_biking_weather = 1 THEN 'Poor Weather' ELSE 'Normal Weather' END AS weather_category,
  CASE WHEN temperature_celsius >= 30 OR temperature_celsius IS NULL THEN 'Hot'
    WHEN temperature_celsius >= 20 THEN 'Warm' WHEN temperature_celsius >= 10 THEN 'Mild'
    WHEN temperature_celsius >= 0 THEN 'Cold' ELSE 'Freezing' END AS temperature_category,
  CASE WHEN precipitation_mm >= 10 OR precipitation_mm IS NULL THEN 'Heavy Rain'
    WHEN precipitation_mm >= 2.5 THEN 'Moderate Rain' WHEN precipitation_mm = 0 THEN 'No Rain'
    ELSE 'Light Rain' END AS precipitation_category,
  CASE WHEN total_trips_started < 5000 THEN 'Very Low' WHEN total_trips_started < 15000 THEN 'Low'
    WHEN total_trips_started < 30000 THEN 'Medium' WHEN total_trips_started < 50000 THEN 'High'
    ELSE 'Very High' END AS trip_volume_category,
  {ratio('total_trips_started', 'stations_reporting')} AS avg_trips_per_station
FROM network_days"""


def with_tables(body: str) -> str:
    """``body`` preceded by the tables it needs, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\w+", text)):
            if word in T and word not in needed:
                needed.add(word)
                visit(T[word])

    visit(body)
    tables = ",\n".join(f"{name} AS MATERIALIZED ({T[name]})" for name in T if name in needed)
    return f"WITH {tables}\n{body}" if needed else body
