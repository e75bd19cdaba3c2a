"""Expected result of each query, as one SQL text."""

from __future__ import annotations

from oracle.tables import AS_OF, NOW, T, key, moving, with_tables

# Columns that hold doubles wherever they occur; compared with six decimals.
_DOUBLES = """
all_avg avg_bikes avg_bikes_available avg_bikes_available_7d avg_bikes_disabled avg_daily_trips
avg_docks_available avg_docks_disabled avg_duration avg_duration_minutes avg_duration_weighted
avg_ebike_ratio avg_ebikes_available avg_health_score avg_occupancy avg_occupancy_ratio
avg_occupancy_ratio_28d avg_occupancy_ratio_7d avg_pct_time_empty_7d avg_pct_time_full_7d
avg_scooters_available avg_scooters_unavailable avg_temp avg_temperature avg_total_activity_7d
avg_trip_duration avg_trip_duration_minutes avg_trips avg_trips_ended_7d avg_trips_per_route
avg_trips_per_station avg_trips_started_28d avg_trips_started_7d avg_utilization_7d
avg_utilization_pct avg_utilization_percentage casual_pct casual_pct_started classic_bike_pct
classic_pct demand_capacity_ratio ebike_pct_started ebike_ratio electric_bike_pct
electric_bike_pct_weighted electric_pct end_lat end_latitude end_lng end_longitude ended_7d
largest_28 latitude longitude max_occupancy_ratio member_pct member_pct_started
member_pct_weighted min_occupancy_ratio occupancy_ratio occupancy_ratio_prev_day
occupancy_volatility orders_7 pct_time_empty pct_time_full pct_time_operational
pct_time_out_of_service precipitation precipitation_hours precipitation_mm precipitation_mm_intercept
precipitation_mm_r precipitation_mm_slope precipitation_sum rain_sum rolling_7d_avg_bikes
rolling_7d_avg_occupancy rolling_7d_avg_utilization rush_hour_intensity share_pct snowfall_sum
start_lat start_latitude start_lng start_longitude started_28d started_7d stddev_trip_duration
stddev_trip_duration_minutes supply_demand_balance_score temperature temperature_celsius
temperature_celsius_intercept temperature_celsius_r temperature_celsius_slope temperature_max
temperature_mean temperature_min time_coverage_ratio total_distance trip_distance_km
trips_per_bike_ratio trips_started_deviation_pct_7d utilization_pct utilization_percentage
utilization_volatility wind wind_gusts_max wind_speed_kmh wind_speed_max
""".split()
# In the fact these averages of whole numbers are doubles, elsewhere plain numbers.
_FACT_DOUBLES = (
    "trips_started_prev_day trips_started_same_day_last_week trips_started_change_dod "
    "trips_started_change_wow day_over_day_trips_change week_over_week_trips_change"
).split()


def rounded(body: str, doubles: list[str], rest: bool = True) -> str:
    """``body`` (a table or a parenthesised query) with its doubles cut to six decimals."""
    names = "|".join(doubles)
    others = ", ".join(f"'{d}'" for d in doubles)
    plain = f", COLUMNS(lambda c: c NOT IN ({others}))" if rest else ""
    return with_tables(f"SELECT round(CAST(COLUMNS('^({names})$') AS DOUBLE), 6) AS '\\1'{plain} FROM {body}")


def plain(body: str) -> str:
    return with_tables(body)


Q: dict[str, str] = {}

# --- models ------------------------------------------------------------------------
for name in (
    "stg_trips station_metrics station_daily demand_daily weather_enrich supply_demand "
    "station_daily_fact station_master dim_station realtime_status trip_analytics_daily routes "
    "weather_impact fct_trips"
).split():
    Q[name] = rounded(name, _DOUBLES)
for name in ("fct_station_day", "station_operations"):
    Q[name] = rounded(name, _DOUBLES + _FACT_DOUBLES)
# Stations with a capacity and a region.
_NUMBER = "CAST(station_id[2:] AS BIGINT)"
_FURNISHED = f"""(SELECT station_id, CASE WHEN {_NUMBER} % 8 <> 0 THEN {_NUMBER} * 3 - 10 END AS capacity,
  CASE WHEN {_NUMBER} % 9 <> 0 THEN regions[{_NUMBER} % len(regions) + 1] END AS region
FROM station_master, (SELECT ['Manhattan and around', 'Brooklyn and around', 'Queens and around',
  'Bronx and around', 'Staten and around', 'Hoboken'] AS regions))"""
Q["realtime_places"] = plain(
    f"""SELECT f.station_id, f.capacity, f.region,
  CASE WHEN f.region LIKE '%Staten%' THEN 'Staten Island' WHEN f.region LIKE '%and around'
    THEN f.region[:strpos(f.region, ' ') - 1] ELSE 'Unknown' END AS borough,
  CASE WHEN f.capacity >= 50 THEN 'Large' WHEN f.capacity >= 30 THEN 'Medium'
    WHEN f.capacity >= 15 THEN 'Small' ELSE 'Micro' END AS station_type,
  CASE WHEN f.capacity >= 50 THEN 'extra_large' WHEN f.capacity >= 35 THEN 'large'
    WHEN f.capacity >= 25 THEN 'medium' WHEN f.capacity >= 15 THEN 'small' ELSE 'unknown' END AS station_size
FROM realtime_status r LEFT JOIN {_FURNISHED} f ON f.station_id = r.station_id"""
)
Q["station_sizes"] = plain(
    f"""SELECT station_id, capacity, coalesce(region, 'Unknown') AS region,
  CASE WHEN capacity >= 50 THEN 'large' WHEN capacity >= 30 THEN 'medium' WHEN capacity >= 15 THEN 'small'
    ELSE 'micro' END AS station_size FROM {_FURNISHED}
UNION ALL SELECT '-1', NULL, 'Unknown', 'unknown'"""
)
Q["stg_weather"] = rounded("(SELECT * RENAME (loaded_at AS latest_load) FROM stg_weather)", _DOUBLES)
Q["stg_station_status"] = plain("SELECT * FROM stg_station_status")
Q["dim_date"] = plain("SELECT * FROM dim_date")
Q["dim_time_usage"] = plain(
    """SELECT dim_time.*, count(ride_id) AS trips
FROM dim_time LEFT JOIN stg_trips ON hour(started_at) = time_key GROUP BY ALL"""
)
Q["dim_user_type_usage"] = plain(
    """SELECT dim_user_type.*, count(ride_id) AS trips
FROM dim_user_type LEFT JOIN stg_trips ON coalesce(member_casual, 'unknown') = user_type_id GROUP BY ALL"""
)

# --- operators -----------------------------------------------------------------------
Q["dedupe_latest"] = plain(
    """SELECT DISTINCT ON (station_id) * FROM stg_station_status
ORDER BY station_id, last_reported DESC"""
)
Q["user_key_fallback"] = plain(
    """SELECT ride_id, CAST(CASE member_casual WHEN 'casual' THEN 1 WHEN 'member' THEN 2 ELSE 3 END
  AS BIGINT) AS user_type_key FROM stg_trips"""
)
Q["late_dim_fallback"] = plain(
    """SELECT CAST(strftime(started_at, '%Y%m%d') AS BIGINT) AS start_date_key,
  started_at >= DATE '2024-01-20' AS is_late, count(*) AS trips FROM stg_trips GROUP BY ALL"""
)
Q["star_lookup"] = plain(
    """SELECT ride_id, a.station_name AS from_name, b.station_name AS to_name,
  dayname(started_at) AS start_day, dayname(ended_at) AS end_day,
  s.time_bucket AS start_bucket, e.time_bucket AS end_bucket, user_type_name AS rider
FROM stg_trips LEFT JOIN dim_station a ON a.station_id = start_station_id
LEFT JOIN dim_station b ON b.station_id = end_station_id
LEFT JOIN dim_user_type ON user_type_id = member_casual
JOIN dim_time s ON s.time_key = hour(started_at) JOIN dim_time e ON e.time_key = hour(ended_at)"""
)

_RUN1, _RUN2 = "2024-01-01 00:00:00", "2024-01-15 00:00:00"


def versions(reopened: str, missing: str) -> str:
    """Versions after two snapshot runs; ``reopened`` and ``missing`` test a station."""
    moved = "CASE WHEN n % 2 = 0 THEN station_name || ' (moved)' ELSE station_name END"
    stations = "(SELECT *, CAST(station_id[2:] AS INT) AS n FROM station_master)"
    return f"""
SELECT station_id, station_name, is_active, {key('station_id', f"'{_RUN1}+00'")} AS version_id,
  TIMESTAMP '{_RUN1}' AS valid_from,
  CASE WHEN {reopened} OR {missing} THEN TIMESTAMP '{_RUN2}' END AS valid_to
FROM {stations}
UNION ALL
SELECT station_id, {moved}, is_active, {key('station_id', f"'{_RUN2}+00'")},
  TIMESTAMP '{_RUN2}', NULL
FROM {stations} WHERE {reopened} AND NOT {missing}"""


Q["scd2_apply"] = plain(versions("n % 2 = 0", "false"))
Q["scd2_timestamp"] = plain(versions("true", "false"))
Q["scd2_deletes"] = plain(versions("n % 2 = 0", "n = 29"))
Q["pit_join"] = plain(
    f"""SELECT start_station_id, station_name, valid_from, count(*) AS trips
FROM stg_trips LEFT JOIN ({versions('n % 2 = 0', 'false')}) v
  ON v.station_id = start_station_id AND started_at >= valid_from
  AND (valid_to IS NULL OR started_at < valid_to)
GROUP BY ALL"""
)
Q["salted_lookup"] = plain(
    """SELECT start_station_id AS station_id, station_name, count(*) AS trips
FROM stg_trips LEFT JOIN dim_station ON station_id = start_station_id GROUP BY ALL"""
)


def _favourite(value: str) -> str:
    return f"""(SELECT DISTINCT ON (start_station_id) start_station_id, {value}
  FROM (SELECT start_station_id, {value}, count(*) AS votes FROM stg_trips
        WHERE start_station_id IS NOT NULL GROUP BY ALL)
  ORDER BY start_station_id, votes DESC, {value} ASC NULLS LAST)"""


Q["mode_value"] = rounded(
    f"""(SELECT * FROM {_favourite('rideable_type')} JOIN {_favourite('member_casual')}
  USING (start_station_id) JOIN {_favourite('end_lat')} USING (start_station_id))""",
    _DOUBLES,
)
Q["duration_quantiles"] = plain(
    """SELECT rideable_type, CAST(started_at AS DATE) AS date_day,
  quantile_disc(datesub('minute', started_at, ended_at), 0.5) AS p50,
  quantile_disc(datesub('minute', started_at, ended_at), 0.95) AS p95
FROM stg_trips GROUP BY ALL"""
)
_DEMAND = "station_id, date_day, trips_started, trips_ended"
Q["rolling_7d"] = rounded(
    f"""(SELECT {_DEMAND}, {moving('started_7d', 'trips_started', 7)},
  {moving('ended_7d', 'trips_ended', 7)} FROM demand_daily)""",
    _DOUBLES,
)
Q["rolling_28d"] = rounded(
    f"(SELECT {_DEMAND}, {moving('started_28d', 'trips_started', 28)} FROM demand_daily)", _DOUBLES
)
Q["lags"] = plain(
    f"""SELECT {_DEMAND},
  lag(trips_started) OVER w AS started_prev, lag(trips_started, 7) OVER w AS started_week_ago
FROM demand_daily WINDOW w AS (PARTITION BY station_id ORDER BY date_day)"""
)
Q["order_rolling"] = rounded(
    """(SELECT o_orderpriority, order_day, orders, largest,
  avg(orders) OVER (w ROWS 6 PRECEDING) AS orders_7,
  avg(largest) OVER (w ROWS 27 PRECEDING) AS largest_28, lag(orders) OVER w AS orders_prev
FROM (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS order_day, count(*) AS orders,
        max(o_totalprice) AS largest FROM orders GROUP BY ALL)
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY order_day))""",
    [*_DOUBLES, "largest"],
)
Q["global_rank"] = plain(
    """SELECT ride_id, minutes, row_number() OVER (ORDER BY minutes DESC, ride_id) AS duration_rank
FROM (SELECT ride_id, datesub('minute', started_at, ended_at) AS minutes FROM stg_trips)"""
)
Q["date_spine"] = plain("SELECT * FROM date_spine")
Q["incremental_slice"] = plain(
    """SELECT CAST(started_at AS DATE) AS date_day, count(*) AS trips FROM stg_trips
WHERE started_at > (SELECT max(started_at) FROM stg_trips WHERE started_at < DATE '2024-01-20')
  - INTERVAL 1 DAY GROUP BY ALL"""
)
Q["late_rows"] = plain(
    """SELECT CAST(started_at AS DATE) AS date_day, count(*) AS late_trips FROM stg_trips
WHERE CAST(ride_id[2:] AS BIGINT) % 50 = 0 AND started_at <= (
  SELECT max(started_at) FROM stg_trips
  WHERE started_at < DATE '2024-01-20' AND CAST(ride_id[2:] AS BIGINT) % 50 <> 0)
GROUP BY ALL"""
)
Q["merge_upsert"] = plain(
    """SELECT ride_id,
  CASE WHEN d >= DATE '2024-01-18' AND n % 40 = 0 THEN d + 1 ELSE d END AS trip_day,
  CASE WHEN d >= DATE '2024-01-18' THEN m + 1000 ELSE m END AS minutes
FROM (SELECT ride_id, CAST(started_at AS DATE) AS d, CAST(ride_id[2:] AS BIGINT) AS n,
        datesub('minute', started_at, ended_at) AS m FROM stg_trips)"""
)
Q["full_refresh_equals_incremental"] = Q["station_daily_fact"]
Q["retention_filter"] = plain(
    f"""SELECT CAST(last_reported AS DATE) AS reported_on, count(*) AS reports,
  CAST(sum(num_bikes_available) AS BIGINT) AS bikes
FROM stg_station_status WHERE last_reported >= {AS_OF} - 20 GROUP BY ALL"""
)
Q["tumbling_5min"] = rounded(
    """(SELECT station_id, time_bucket(INTERVAL 5 MINUTE, last_reported) AS bucket_start,
  count(*) AS reports, avg(num_bikes_available) AS avg_bikes FROM stg_station_status GROUP BY ALL)""",
    _DOUBLES,
)
Q["coverage"] = rounded(
    """(SELECT station_id, date_day, unique_5min_intervals, time_coverage_ratio, data_quality
FROM station_daily)""",
    _DOUBLES,
)
Q["freshness_class"] = plain(
    """SELECT data_freshness, count(*) AS stations, max(minutes_since_last_report) AS oldest_minutes
FROM realtime_status GROUP BY ALL"""
)
Q["regex_ids"] = plain(
    """SELECT station_id, count(*) AS n FROM stg_station_status
WHERE length(station_id) = 2 GROUP BY ALL"""
)

# --- ingestion --------------------------------------------------------------------------
_LANDED = """* REPLACE (date_trunc('millisecond', started_at) AS started_at,
  date_trunc('millisecond', ended_at) AS ended_at)"""
Q["land_trips_csv"] = rounded(
    f"""(SELECT {_LANDED}, strftime(started_at, '%Y') AS year, strftime(started_at, '%m') AS month
FROM trips_raw)""",
    _DOUBLES,
)
Q["load_trips_month"] = rounded(
    f"(SELECT {_LANDED}, strftime(started_at, '%Y-%m') AS started_month FROM trips_raw)", _DOUBLES
)
Q["land_twice"] = Q["land_trips_csv"]
_N = "CAST(ride_id[2:] AS BIGINT)"
Q["csv_rejects"] = plain(
    f"""SELECT CASE WHEN {_N} % 50 = 0 OR {_N} % 70 = 0 THEN 'broken line' WHEN {_N} % 90 = 0 THEN 'no id or start'
  ELSE 'kept' END AS outcome, count(*) AS n_lines FROM trips_raw GROUP BY ALL"""
)
Q["load_added_field"] = plain(
    """SELECT strftime(o_orderdate, '%Y-%m') AS started_month, count(*) AS trips,
  count(*) FILTER (year(o_orderdate) = 1996) AS priorities
FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1995-01', '1996-06') GROUP BY ALL"""
)
Q["backfill_months"] = plain(
    """SELECT strftime(o_orderdate, '%Y-%m') AS started_month, count(*) AS trips,
  min(o_orderdate) AS first_start
FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1995-01', '1996-06', '2001-07') GROUP BY ALL"""
)
Q["weather_json_to_rows"] = rounded(
    """(SELECT CAST(ts AS DATE) AS weather_date, CAST(event_id % 40 AS DOUBLE) AS temperature_max,
  event_id % 40 - 10 AS temperature_min, event_id % 40 - 5 AS temperature_mean,
  event_id % 50 / 100 AS precipitation_sum,
  CASE WHEN event_id // 8 % 5 <> 0 THEN event_id % 50 / 100 END AS rain_sum,
  CAST(NULL AS DOUBLE) AS snowfall_sum, CAST(NULL AS DOUBLE) AS precipitation_hours,
  event_id % 8 AS weather_code, event_id % 45 AS wind_speed_max, event_id % 45 + 10 AS wind_gusts_max,
  '40.7128' AS latitude, '-74.0060' AS longitude, 'New York City' AS city
FROM events)""",
    [d for d in _DOUBLES if d not in ("latitude", "longitude")],
)
Q["backfill_weather"] = f"SELECT * FROM ({Q['weather_json_to_rows']}) WHERE weather_date <= DATE '2024-01-20'"
# Reports as the polls carry them.
T["polled"] = f"""
SELECT r.* REPLACE (
  CAST(num_scooters_available AS BIGINT) AS num_scooters_available,
  CAST(num_scooters_unavailable AS BIGINT) AS num_scooters_unavailable,
  CAST(is_installed AS BIGINT) AS is_installed, CAST(is_renting AS BIGINT) AS is_renting,
  CAST(is_returning AS BIGINT) AS is_returning,
  CASE WHEN event_id % 7 <> 0 THEN legacy_id ELSE '' END AS legacy_id,
  CASE WHEN event_id % 6 <> 1 THEN num_docks_disabled ELSE 0 END AS num_docks_disabled,
  CASE WHEN event_id % 10 <> 3 THEN eightd_has_available_keys ELSE false END AS eightd_has_available_keys,
  date_trunc('second', r.last_reported) AS last_reported,
  to_timestamp(0)::TIMESTAMP AS api_last_updated, {NOW} AS ingestion_timestamp),
  event_id // 32 AS poll, event_id % 97 IN (5, 6, 7) AS unusable,
  max(date_trunc('second', r.last_reported)) OVER (PARTITION BY event_id // 32) AS polled_at
FROM numbered_status r"""
_STATION = """station_id, legacy_id, num_bikes_available, num_ebikes_available, num_bikes_disabled,
  num_docks_available, num_docks_disabled, num_scooters_available, num_scooters_unavailable,
  is_installed, is_renting, is_returning, eightd_has_available_keys, last_reported"""
T["accepted_reports"] = f"""
SELECT {_STATION}, polled_at AS api_last_updated, ingestion_timestamp FROM polled WHERE NOT unusable"""
Q["status_json_to_rows"] = plain("SELECT * FROM accepted_reports")
_REJECTS = """SELECT station_id, CAST(CASE event_id % 97 WHEN 7 THEN 86400 ELSE 0 END AS BIGINT) AS timestamp,
  count(*) AS rejects FROM polled WHERE unusable GROUP BY ALL"""
Q["status_rejects"] = plain(_REJECTS)
Q["poll_rejects"] = plain(
    """SELECT CASE WHEN poll % 10 = 3 THEN 'not JSON' WHEN poll % 11 = 4 THEN 'no stations' ELSE 'read' END
  AS outcome, count(DISTINCT poll) AS n_polls FROM polled GROUP BY ALL"""
)
Q["weather_rejects"] = plain(
    """SELECT outcome, count(*) AS n FROM (
  SELECT DISTINCT CASE WHEN r % 10 = 3 THEN 'not JSON' ELSE 'no days' END AS outcome, r AS id
  FROM (SELECT event_id // 8 AS r FROM events) WHERE r % 10 = 3 OR r % 11 = 4
  UNION ALL
  SELECT CASE WHEN r % 7 = 2 AND event_id = first THEN 'no date' ELSE 'read' END, event_id
  FROM (SELECT event_id, event_id // 8 AS r, min(event_id) OVER (PARTITION BY event_id // 8) AS first FROM events)
  WHERE r % 10 <> 3 AND r % 11 <> 4) GROUP BY ALL"""
)
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"
_MESSAGE = """station_id num_bikes_available num_ebikes_available num_bikes_disabled num_docks_available
num_docks_disabled num_scooters_available num_scooters_unavailable is_installed is_renting is_returning
last_reported eightd_has_available_keys legacy_id api_last_updated ingestion_timestamp""".split()
_TIMES = ("last_reported", "api_last_updated", "ingestion_timestamp")
_FIELDS = ", ".join(f"'{c}': {_ISO.format(c) if c in _TIMES else c}" for c in _MESSAGE)
Q["status_to_messages"] = plain(
    f"""SELECT CAST(to_json({{'data': CAST(to_json({{{_FIELDS}}}) AS VARCHAR)}}) AS VARCHAR) AS value
FROM accepted_reports"""
)
Q["ingest_metrics"] = plain(
    """SELECT count(*) AS observed_fetched, count(*) FILTER (WHERE NOT unusable) AS observed_published,
  count(*) FILTER (WHERE unusable) AS observed_skipped, count(*) AS fetched,
  count(*) FILTER (WHERE NOT unusable) AS published, count(*) FILTER (WHERE unusable) AS skipped,
  'success' AS status FROM polled"""
)
Q["ingest_run_report"] = plain(
    """SELECT 'all' AS run_id, true AS timed, count(*) AS fetched, count(*) FILTER (WHERE NOT unusable) AS published,
  count(*) FILTER (WHERE unusable) AS skipped, 'success' AS status, CAST(NULL AS VARCHAR) AS error FROM polled
UNION ALL SELECT 'useless', true, NULL, NULL, NULL, 'failed',
  'none of ' || count(*) || ' reports could be published' FROM polled"""
)
# Written table -> (layer, table of the expected results).
LAYERS = {
    "stg_trips": ("staging", "stg_trips"),
    "stg_weather": ("staging", "stg_weather"),
    "stg_station_status": ("staging", "stg_station_status"),
    "int_station_metrics": ("intermediate", "station_metrics"),
    "int_station_daily_metrics": ("intermediate", "station_daily"),
    "int_trip_station_daily": ("intermediate", "demand_daily"),
    "int_station_weather_daily": ("intermediate", "weather_enrich"),
    "int_station_daily_fact": ("intermediate", "station_daily_fact"),
    "snap_station": ("snapshots", "station_master"),
    "dim_station": ("marts", "dim_station"),
    "dim_date": ("marts", "dim_date"),
    "dim_time": ("marts", "dim_time"),
    "dim_user_type": ("marts", "dim_user_type"),
    "fct_trips": ("marts", "fct_trips"),
    "fct_station_day": ("marts", "fct_station_day"),
}


def each(rows: list[str]) -> str:
    return with_tables("\nUNION ALL\n".join(rows))


Q["run_layer"] = each(
    [
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS n FROM {source}"
        for name, (layer, source) in LAYERS.items()
    ]
)
_FIRST_RUN = f"(SELECT {key('station_id', repr('2024-01-20 00:00:00+00'))} AS first_key, station_key FROM dim_station)"


def rekeyed(columns: str) -> str:
    """Station keys as the first run, at the cutoff, gave them; the unknown key is fixed."""
    return ", ".join(
        f"(SELECT CASE WHEN k.station_key = md5('-1') THEN k.station_key ELSE first_key END "
        f"FROM {_FIRST_RUN} k WHERE k.station_key = f.{c}) AS {c}"
        for c in columns.split()
    )


Q["refresh_trips"] = rounded(
    f"(SELECT * REPLACE ({rekeyed('start_station_key end_station_key')}) FROM fct_trips f)", _DOUBLES
)
Q["refresh_station_days"] = rounded(
    f"(SELECT * REPLACE ({rekeyed('station_key')}) FROM fct_station_day f)", _DOUBLES + _FACT_DOUBLES
)
for name in ("refresh_lagging_trips", "refresh_backfill_station_days", "refresh_late_weather"):
    Q[name] = Q["fct_station_day"]
Q["refresh_backfill"] = Q["fct_trips"]
Q["refresh_reloaded_month"] = Q["fct_trips"]
Q["refresh_reloaded_station_days"] = Q["fct_station_day"]
Q["refresh_daily_tables"] = plain(
    """SELECT 'int_station_daily_metrics' AS table_name, station_id, date_day, total_observations AS measure FROM station_daily
UNION ALL SELECT 'int_trip_station_daily', station_id, date_day, trips_started FROM demand_daily
UNION ALL SELECT 'int_station_weather_daily', station_id, date_day, total_observations FROM weather_enrich"""
)
Q["refresh_station_daily"] = Q["station_daily"]
Q["refresh_demand_daily"] = Q["demand_daily"]
Q["refresh_weather_daily"] = Q["weather_enrich"]
Q["refresh_renamed_station"] = plain(
    """SELECT station_id, count(*) AS days, CASE station_id WHEN 'S7' THEN 2 ELSE 1 END AS versions,
  0 AS orphans FROM station_operations GROUP BY ALL"""
)
Q["clustered_row_groups"] = plain(
    """SELECT start_date_key, count(*) AS n_rows, min(start_station_key) AS lowest, max(start_station_key) AS highest,
  0 AS overlaps FROM fct_trips GROUP BY start_date_key"""
)
Q["materialize_view"] = Q["weather_impact"]

# --- streams ------------------------------------------------------------------------------
_STREAMED = f"{_STATION}, api_last_updated"
Q["stream_status_sink"] = plain(f"SELECT {_STREAMED} FROM accepted_reports")
Q["stream_rejects"] = Q["status_rejects"]
Q["stream_raw_archive"] = plain(
    """SELECT polled_at AS publish_time, 'station-status' AS subscription_name, count(*) AS stations
FROM polled GROUP BY poll, polled_at"""
)
Q["stream_poll_rejects"] = Q["poll_rejects"]
_STATION_REST = """eightd_has_available_keys DESC, is_installed DESC, is_renting DESC, is_returning DESC,
  legacy_id DESC, num_bikes_disabled DESC, num_docks_disabled DESC, num_ebikes_available DESC,
  num_scooters_available DESC, num_scooters_unavailable DESC"""
Q["stream_dedupe"] = plain(
    f"""SELECT {_STREAMED} FROM accepted_reports
QUALIFY row_number() OVER (PARTITION BY station_id, last_reported ORDER BY api_last_updated DESC,
  num_bikes_available DESC, num_docks_available DESC, {_STATION_REST}) = 1"""
)
Q["stream_windows"] = rounded(
    """(SELECT station_id, time_bucket(INTERVAL 5 MINUTE, last_reported) AS bucket_start,
    count(*) AS reports, avg(num_bikes_available) AS avg_bikes,
    count(*) FILTER (api_last_updated - INTERVAL 1 DAY > last_reported) AS late_reports
  FROM accepted_reports GROUP BY ALL)""",
    _DOUBLES,
)
Q["stream_metadata"] = plain(
    """SELECT polled_at AS publish_time, 'station-status' AS subscription_name,
  count(DISTINCT poll) AS messages, count(*) AS reports FROM polled WHERE NOT unusable GROUP BY ALL"""
)
Q["stream_expiry"] = plain(
    f"""SELECT CAST(last_reported AS DATE) AS reported_on, count(*) AS reports
FROM accepted_reports WHERE CAST(last_reported AS DATE) >= {AS_OF} - 10 GROUP BY ALL"""
)
Q["stream_latest"] = plain(
    f"""SELECT DISTINCT ON (station_id) {_STREAMED} FROM accepted_reports
ORDER BY station_id, last_reported DESC, api_last_updated DESC"""
)

# --- quality --------------------------------------------------------------------------------
_KEYS = {
    "stg_trips": "ride_id",
    "stg_weather": "weather_date",
    "stg_station_status": "station_id, last_reported",
    "int_station_metrics": "station_id, reported_at_5min",
    "int_station_daily_metrics": "station_id, date_day",
    "int_trip_station_daily": "station_id, date_day",
    "int_station_weather_daily": "station_id, date_day",
    "int_station_daily_fact": "station_id, date_day",
    "dim_date": "date_key",
    "dim_station": "station_key",
    "dim_time": "time_key",
    "dim_user_type": "user_type_key",
    "fct_trips": "trip_key",
    "fct_station_day": "station_key, date_key",
}
_DUPLICATES = [
    f"""SELECT '{t}' AS table_name, '{k}' AS key_columns, count(*) AS total_records,
  count(DISTINCT ({k})) AS unique_keys, count(*) - count(DISTINCT ({k})) AS duplicates,
  CASE WHEN count(*) = count(DISTINCT ({k})) THEN 'PASS' ELSE 'FAIL' END AS status
FROM {LAYERS[t][1]}"""
    for t, k in _KEYS.items()
]
Q["dup_keys"] = each(_DUPLICATES)
Q["layer_counts"] = plain(
    """SELECT 'trip_counts' AS check_name,
  string_agg(concat(layer, ': ', format('{:,}', n)), ' | ' ORDER BY layer) AS counts,
  CASE WHEN count(DISTINCT n) = 1 THEN 'PASS' ELSE 'WARNING' END AS status
FROM (SELECT 'stg_trips' AS layer, count(*) AS n FROM stg_trips
      UNION ALL SELECT 'fct_trips', count(*) FROM fct_trips)"""
)


def verdict(table: str, check: str, target: str, failures: str, source: str) -> str:
    name = target.replace("'", "''")
    return f"""SELECT '{table}' AS table_name, '{check}' AS check_name, '{name}' AS target, failures,
  CASE WHEN failures > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM (SELECT {failures} AS failures FROM {source})"""


def counted(table: str, check: str, target: str, failing: str) -> str:
    return verdict(table, check, target, f"count(*) FILTER (WHERE {failing})", LAYERS[table][1])


def lost(check: str, relation: tuple[str, str, str, str], null_too: bool) -> str:
    table, column, parent, parent_key = relation
    test = f"{column} NOT IN (SELECT {parent_key} FROM {parent})"
    failing = f"coalesce({test}, {'true' if null_too else 'false'})"
    target = f"{column} -> {parent}.{parent_key}"
    return counted(table, check, target, failing)


_RELATIONS = [
    ("fct_trips", "start_station_key", "dim_station", "station_key"),
    ("fct_trips", "end_station_key", "dim_station", "station_key"),
    ("fct_trips", "start_date_key", "dim_date", "date_key"),
    ("fct_trips", "start_hour_key", "dim_time", "time_key"),
    ("fct_trips", "user_type_key", "dim_user_type", "user_type_key"),
    ("fct_station_day", "station_key", "dim_station", "station_key"),
    ("fct_station_day", "date_key", "dim_date", "date_key"),
]
_FOREIGN = [lost("foreign_key", r, True) for r in _RELATIONS if r[1] != "start_hour_key"]
Q["fk_orphans"] = each(_FOREIGN)
Q["dq_relationships"] = each([lost("relationship", r, False) for r in _RELATIONS])
_DIMENSIONS = [
    """SELECT 'dim_date' AS table_name, count(*) AS records,
  datediff('day', min(full_date), max(full_date)) + 1 AS expected,
  CASE WHEN records = expected THEN 'PASS' ELSE 'WARNING' END AS status FROM dim_date""",
    """SELECT 'dim_station', count(*), count(DISTINCT station_id),
  CASE WHEN count(*) < count(DISTINCT station_id) THEN 'FAIL' ELSE 'PASS' END FROM dim_station""",
    "SELECT 'dim_time', count(*), 24, CASE WHEN count(*) = 24 THEN 'PASS' ELSE 'FAIL' END FROM dim_time",
    """SELECT 'dim_user_type', count(*), 3, CASE WHEN count(*) = 3 THEN 'PASS' ELSE 'FAIL' END
FROM dim_user_type""",
]
Q["dim_checks"] = each(_DIMENSIONS)
_PRESENT = {
    "fct_trips": "trip_key start_station_key end_station_key start_date_key user_type_key",
    "fct_station_day": "station_key date_key",
}
Q["null_keys"] = each(
    [counted(t, "not_null", c, f"{c} IS NULL") for t, cs in _PRESENT.items() for c in cs.split()]
)
_NOT_NULL = {
    "stg_trips": "ride_id rideable_type started_at ended_at member_casual",
    "stg_weather": "weather_date",
    "stg_station_status": "station_id last_reported ingestion_timestamp",
    "int_station_metrics": "station_id reported_at_5min total_capacity",
    "int_station_daily_metrics": "station_id date_day",
    "int_trip_station_daily": "station_id date_day",
    "int_station_weather_daily": "station_id date_day",
    "int_station_daily_fact": "station_id date_day",
    "dim_date": "date_key full_date",
    "dim_user_type": "user_type_key user_type_id user_type_name",
    "dim_time": "time_key hour",
    "dim_station": "station_key station_id is_active is_current",
    "fct_trips": (
        "trip_key trip_id start_station_key end_station_key start_date_key end_date_key "
        "start_hour_key end_hour_key user_type_key started_at ended_at trip_duration_minutes"
    ),
    "fct_station_day": "station_key date_key trips_started trips_ended",
}
Q["dq_not_null"] = each(
    [counted(t, "not_null", c, f"{c} IS NULL") for t, cs in _NOT_NULL.items() for c in cs.split()]
)


def repeated(table: str, check: str, keys: str) -> str:
    source = f"(SELECT {keys} FROM {LAYERS[table][1]} GROUP BY ALL HAVING count(*) > 1)"
    return verdict(table, check, keys, "count(*)", source)


_UNIQUE = [
    ("stg_trips", "ride_id"),
    ("stg_weather", "weather_date"),
    ("dim_date", "date_key"),
    ("dim_user_type", "user_type_key"),
    ("dim_user_type", "user_type_id"),
    ("dim_time", "time_key"),
    ("dim_station", "station_key"),
    ("fct_trips", "trip_key"),
]
Q["dq_unique"] = each([repeated(t, "unique", k) for t, k in _UNIQUE])
_TOGETHER = [
    ("int_station_daily_metrics", "station_id, date_day"),
    ("int_trip_station_daily", "station_id, date_day"),
    ("int_station_weather_daily", "station_id, date_day"),
    ("int_station_daily_fact", "station_id, date_day"),
    ("fct_station_day", "station_key, date_key"),
]
Q["dq_unique_combo"] = each([repeated(t, "unique_combination", k) for t, k in _TOGETHER])
_ALLOWED = [
    ("stg_trips", "rideable_type", "classic_bike electric_bike"),
    ("stg_trips", "member_casual", "member casual"),
    ("dim_user_type", "user_type_id", "member casual unknown"),
    ("dim_time", "time_bucket", "late_night morning_rush midday evening_rush evening"),
    (
        "dim_station",
        "borough",
        "Bronx Brooklyn Manhattan Queens Staten_Island Upper_Manhattan Midtown_Manhattan "
        "Lower_Manhattan Unknown",
    ),
    ("dim_station", "station_size", "micro small medium large unknown"),
    ("fct_trips", "bike_type", "electric_bike classic_bike"),
    ("fct_station_day", "station_flow_pattern", "net_source net_sink balanced inactive"),
    ("fct_station_day", "demand_trend", "surge above_average stable below_average decline"),
]
Q["dq_accepted"] = each(
    [
        counted(
            t,
            "accepted_values",
            c,
            f"replace({c}, ' ', '_') NOT IN ({', '.join(repr(v) for v in values.split())})",
        )
        for t, c, values in _ALLOWED
    ]
)
_HOLDS = [
    ("dim_date", "date_key matches full_date", "date_key = CAST(strftime(full_date, '%Y%m%d') AS BIGINT)"),
    ("dim_station", "unknown station is named", "station_id <> '-1' OR station_name = 'Unknown Station'"),
    ("fct_trips", "trip_duration_minutes >= 0", "trip_duration_minutes >= 0"),
    ("fct_trips", "trip_duration_seconds >= 0", "trip_duration_seconds >= 0"),
    ("fct_trips", "started_at < ended_at", "started_at < ended_at"),
    ("fct_station_day", "trips_started >= 0", "trips_started >= 0"),
    ("fct_station_day", "trips_ended >= 0", "trips_ended >= 0"),
]
Q["dq_expression"] = each(
    [counted(t, "expression", name, f"({test}) IS NOT TRUE") for t, name, test in _HOLDS]
)


def section(name: str, checks: str) -> str:
    return f"""SELECT '{name}' AS section, count(*) AS checks,
  count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'FAIL') AS failed,
  count(*) FILTER (WHERE status = 'WARNING') AS warnings FROM ({checks})"""


_NULL_TABLES = [
    verdict(
        t,
        "not_null",
        "keys",
        " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cs.split()),
        LAYERS[t][1],
    )
    for t, cs in _PRESENT.items()
]
Q["dq_report"] = each(
    [
        section("duplicate_keys", "\nUNION ALL\n".join(_DUPLICATES)),
        section("foreign_keys", "\nUNION ALL\n".join(_FOREIGN)),
        section("dimensions", "\nUNION ALL\n".join(_DIMENSIONS)),
        section("null_keys", "\nUNION ALL\n".join(_NULL_TABLES)),
    ]
)
_TYPED = {
    "int_station_metrics": "station_id",
    "int_station_daily_metrics": "station_id",
    "int_trip_station_daily": "station_id",
    "int_station_weather_daily": "station_id",
    "int_station_daily_fact": "station_id date_day",
    "dim_station": "station_key station_id capacity",
    "dim_date": "date_key full_date",
    "fct_trips": "trip_key start_date_key started_at",
    "fct_station_day": "station_key date_key trips_started",
}
Q["schema_check"] = each(
    [
        f"""SELECT '{t}' AS table_name, 'schema' AS check_name, '{c}' AS target, 0::BIGINT AS failures,
  'PASS' AS status, count(*) AS n FROM {LAYERS[t][1]}"""
        for t, cs in _TYPED.items()
        for c in cs.split()
    ]
)

# --- monitoring --------------------------------------------------------------------------------
_LATER = f"({NOW} + INTERVAL 30 HOUR)"


def fresh(name: str, column: str, source: str) -> str:
    return f"""SELECT '{name}' AS source, max({column}) AS max_loaded_at,
  datesub('hour', max({column}), {_LATER}) AS hours_old,
  CASE WHEN datesub('minute', max({column}), {_LATER}) <= 1440 THEN 'pass'
    WHEN datesub('minute', max({column}), {_LATER}) <= 2880 THEN 'warn' ELSE 'error' END AS status
FROM {source}"""


Q["source_freshness"] = each(
    [
        fresh("trips", "started_at", "trips_raw"),
        fresh("weather", "loaded_at", "weather_raw"),
        fresh("station_status", "ingestion_timestamp", "status_raw"),
    ]
)
Q["stream_health"] = plain(
    f"""SELECT max(last_reported) AS latest_data, datesub('minute', max(last_reported), {NOW}) AS minutes_old,
  count(DISTINCT station_id) AS stations,
  CASE WHEN minutes_old >= 30 THEN 'error' WHEN minutes_old >= 10 THEN 'warning' ELSE 'good' END AS status
FROM stg_station_status"""
)
Q["active_entities"] = plain(
    f"""SELECT count(DISTINCT station_id) AS active_stations,
  CASE WHEN active_stations > 1500 THEN 'good' WHEN active_stations > 1000 THEN 'warning' ELSE 'error' END AS status
FROM stg_station_status WHERE last_reported >= {NOW} - INTERVAL 10 MINUTE"""
)
Q["stale_entities"] = plain(
    f"""SELECT station_id, max(last_reported) AS last_update,
  datesub('minute', max(last_reported), {NOW}) AS minutes_stale
FROM stg_station_status WHERE last_reported >= {AS_OF} GROUP BY ALL HAVING minutes_stale > 30"""
)
Q["weather_age"] = plain(
    f"""SELECT max(weather_date) AS latest_day, {AS_OF} - max(weather_date) AS days_old,
  CASE WHEN days_old >= 7 THEN 'error' WHEN days_old >= 2 THEN 'warning' ELSE 'good' END AS status
FROM weather_raw"""
)
Q["recent_reports"] = plain(
    """SELECT * FROM stg_station_status WHERE station_id = 'S7'
ORDER BY ingestion_timestamp DESC LIMIT 10"""
)
Q["trip_span"] = each(
    [
        f"""SELECT '{layer}' AS layer, count(*) AS trips, min(started_at) AS first_start,
  max(started_at) AS last_start FROM {source}"""
        for layer, source in (("raw", "trips_raw"), ("fact", "fct_trips"))
    ]
)

# --- analysts and charts ---------------------------------------------------------------------------
Q["daily_trend"] = rounded(
    """(SELECT CAST(started_at AS DATE) AS full_date, dayname(started_at) AS day_name,
  isodow(started_at) >= 6 AS is_weekend, count(*) AS total_trips,
  avg(trip_duration_minutes) AS avg_duration, sum(trip_distance_km) AS total_distance
FROM fct_trips WHERE started_at >= DATE '2024-01-01' AND started_at < DATE '2024-02-01' GROUP BY ALL)""",
    _DOUBLES,
)
Q["topk_entities"] = rounded(
    """(SELECT station_name, borough, day_name, trips_started, trips_ended, net_trips,
  avg_occupancy_ratio, operational_health_score, demand_trend
FROM fct_station_day JOIN dim_station USING (station_key)
WHERE date_day = DATE '2024-01-29' AND is_active ORDER BY trips_started DESC, station_id LIMIT 20)""",
    _DOUBLES,
)
Q["hourly_pattern"] = rounded(
    """(SELECT hour_name, time_bucket, is_rush_hour, user_type_name, count(*) AS trip_count,
  avg(trip_duration_minutes) AS avg_duration
FROM fct_trips JOIN dim_time ON time_key = start_hour_key JOIN dim_user_type USING (user_type_key)
WHERE year(started_at) = 2024 AND isodow(started_at) < 6 GROUP BY ALL)""",
    _DOUBLES,
)
Q["weather_effect"] = rounded(
    """(SELECT weather_condition, is_ideal_biking_weather, is_poor_biking_weather,
  count(DISTINCT station_key) AS stations, CAST(sum(trips_started) AS BIGINT) AS total_trips,
  avg(avg_occupancy_ratio) AS avg_occupancy, avg(temperature_mean) AS avg_temp
FROM fct_station_day WHERE date_day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY ALL)""",
    _DOUBLES,
)
Q["duration_sanity"] = rounded(
    """(SELECT avg(trip_duration_minutes) AS avg_duration, min(trip_duration_minutes) AS min_duration,
  max(trip_duration_minutes) AS max_duration FROM fct_trips WHERE trip_duration_minutes > 0)""",
    _DOUBLES,
)


def cards(where: str = "true") -> str:
    return rounded(
        f"""(SELECT CAST(sum(trip_count) AS BIGINT) AS total_trips, avg(avg_trip_duration) AS avg_duration,
  avg(member_pct) AS member_pct, avg(electric_bike_pct) AS electric_bike_pct,
  sum(avg_trip_duration * trip_count) / sum(trip_count) AS avg_duration_weighted,
  100.0 * sum(member_trips) / sum(trip_count) AS member_pct_weighted,
  100.0 * sum(electric_bike_trips) / sum(trip_count) AS electric_bike_pct_weighted
FROM trip_analytics_daily WHERE {where})""",
        _DOUBLES,
    )


Q["scorecards"] = cards()
Q["filtered_trips"] = cards(
    """date_day BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' AND user_type_name = 'Member'
  AND NOT is_weekend AND hour_of_day BETWEEN 7 AND 19"""
)
_CHARTS = {
    "hour_by_user": ("printf('%02d', hour_of_day)", "user_type_name"),
    "user_type": ("user_type_name", "NULL"),
    "bike_type": ("rideable_type", "NULL"),
    "time_of_day": ("time_of_day_name", "NULL"),
}
Q["chart_breakdowns"] = each(
    [
        f"""SELECT '{chart}' AS chart, {item} AS item, CAST({series} AS VARCHAR) AS series,
  CAST(sum(trip_count) AS BIGINT) AS trips FROM trip_analytics_daily GROUP BY ALL"""
        for chart, (item, series) in _CHARTS.items()
    ]
)
Q["hourly_table"] = rounded(
    """(SELECT date_day, hour_of_day, time_of_day_name, user_type_name, rideable_type,
  CAST(sum(trip_count) AS BIGINT) AS trips, avg(avg_trip_duration) AS avg_duration,
  avg(member_pct) AS member_pct, avg(electric_bike_pct) AS electric_bike_pct
FROM trip_analytics_daily GROUP BY ALL)""",
    _DOUBLES,
)
T["route_totals"] = """
SELECT start_station_id, start_station_name, end_station_id, end_station_name,
  CAST(sum(trip_count) AS BIGINT) AS trips FROM routes GROUP BY ALL"""
Q["route_scorecards"] = rounded(
    """(SELECT (SELECT count(*) FROM route_totals) AS total_routes,
  (SELECT avg(trips) FROM route_totals) AS avg_trips_per_route,
  start_station_name || ' → ' || end_station_name AS most_popular_route, trips AS most_popular_trips
FROM route_totals ORDER BY trips DESC, start_station_id, end_station_id LIMIT 1)""",
    _DOUBLES,
)
Q["top_routes"] = rounded(
    """(SELECT start_station_id, start_station_name, end_station_id, end_station_name,
  route_popularity_category, CAST(sum(trip_count) AS BIGINT) AS trips,
  avg(avg_duration_minutes) AS avg_duration, avg(member_pct) AS member_pct,
  avg(electric_pct) AS electric_pct
FROM routes GROUP BY ALL
ORDER BY trips DESC, start_station_id, end_station_id, route_popularity_category LIMIT 20)""",
    _DOUBLES,
)
for role in ("start", "end"):
    Q[f"top_{role}"] = plain(
        f"""SELECT {role}_station_id, {role}_station_name, CAST(sum(trip_count) AS BIGINT) AS trips
FROM routes GROUP BY ALL ORDER BY trips DESC, {role}_station_id LIMIT 15"""
    )
    Q["station_map" if role == "start" else "station_map_end"] = rounded(
        f"""(SELECT {role}_latitude, {role}_longitude, CAST(sum(trip_count) AS BIGINT) AS trips,
  avg(avg_duration_minutes) AS avg_duration FROM routes GROUP BY ALL)""",
        _DOUBLES,
    )
Q["weather_scorecards"] = rounded(
    """(SELECT avg(total_trips_started) AS avg_daily_trips,
  CAST(sum(is_ideal_biking_weather) AS BIGINT) AS ideal_days,
  CAST(sum(is_poor_biking_weather) AS BIGINT) AS poor_days,
  avg(temperature_celsius) AS avg_temperature FROM weather_impact)""",
    _DOUBLES,
)
Q["trend_line"] = rounded(
    "(SELECT "
    + ", ".join(
        f"{f}(total_trips_started, {x}) AS {x}_{n}"
        for x in ("temperature_celsius", "precipitation_mm")
        for n, f in (("slope", "regr_slope"), ("intercept", "regr_intercept"), ("r", "corr"))
    )
    + " FROM weather_impact)",
    [d for d in _DOUBLES if d.endswith(("_slope", "_intercept", "_r"))],
    rest=False,
)
Q["weather_breakdown"] = rounded(
    "("
    + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS chart, {c} AS item, avg(total_trips_started) AS avg_trips, count(*) AS days,
  100.0 * count(*) / (SELECT count(*) FROM weather_impact) AS share_pct FROM weather_impact GROUP BY ALL"""
        for c in ("weather_condition", "temperature_category", "weather_category")
    )
    + ")",
    _DOUBLES,
)
Q["weather_table"] = rounded(
    """(SELECT date_day, day_name, weather_condition, temperature_category, precipitation_category,
  CAST(sum(total_trips_started) AS BIGINT) AS trips, avg(temperature_celsius) AS temperature,
  sum(precipitation_mm) AS precipitation, max(wind_speed_kmh) AS wind,
  avg(avg_trip_duration) AS avg_duration FROM weather_impact GROUP BY ALL)""",
    _DOUBLES,
)
