"""Raw feeds derived from the shared ``events`` table.

The texts hold for Spark and for DuckDB alike; ``{events}`` is the table.
Stations S0-S4 only report status, S25-S29 only have trips, the others have both.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2024, 1, 30)
NOW = dt.datetime(2024, 1, 30, 23, 59, 59)

TRIPS_SQL = """
select concat('R', cast(event_id as string)) as ride_id,
  case when event_id % 2 = 0 then 'electric_bike' else 'classic_bike' end as rideable_type,
  ts as started_at,
  case when event_type = 'error' then ts
       else ts + cast(round(value * 60) as int) * interval '1' second end as ended_at,
  case when event_id % 11 = 0 then null else concat('Station ', cast(user_id % 25 + 5 as string)) end as start_station_name,
  case when event_id % 11 = 0 then null else concat('S', cast(user_id % 25 + 5 as string)) end as start_station_id,
  case when event_id % 13 = 0 then null else concat('Station ', cast((user_id * 7 + event_id) % 25 + 5 as string)) end as end_station_name,
  case when event_id % 13 = 0 then null else concat('S', cast((user_id * 7 + event_id) % 25 + 5 as string)) end as end_station_id,
  cast(40.60 as double) + cast(user_id % 25 + 5 as double) / 100 as start_lat,
  cast(-74.05 as double) + cast(user_id % 25 + 5 as double) / 250 as start_lng,
  cast(40.60 as double) + cast((user_id * 7 + event_id) % 25 + 5 as double) / 100 as end_lat,
  cast(-74.05 as double) + cast((user_id * 7 + event_id) % 25 + 5 as double) / 250 as end_lng,
  case when user_id % 7 = 0 then 'casual' when user_id % 7 = 1 then null else 'member' end as member_casual
from {events}
"""

WEATHER_SQL = """
select cast(ts as date) as weather_date,
  cast(event_id % 40 as double) as temperature_max,
  cast(event_id % 40 as double) - 10 as temperature_min,
  cast(event_id % 40 as double) - 5 as temperature_mean,
  case when event_id % 3 = 0 then cast(0 as double) else cast(event_id % 50 as double) / 100 end as precipitation_sum,
  case when event_id % 3 = 0 then cast(0 as double) else cast(event_id % 50 as double) / 100 end as rain_sum,
  case when event_id % 40 < 5 then cast(1.5 as double) else cast(0 as double) end as snowfall_sum,
  cast(event_id % 24 as double) as precipitation_hours,
  case event_id % 8 when 0 then 0 when 1 then 2 when 2 then 45 when 3 then 53 when 4 then 61 when 5 then 73 when 6 then 95 else null end as weather_code,
  cast(event_id % 45 as double) as wind_speed_max,
  cast(event_id % 45 as double) + 10 as wind_gusts_max,
  '40.7128' as latitude, '-74.0060' as longitude, 'New York City' as city,
  ts as loaded_at
from {events}
where event_type = 'signup' and cast(ts as date) <> date '2024-01-15'
"""

STATUS_SQL = """
select concat('S', cast(user_id % 25 as string)) as station_id,
  cast(user_id % 25 as string) as legacy_id,
  event_id % 20 as num_bikes_available,
  event_id % 5 as num_ebikes_available,
  event_id % 3 as num_bikes_disabled,
  (event_id * 3) % 25 as num_docks_available,
  event_id % 2 as num_docks_disabled,
  case when event_id % 4 = 0 then 1 else 0 end as num_scooters_available,
  case when event_id % 9 = 0 then 1 else 0 end as num_scooters_unavailable,
  case when event_id % 50 = 7 then 0 else 1 end as is_installed,
  case when event_id % 20 = 1 then 0 else 1 end as is_renting,
  case when event_id % 25 = 2 or event_id % 40 = 1 then 0 else 1 end as is_returning,
  event_id % 2 = 0 as eightd_has_available_keys,
  ts as last_reported,
  ts + interval '30' second as api_last_updated,
  ts + interval '60' second as ingestion_timestamp
from {events}
"""

# The status feed with the number of the event each report comes from.
NUMBERED_STATUS_SQL = STATUS_SQL.replace("select ", "select event_id, ", 1)


@dataclass(frozen=True)
class Feeds:
    """The three raw tables everything is built from."""

    trips: DataFrame
    weather: DataFrame
    status: DataFrame


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_feeds(spark: SparkSession, sf_dir: str) -> Feeds:
    source = events(spark, sf_dir)
    return Feeds(
        trips=spark.sql(TRIPS_SQL, events=source),
        weather=spark.sql(WEATHER_SQL, events=source),
        status=spark.sql(STATUS_SQL, events=source),
    )
