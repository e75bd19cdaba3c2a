"""Fact tables of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.calendar import date_key, utc
from ridelake.functions.keys import surrogate_key, unknown_station_key
from ridelake.functions.numeric import elapsed, great_circle_km
from ridelake.operators.aggregates import sql_columns
from ridelake.operators.joins import lookup, lookup_version
from ridelake.plans.dimensions import user_type_keys

SHORT_TRIP_BELOW_MINUTES = 5
LONG_TRIP_ABOVE_MINUTES = 60


def trip_key() -> Column:
    return surrogate_key(F.col("ride_id"))


def first_trip(trips: DataFrame) -> list[Column]:
    """Which of several rows of one trip counts: the one with the highest values."""
    return [F.desc_nulls_last(c) for c in trips.columns if c != "trip_key"]


def fct_trips(trips: DataFrame, stations: DataFrame, user_types: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """One row per trip with its keys, durations, distance and flags.

    A date key is the date as a number and a time key is the hour, in the dimension
    as well as in the fallback for a missing dimension row, so neither needs a join.
    Stations are looked up once per role, in the version valid at that end of the trip; an
    unmatched one gets the unknown key.
    """
    keyed = lookup_version(trips, stations, "station_id", "start_station_id", F.col("started_at"), {"station_key": "_from"})
    keyed = lookup_version(keyed, stations, "station_id", "end_station_id", F.col("ended_at"), {"station_key": "_to"})
    # Three literal rows.
    keyed = lookup(
        keyed, F.broadcast(user_types), "user_type_id", "member_casual", {"user_type_key": "_user"}
    )
    start, end = F.col("started_at"), F.col("ended_at")
    minutes = elapsed("MINUTE", start, end)
    places = ["start_lat", "start_lng", "end_lat", "end_lng"]
    return keyed.select(
        trip_key().alias("trip_key"),
        F.col("ride_id").alias("trip_id"),
        F.coalesce("_from", unknown_station_key()).alias("start_station_key"),
        F.coalesce("_to", unknown_station_key()).alias("end_station_key"),
        date_key(F.to_date(start)).alias("start_date_key"),
        date_key(F.to_date(end)).alias("end_date_key"),
        F.hour(start).cast("long").alias("start_hour_key"),
        F.hour(end).cast("long").alias("end_hour_key"),
        F.coalesce("_user", F.lit(user_type_keys()["unknown"]).cast("long")).alias("user_type_key"),
        "started_at",
        "ended_at",
        minutes.alias("trip_duration_minutes"),
        elapsed("SECOND", start, end).alias("trip_duration_seconds"),
        great_circle_km(*[F.col(c) for c in places]).alias("trip_distance_km"),
        F.col("start_lat").alias("start_latitude"),
        F.col("start_lng").alias("start_longitude"),
        F.col("end_lat").alias("end_latitude"),
        F.col("end_lng").alias("end_longitude"),
        F.col("rideable_type").alias("bike_type"),
        (F.col("start_station_id") == F.col("end_station_id")).alias("is_round_trip"),
        (minutes < SHORT_TRIP_BELOW_MINUTES).alias("is_short_trip"),
        (minutes > LONG_TRIP_ABOVE_MINUTES).alias("is_long_trip"),
        utc(loaded_at).alias("loaded_at"),
    )


# How rows of one (station key, day) become one; all unmatched stations of a day meet here.
ADDED = [
    "trips_started",
    "trips_ended",
    "net_trips",
    "total_trip_activity",
    "member_trips_started",
    "casual_trips_started",
    "ebike_trips_started",
    "classic_bike_trips_started",
    "morning_rush_trips_started",
    "evening_rush_trips_started",
]
AVERAGED = [
    "avg_bikes_available",
    "avg_ebikes_available",
    "avg_docks_available",
    "avg_occupancy_ratio",
    "occupancy_volatility",
    "avg_utilization_percentage",
    "utilization_volatility",
    "avg_ebike_ratio",
    "pct_time_empty",
    "pct_time_full",
    "pct_time_operational",
    "trips_per_bike_ratio",
    "demand_capacity_ratio",
    "supply_demand_balance_score",
    "avg_bikes_available_7d",
    "avg_occupancy_ratio_7d",
    "avg_utilization_7d",
    "avg_pct_time_empty_7d",
    "avg_pct_time_full_7d",
    "avg_trips_started_7d",
    "avg_trips_ended_7d",
    "avg_total_activity_7d",
    "avg_trips_started_28d",
    "avg_occupancy_ratio_28d",
    "trips_started_prev_day",
    "occupancy_ratio_prev_day",
    "trips_started_same_day_last_week",
    "trips_started_change_dod",
    "trips_started_change_wow",
    "trips_started_deviation_pct_7d",
]
HIGHEST = [
    "typical_capacity",
    "max_capacity",
    "min_capacity",
    "operational_health_score",
    "avg_trip_duration_minutes",
    "median_trip_duration_minutes",
    "p95_trip_duration_minutes",
    "member_pct_started",
    "ebike_pct_started",
    "rush_hour_intensity",
    "temperature_mean",
    "temperature_max",
    "temperature_min",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "wind_speed_max",
    "temperature_range",
    "precipitation_intensity",
    "weather_severity_score",
    "rebalancing_need",
    "data_quality",
    "station_flow_pattern",
    "weather_condition",
    "is_raining",
    "is_snowing",
    "is_freezing",
    "is_windy",
    "is_ideal_biking_weather",
    "is_poor_biking_weather",
    "demand_trend",
    "day_of_week",
    "day_name",
    "is_weekend",
    "month",
    "month_name",
    "quarter",
    "year",
    "week_of_year",
]


def fct_station_day(daily: DataFrame, stations: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Station-days under their dimension keys, one row per (station key, day)."""
    keyed = lookup_version(daily, stations, "station_id", "station_id", F.col("date_day"), {"station_key": "_key"})
    keyed = keyed.withColumn("station_key", F.coalesce("_key", unknown_station_key()))
    keyed = keyed.withColumn("date_key", date_key(F.col("date_day")))
    return keyed.groupBy("station_key", "date_key", "date_day").agg(
        *sql_columns({c: f"sum({c})" for c in ADDED}),
        *sql_columns({c: f"avg({c})" for c in AVERAGED}),
        *sql_columns({c: f"max({c})" for c in HIGHEST}),
        utc(loaded_at).alias("loaded_at"),
    )
