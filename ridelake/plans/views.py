"""Dashboard views over the star schema.

Trip views group by the keys of the fact first and join the dimensions to the
groups: the dimension columns depend on the keys alone, so the result is the same
and the joins see summary rows instead of trips.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake import rules
from ridelake.functions.bands import choose, ladder
from ridelake.functions.calendar import utc
from ridelake.functions.numeric import elapsed, ratio
from ridelake.operators.ranking import (
    latest_per_key,
    number_by_levels,
    number_within,
)


def _days(dates: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Calendar rows of the window; at most ``days`` + 1, so safe to broadcast."""
    window = F.col("full_date").between(F.date_sub(F.lit(as_of), days), F.lit(as_of))
    return F.broadcast(dates.where(window))


def _key_window(as_of: dt.date, days: int) -> tuple[int, int]:
    """The same window as date keys, for partition pruning on the fact."""
    first = as_of - dt.timedelta(days=days)
    return int(first.strftime("%Y%m%d")), int(as_of.strftime("%Y%m%d"))


def priority(need: Column) -> Column:
    return choose([(need == k, label) for k, label in rules.PRIORITY.items()], rules.PRIORITY_REST)


def percent(part: str, whole: str = "trip_count") -> Column:
    return ratio(F.col(part), F.col(whole)) * 100


def station_operations(
    facts: DataFrame, stations: DataFrame, dates: DataFrame, as_of: dt.date, days: int = 30
) -> DataFrame:
    """Station-days of the window, with priority, activity class and daily rank."""
    first = as_of - dt.timedelta(days=days)
    recent = facts.where(F.col("date_day").between(F.lit(first), F.lit(as_of)))
    calendar = _days(dates, as_of, days).select(
        "date_key", "full_date", "day_name", "is_weekend", "month_name", "year"
    )
    places = stations.select(
        "station_key", "station_id", "station_name", "latitude", "longitude", "capacity", "region"
    )
    measures = recent.drop("date_day", "day_name", "is_weekend", "month_name", "year")
    joined = measures.join(calendar, "date_key").join(places, "station_key")
    renamed = {
        "avg_utilization_percentage": "avg_utilization_pct",
        "avg_bikes_available_7d": "rolling_7d_avg_bikes",
        "avg_occupancy_ratio_7d": "rolling_7d_avg_occupancy",
        "avg_utilization_7d": "rolling_7d_avg_utilization",
        "trips_started_change_dod": "day_over_day_trips_change",
        "trips_started_change_wow": "week_over_week_trips_change",
    }
    kept = [
        "day_name",
        "is_weekend",
        "month_name",
        "year",
        "station_id",
        "station_name",
        "latitude",
        "longitude",
        "capacity",
        "region",
        "avg_bikes_available",
        "avg_ebikes_available",
        "avg_docks_available",
        "avg_occupancy_ratio",
        "avg_utilization_percentage",
        "occupancy_volatility",
        "pct_time_empty",
        "pct_time_full",
        "operational_health_score",
        "rebalancing_need",
        "trips_started",
        "trips_ended",
        "net_trips",
        "station_flow_pattern",
        "typical_capacity",
        "max_capacity",
        "min_capacity",
        "avg_bikes_available_7d",
        "avg_occupancy_ratio_7d",
        "avg_utilization_7d",
        "trips_started_change_dod",
        "trips_started_change_wow",
    ]
    view = joined.select(
        F.col("full_date").alias("date_day"),
        *[F.col(c).alias(renamed.get(c, c)) for c in kept],
        (F.col("full_date") == F.lit(as_of)).alias("is_current_day"),
        priority(F.col("rebalancing_need")).alias("priority_indicator"),
        ladder(F.col("trips_started"), ">=", rules.ACTIVITY).alias("activity_category"),
    )
    order = [F.desc("trips_started"), F.asc("station_id")]
    # A day has one row per station.
    ranked = number_within(view, ["date_day"], order, "daily_activity_rank")
    return ranked.orderBy(F.desc("date_day"), "daily_activity_rank")


def realtime_status(metrics: DataFrame, history: DataFrame, now: dt.datetime) -> DataFrame:
    """Latest report of each station in the last 24 hours, with its station record."""
    at = utc(now)
    recent = metrics.where(F.col("last_reported") >= at - F.expr("interval 24 hours"))
    newest = [F.desc("last_reported"), F.desc_nulls_last("ingestion_timestamp")]
    latest = latest_per_key(recent, ["station_id"], newest)
    places = history.where("valid_to is null").select(
        F.col("station_id").alias("known_id"),
        "station_name",
        "latitude",
        "longitude",
        "capacity",
        "region",
    )
    joined = latest.join(places, F.col("station_id") == F.col("known_id"), "left")

    region, capacity = F.col("region"), F.col("capacity")
    renting, returning = F.col("is_renting"), F.col("is_returning")
    few_bikes = F.col("num_bikes_available") <= rules.LOW_STOCK
    few_docks = F.col("num_docks_available") <= rules.LOW_STOCK
    need = choose(
        [(F.col("is_empty") | F.col("is_full"), "high"), (few_bikes | few_docks, "medium")], "low"
    )
    age = elapsed("MINUTE", F.col("last_reported"), at)
    columns = {
        "station_id": F.col("known_id"),
        "station_name": F.col("station_name"),
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
        "capacity": capacity,
        "region": region,
        "station_type": ladder(capacity, ">=", rules.LIVE_STATION_TYPE),
        "borough": choose(
            [(region.contains(part), name) for part, name in rules.LIVE_BOROUGHS.items()], "Unknown"
        ),
        "station_size": ladder(capacity, ">=", rules.LIVE_STATION_SIZE),
        **{c: F.col(c) for c in metrics.columns if c.startswith("num_")},
        "total_bikes_available": F.col("num_bikes_available") + F.col("num_ebikes_available"),
        "total_capacity": F.col("total_capacity"),
        "occupancy_ratio": F.round("occupancy_ratio", 3),
        "utilization_pct": F.round(F.col("utilization_percentage") * 100, 1),
        "is_installed": F.col("is_installed"),
        "is_renting": renting,
        "is_returning": returning,
        # Carries the empty flag under this name.
        "eightd_has_available_keys": F.coalesce("is_empty", F.lit(False)),
        "operational_status": choose(
            [
                (~F.col("is_installed"), "Not Installed"),
                (~renting & ~returning, "Out of Service"),
                (~renting, "Not Renting"),
                (~returning, "Not Returning"),
            ],
            "Operational",
        ),
        "availability_status": choose(
            [
                (F.col("is_empty"), "Empty"),
                (F.col("is_full"), "Full"),
                (few_bikes, "Low Bikes"),
                (few_docks, "Low Docks"),
            ],
            "Available",
        ),
        "rebalancing_need": need,
        "priority_indicator": priority(need),
        "last_reported": F.col("last_reported"),
        "api_last_updated": F.col("api_last_updated"),
        "ingestion_timestamp": F.col("ingestion_timestamp"),
        "minutes_since_last_report": age,
        "data_freshness": ladder(age, "<=", rules.FRESHNESS),
    }
    view = joined.where("is_installed").select(*[c.alias(n) for n, c in columns.items()])
    urgency = choose([(F.col("rebalancing_need") == "high", 1), (F.col("rebalancing_need") == "medium", 2)], 3)
    return view.orderBy(urgency, "station_name")


def _trip_mix(groups: DataFrame, electric: str, classic: str) -> DataFrame:
    """Rider and bike counts of groups that hold one user type and one bike type."""
    trips, zero = F.col("trip_count"), F.lit(0).cast("long")

    def when(condition: Column) -> Column:
        return F.when(condition, trips).otherwise(zero)

    return groups.withColumns(
        {
            "member_trips": when(F.col("is_member")),
            "casual_trips": when(~F.col("is_member")),
            electric: when(F.col("rideable_type") == "electric_bike"),
            classic: when(F.col("rideable_type") == "classic_bike"),
        }
    )


def _duration_classes(minutes: Column) -> dict[str, Column]:
    cuts = rules.DURATION_CUTS
    names = ["very_short", "short", "medium", "long", "very_long"]
    lows, highs = [None, *cuts], [*cuts, None]
    classes = {}
    for name, low, high in zip(names, lows, highs):
        above = F.lit(True) if low is None else minutes >= low
        below = F.lit(True) if high is None else minutes < high
        classes[f"{name}_trips"] = F.count_if(above & below)
    return classes


def _user_types(users: DataFrame) -> DataFrame:
    """Three rows."""
    return F.broadcast(
        users.select("user_type_key", "user_type_name", F.col("has_subscription").alias("is_member"))
    )


def trip_analytics_daily(
    trips: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    users: DataFrame,
    as_of: dt.date,
    days: int = 90,
) -> DataFrame:
    """Trips by day, hour, user type and bike type, with shares and ranks."""
    keys = ["start_date_key", "start_hour_key", "user_type_key", "bike_type"]
    minutes = F.col("trip_duration_minutes")
    groups = (
        trips.where(F.col("start_date_key").between(*_key_window(as_of, days)))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("trip_count"),
            F.avg(minutes).alias("avg_trip_duration"),
            F.min(minutes).alias("min_trip_duration"),
            F.max(minutes).alias("max_trip_duration"),
            F.stddev_samp(minutes).alias("stddev_trip_duration"),
            *[c.alias(name) for name, c in _duration_classes(minutes).items()],
            # Sets hold the stations of one hour at most, and are merged from those of each
            # task; two distinct counts would send every trip through the plan three times.
            F.size(F.collect_set("start_station_key")).cast("long").alias("unique_start_stations"),
            F.size(F.collect_set("end_station_key")).cast("long").alias("unique_end_stations"),
        )
    )
    calendar = _days(dates, as_of, days).select(
        F.col("date_key").alias("start_date_key"),
        F.col("full_date").alias("date_day"),
        "day_name",
        "is_weekend",
        "month_name",
        "quarter",
        "year",
        "week_of_year",
    )
    hours = F.broadcast(  # 24 rows
        times.select(
            F.col("time_key").alias("start_hour_key"),
            F.col("hour").alias("hour_of_day"),
            F.col("time_bucket").alias("time_of_day_name"),
            "is_rush_hour",
        )
    )
    joined = (
        groups.join(calendar, "start_date_key")
        .join(hours, "start_hour_key")
        .join(_user_types(users), "user_type_key")
        .withColumnRenamed("bike_type", "rideable_type")
    )
    mixed = _trip_mix(joined, "electric_bike_trips", "classic_bike_trips").drop(
        "start_date_key", "start_hour_key", "user_type_key"
    )
    shares = mixed.withColumns(
        {
            "member_pct": percent("member_trips"),
            "casual_pct": percent("casual_trips"),
            "electric_bike_pct": percent("electric_bike_trips"),
            "classic_bike_pct": percent("classic_bike_trips"),
        }
    )
    order = [F.desc("trip_count"), *[F.asc(c) for c in ("hour_of_day", "user_type_name", "rideable_type")]]
    ranked = number_within(shares, ["date_day"], order, "hourly_rank_by_day")
    # The summary has a row for each day of the window, hour, user type and bike type.
    overall = F.row_number().over(Window.orderBy(F.desc("date_day"), "hourly_rank_by_day"))
    ranked = ranked.withColumn("overall_rank", overall.cast("long"))
    return ranked.orderBy(F.desc("date_day"), "hour_of_day")


def route_counts(
    trips: DataFrame, stations: DataFrame, users: DataFrame, as_of: dt.date, days: int = 30
) -> DataFrame:
    """Trips by start station, end station, user type and bike type, without rank."""
    minutes = F.col("trip_duration_minutes")
    keys = ["start_station_key", "end_station_key", "user_type_key", "bike_type"]
    groups = (
        trips.where(F.col("start_date_key").between(*_key_window(as_of, days)))
        .where("start_station_key != end_station_key")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("trip_count"),
            F.avg(minutes).alias("avg_duration_minutes"),
            F.min(minutes).alias("min_duration_minutes"),
            F.max(minutes).alias("max_duration_minutes"),
        )
    )

    def place(role: str) -> DataFrame:
        return stations.select(
            F.col("station_key").alias(f"{role}_station_key"),
            F.col("station_id").alias(f"{role}_station_id"),
            F.col("station_name").alias(f"{role}_station_name"),
            F.col("latitude").alias(f"{role}_latitude"),
            F.col("longitude").alias(f"{role}_longitude"),
        )

    joined = (
        groups.join(place("start"), "start_station_key", "left")
        .join(place("end"), "end_station_key", "left")
        .join(_user_types(users), "user_type_key")
        .withColumnRenamed("bike_type", "rideable_type")
    )
    mixed = _trip_mix(joined, "electric_trips", "classic_trips").drop(*keys)
    return mixed.withColumns(
        {
            "member_pct": percent("member_trips"),
            "casual_pct": percent("casual_trips"),
            "electric_pct": percent("electric_trips"),
            "classic_pct": percent("classic_trips"),
            "route_popularity_category": ladder(F.col("trip_count"), ">=", rules.ROUTE_POPULARITY),
        }
    )


def routes(
    trips: DataFrame, stations: DataFrame, users: DataFrame, as_of: dt.date, days: int = 30
) -> DataFrame:
    """Routes with their popularity rank over the whole window."""
    counted = route_counts(trips, stations, users, as_of, days)
    rest = ["end_station_id", "user_type_name", "rideable_type"]
    return number_by_levels(counted, "trip_count", "start_station_id", rest, "popularity_rank").orderBy("popularity_rank")


def weather_impact(
    facts: DataFrame, dates: DataFrame, as_of: dt.date, days: int = 90
) -> DataFrame:
    """One row per day: weather, trips over all stations, and categories of both."""
    first = as_of - dt.timedelta(days=days)
    flags = [
        "is_ideal_biking_weather",
        "is_poor_biking_weather",
        "is_raining",
        "is_snowing",
        "is_freezing",
        "is_windy",
    ]
    network = (
        facts.where(F.col("date_day").between(F.lit(first), F.lit(as_of)))
        .groupBy("date_key")
        .agg(
            F.max("temperature_mean").alias("temperature_celsius"),
            F.max("temperature_range").alias("temperature_range"),
            F.max("precipitation_sum").alias("precipitation_mm"),
            F.max("wind_speed_max").alias("wind_speed_kmh"),
            F.max("weather_condition").alias("weather_condition"),
            F.max("weather_severity_score").alias("weather_severity_score"),
            *[F.max(F.col(c).cast("long")).alias(c) for c in flags],
            F.sum("trips_started").alias("total_trips_started"),
            F.sum("trips_ended").alias("total_trips_ended"),
            F.avg("avg_trip_duration_minutes").alias("avg_trip_duration"),
            F.avg("avg_bikes_available").alias("avg_bikes_available"),
            F.avg("avg_utilization_percentage").alias("avg_utilization_pct"),
            F.avg("operational_health_score").alias("avg_health_score"),
            # The fact has one row per station key and day, so rows are stations.
            F.count("station_key").alias("stations_reporting"),
        )
    )
    calendar = _days(dates, as_of, days).select(
        "date_key",
        F.col("full_date").alias("date_day"),
        "day_name",
        "is_weekend",
        "month_name",
        "season",
        "year",
        "quarter",
    )
    rain = F.col("precipitation_mm")
    categories = {
        "weather_category": choose(
            [
                (F.col("is_ideal_biking_weather") == 1, "Ideal Weather"),
                (F.col("is_poor_biking_weather") == 1, "Poor Weather"),
            ],
            "Normal Weather",
        ),
        "temperature_category": ladder(F.col("temperature_celsius"), "<", rules.VIEW_TEMPERATURE),
        "precipitation_category": F.when(rain == 0, "No Rain").otherwise(
            ladder(rain, "<", rules.VIEW_PRECIPITATION)
        ),
        "trip_volume_category": ladder(F.col("total_trips_started"), ">=", rules.TRIP_VOLUME),
        "avg_trips_per_station": ratio(F.col("total_trips_started"), F.col("stations_reporting")),
    }
    joined = network.join(calendar, "date_key").drop("date_key")
    return joined.withColumns(categories).orderBy(F.desc("date_day"))
