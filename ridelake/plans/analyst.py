"""Analyst questions and dashboard charts over the star schema and the views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions.numeric import ratio
from ridelake.operators.ranking import top_k

SUMMER = [6, 7, 8]


def _star(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Inner join that keeps the dimension columns only once."""
    side = dimension.withColumnRenamed(dimension_key, "_key")
    return fact.join(side, F.col(fact_key) == F.col("_key")).drop("_key")


def daily_trend(trips: DataFrame, dates: DataFrame, year: int, month: int) -> DataFrame:
    """Trips, mean duration and distance per day of one month."""
    lo, hi = year * 10000 + month * 100, year * 10000 + month * 100 + 31
    days = trips.where(F.col("start_date_key").between(lo, hi)).groupBy("start_date_key").agg(
        F.count("trip_key").alias("total_trips"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.sum("trip_distance_km").alias("total_distance"),
    )
    calendar = dates.where((F.col("year") == year) & (F.col("month") == month)).select(
        "date_key", "full_date", "day_name", "is_weekend"
    )
    return _star(days, calendar, "start_date_key", "date_key").drop("start_date_key").orderBy("full_date")


def busiest_stations(
    facts: DataFrame, stations: DataFrame, dates: DataFrame, day: dt.date, k: int = 20
) -> DataFrame:
    """The k active stations with most started trips on one day."""
    measures = [
        "trips_started",
        "trips_ended",
        "net_trips",
        "avg_occupancy_ratio",
        "operational_health_score",
        "demand_trend",
    ]
    rows = facts.where(F.col("date_day") == F.lit(day)).select("station_key", "date_key", *measures)
    places = stations.where("is_active").select("station_key", "station_id", "station_name", "borough")
    named = rows.join(places, "station_key").join(dates.select("date_key", "day_name"), "date_key")
    best = top_k(named, k, [F.desc("trips_started"), F.asc("station_id")])
    return best.select("station_name", "borough", "day_name", *measures)


def hourly_pattern(
    trips: DataFrame, dates: DataFrame, times: DataFrame, users: DataFrame, year: int
) -> DataFrame:
    """Weekday trips by hour and user type."""
    working = dates.where(~F.col("is_weekend") & (F.col("year") == year)).select("date_key")
    minutes = F.col("trip_duration_minutes")
    # Counts and sums per day, hour and user type come first; the calendar then filters days.
    parts = trips.groupBy("start_date_key", "start_hour_key", "user_type_key").agg(
        F.count("trip_key").alias("n"), F.sum(minutes).alias("m")
    )
    kept = _star(parts, working, "start_date_key", "date_key")
    hours = times.select("time_key", "hour_name", "time_bucket", "is_rush_hour")
    kinds = users.select(F.col("user_type_key").alias("kind"), "user_type_name")
    named = _star(_star(kept, F.broadcast(hours), "start_hour_key", "time_key"), F.broadcast(kinds), "user_type_key", "kind")
    return (
        named.groupBy("hour_name", "time_bucket", "is_rush_hour", "user_type_name")
        .agg(
            F.sum("n").alias("trip_count"),
            ratio(F.sum("m"), F.sum("n")).alias("avg_duration"),
        )
        .orderBy("hour_name", "user_type_name")
    )


def weather_effect(
    facts: DataFrame, dates: DataFrame, year: int, months: list[int] = SUMMER
) -> DataFrame:
    """Trips and occupancy by weather over some months."""
    days = dates.where((F.col("year") == year) & F.col("month").isin(months)).select("date_key")
    # The fact lies in folders by day, which this condition selects.
    in_season = (F.year("date_day") == year) & F.month("date_day").isin(months)
    weather = ["weather_condition", "is_ideal_biking_weather", "is_poor_biking_weather"]
    return (
        facts.where(in_season)
        .join(days, "date_key")
        .groupBy(*weather)
        .agg(
            F.count_distinct("station_key").alias("stations"),
            F.sum("trips_started").alias("total_trips"),
            F.avg("avg_occupancy_ratio").alias("avg_occupancy"),
            F.avg("temperature_mean").alias("avg_temp"),
        )
        .orderBy(F.desc("total_trips"))
    )


def duration_sanity(trips: DataFrame) -> DataFrame:
    return trips.where("trip_duration_minutes > 0").agg(
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.min("trip_duration_minutes").alias("min_duration"),
        F.max("trip_duration_minutes").alias("max_duration"),
    )


def filtered(
    view: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    equal: dict[str, object] | None = None,
    between: dict[str, tuple] | None = None,
) -> DataFrame:
    """Dashboard controls: a date range, drop-downs and sliders, each optional."""
    if first is not None:
        view = view.where(F.col("date_day") >= F.lit(first))
    if last is not None:
        view = view.where(F.col("date_day") <= F.lit(last))
    for column, value in (equal or {}).items():
        view = view.where(F.col(column) == F.lit(value))
    for column, (low, high) in (between or {}).items():
        view = view.where(F.col(column).between(low, high))
    return view


def scorecards(view: DataFrame) -> DataFrame:
    """Headline numbers of the daily trips view.

    The plain averages weigh every summary row alike, as the dashboard does; the
    weighted ones weigh every trip alike.
    """
    trips = F.col("trip_count")

    def weighted(column: str) -> Column:
        return ratio(F.sum(F.col(column) * trips), F.sum(trips))

    def portion(column: str) -> Column:
        return ratio(F.sum(column), F.sum(trips)) * 100

    return view.agg(
        F.sum(trips).alias("total_trips"),
        F.avg("avg_trip_duration").alias("avg_duration"),
        F.avg("member_pct").alias("member_pct"),
        F.avg("electric_bike_pct").alias("electric_bike_pct"),
        weighted("avg_trip_duration").alias("avg_duration_weighted"),
        portion("member_trips").alias("member_pct_weighted"),
        portion("electric_bike_trips").alias("electric_bike_pct_weighted"),
    )


def chart_breakdowns(view: DataFrame) -> DataFrame:
    """Trips by hour and user, by user, by bike and by time of day, in one pass.

    Each summary row is counted once for every chart it belongs to.
    """
    none = F.lit(None).cast("string")
    hour = F.format_string("%02d", "hour_of_day")
    charts = [
        ("hour_by_user", hour, F.col("user_type_name")),
        ("user_type", F.col("user_type_name"), none),
        ("bike_type", F.col("rideable_type"), none),
        ("time_of_day", F.col("time_of_day_name"), none),
    ]
    entries = [
        F.struct(F.lit(n).alias("chart"), a.alias("item"), b.alias("series")) for n, a, b in charts
    ]
    return (
        view.select("trip_count", F.inline(F.array(*entries)))
        .groupBy("chart", "item", "series")
        .agg(F.sum("trip_count").alias("trips"))
    )


def hourly_table(view: DataFrame) -> DataFrame:
    """The detail table under the daily charts."""
    keys = ["date_day", "hour_of_day", "time_of_day_name", "user_type_name", "rideable_type"]
    return (
        view.groupBy(*keys)
        .agg(
            F.sum("trip_count").alias("trips"),
            F.avg("avg_trip_duration").alias("avg_duration"),
            F.avg("member_pct").alias("member_pct"),
            F.avg("electric_bike_pct").alias("electric_bike_pct"),
        )
        .orderBy(F.desc("date_day"), "hour_of_day")
    )


ROUTE = ["start_station_id", "start_station_name", "end_station_id", "end_station_name"]


def route_totals(routes: DataFrame) -> DataFrame:
    """Trips per start and end station over all users and bikes."""
    return routes.groupBy(*ROUTE).agg(F.sum("trip_count").alias("trips"))


def route_scorecards(routes: DataFrame, min_trips: int = 1) -> DataFrame:
    """Number of routes, trips per row, and the busiest route."""
    totals = route_totals(routes.where(F.col("trip_count") >= min_trips))
    label = F.concat_ws(" → ", "start_station_name", "end_station_name")
    rank = F.struct(-F.col("trips"), "start_station_id", "end_station_id")
    best = totals.agg(
        F.count("*").alias("total_routes"),
        ratio(F.sum("trips"), F.count("*")).alias("avg_trips_per_route"),
        F.min_by(label, rank).alias("most_popular_route"),
        F.max("trips").alias("most_popular_trips"),
    )
    return best


def top_routes(routes: DataFrame, k: int = 20) -> DataFrame:
    grouped = routes.groupBy(*ROUTE, "route_popularity_category").agg(
        F.sum("trip_count").alias("trips"),
        F.avg("avg_duration_minutes").alias("avg_duration"),
        F.avg("member_pct").alias("member_pct"),
        F.avg("electric_pct").alias("electric_pct"),
    )
    ties = ["start_station_id", "end_station_id", "route_popularity_category"]
    return top_k(grouped, k, [F.desc("trips"), *[F.asc(c) for c in ties]])


def top_stations(routes: DataFrame, role: str, k: int = 15) -> DataFrame:
    """Busiest stations as 'start' or 'end' of routes."""
    columns = [f"{role}_station_id", f"{role}_station_name"]
    totals = routes.groupBy(*columns).agg(F.sum("trip_count").alias("trips"))
    return top_k(totals, k, [F.desc("trips"), F.asc(columns[0])])


def station_map(routes: DataFrame, role: str) -> DataFrame:
    """Bubble size and colour per station place."""
    place = [f"{role}_latitude", f"{role}_longitude"]
    return routes.groupBy(*place).agg(
        F.sum("trip_count").alias("trips"), F.avg("avg_duration_minutes").alias("avg_duration")
    )


def weather_scorecards(view: DataFrame) -> DataFrame:
    return view.agg(
        F.avg("total_trips_started").alias("avg_daily_trips"),
        F.sum("is_ideal_biking_weather").alias("ideal_days"),
        F.sum("is_poor_biking_weather").alias("poor_days"),
        F.avg("temperature_celsius").alias("avg_temperature"),
    )


def trend_line(view: DataFrame) -> DataFrame:
    """Least-squares lines of daily trips over temperature and over precipitation."""
    trips = F.col("total_trips_started")
    lines = view.agg(
        *[
            f(trips, F.col(x)).alias(f"{x}_{name}")
            for x in ("temperature_celsius", "precipitation_mm")
            for name, f in (("slope", F.regr_slope), ("intercept", F.regr_intercept), ("r", F.corr))
        ],
    )
    return lines


def weather_breakdown(view: DataFrame) -> DataFrame:
    """Mean trips by condition and by temperature, and the share of each weather category."""
    charts = ["weather_condition", "temperature_category", "weather_category"]
    entries = [F.struct(F.lit(c).alias("chart"), F.col(c).alias("item")) for c in charts]
    days = view.select("date_day", "total_trips_started", F.inline(F.array(*entries)))
    grouped = days.groupBy("chart", "item").agg(
        F.avg("total_trips_started").alias("avg_trips"), F.count("date_day").alias("days")
    )
    # Every day is in each chart once, so a chart's days add up to all days.
    in_chart = F.sum("days").over(Window.partitionBy("chart"))
    return grouped.withColumn("share_pct", ratio(F.col("days"), in_chart) * 100)


def weather_table(view: DataFrame) -> DataFrame:
    keys = ["date_day", "day_name", "weather_condition", "temperature_category", "precipitation_category"]
    return (
        view.groupBy(*keys)
        .agg(
            F.sum("total_trips_started").alias("trips"),
            F.avg("temperature_celsius").alias("temperature"),
            F.sum("precipitation_mm").alias("precipitation"),
            F.max("wind_speed_kmh").alias("wind"),
            F.avg("avg_trip_duration").alias("avg_duration"),
        )
        .orderBy(F.desc("date_day"))
    )
