"""The station-day fact: supply, demand and weather, with trends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake import rules
from ridelake.functions import calendar
from ridelake.functions.bands import choose
from ridelake.functions.numeric import clamp, ratio
from ridelake.operators.windows import last_rows, trailing
from ridelake.session import stage

SUPPLY = [
    "typical_capacity",
    "max_capacity",
    "min_capacity",
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
    "operational_health_score",
    "rebalancing_need",
    "data_quality",
]
# True: zero when a station-day has no trips.
DEMAND = {
    "trips_started": True,
    "trips_ended": True,
    "net_trips": True,
    "avg_trip_duration_minutes": False,
    "median_trip_duration_minutes": False,
    "p95_trip_duration_minutes": False,
    "member_trips_started": True,
    "casual_trips_started": True,
    "ebike_trips_started": True,
    "classic_bike_trips_started": True,
    "morning_rush_trips_started": True,
    "evening_rush_trips_started": True,
    "member_pct_started": False,
    "ebike_pct_started": False,
    "station_flow_pattern": False,
    "rush_hour_intensity": False,
}
WEATHER = [
    "temperature_mean",
    "temperature_max",
    "temperature_min",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "wind_speed_max",
    "weather_condition",
    "temperature_range",
    "is_raining",
    "is_snowing",
    "is_freezing",
    "is_windy",
    "precipitation_intensity",
    "weather_severity_score",
    "is_ideal_biking_weather",
    "is_poor_biking_weather",
]
# Trailing averages: new column -> (source column, rows in the frame).
ROLLING = {
    "avg_bikes_available_7d": ("avg_bikes_available", 7),
    "avg_occupancy_ratio_7d": ("avg_occupancy_ratio", 7),
    "avg_utilization_7d": ("avg_utilization_percentage", 7),
    "avg_pct_time_empty_7d": ("pct_time_empty", 7),
    "avg_pct_time_full_7d": ("pct_time_full", 7),
    "avg_trips_started_7d": ("trips_started", 7),
    "avg_trips_ended_7d": ("trips_ended", 7),
    "avg_total_activity_7d": ("total_trip_activity", 7),
    "avg_trips_started_28d": ("trips_started", 28),
    "avg_occupancy_ratio_28d": ("avg_occupancy_ratio", 28),
}
LAGS = {
    "trips_started_prev_day": ("trips_started", 1),
    "occupancy_ratio_prev_day": ("avg_occupancy_ratio", 1),
    "trips_started_same_day_last_week": ("trips_started", 7),
}
# Rows of history a station needs before the first day that is written.
LOOK_BACK_ROWS = 27


def supply_demand(supply: DataFrame, demand: DataFrame) -> DataFrame:
    """Full outer join of both sides on (station, day).

    Both inputs come out of an aggregate on these keys, so the join adds no shuffle.
    """
    right = demand.select("station_id", "date_day", *DEMAND)
    joined = supply.select("station_id", "date_day", *SUPPLY, *WEATHER).join(
        right, ["station_id", "date_day"], "full_outer"
    )
    measures = [
        (F.coalesce(F.col(c), F.lit(0)) if zero else F.col(c)).alias(c) for c, zero in DEMAND.items()
    ]
    return joined.select("station_id", "date_day", *SUPPLY, *measures, *WEATHER)


def with_balance(joined: DataFrame) -> DataFrame:
    """Supply against demand, and the calendar columns."""
    trips, bikes = F.col("trips_started"), F.col("avg_bikes_available")
    pressure = (F.try_divide(trips.cast("double"), bikes) - 1) * 50
    balance = choose(
        [(bikes == 0, 100.0), (trips == 0, -100.0)], clamp(pressure, -100, 100)
    )
    return joined.withColumns(
        {
            "trips_per_bike_ratio": ratio(trips, bikes),
            "demand_capacity_ratio": ratio(trips, F.col("typical_capacity")),
            "supply_demand_balance_score": balance,
            "total_trip_activity": trips + F.col("trips_ended"),
            **calendar.parts(F.col("date_day")),
        }
    )


def with_history(rows: DataFrame) -> DataFrame:
    """Trailing averages and lags of each station, which has one row per day at most."""
    return trailing(rows, "station_id", "date_day", ROLLING, LAGS)


def with_trend(rows: DataFrame) -> DataFrame:
    trips, week = F.col("trips_started"), F.col("avg_trips_started_7d")
    up = [(trips > week * factor, label) for factor, label in rules.TREND_UP]
    down = [(trips < week * factor, label) for factor, label in rules.TREND_DOWN]
    return rows.withColumns(
        {
            "trips_started_change_dod": trips - F.col("trips_started_prev_day"),
            "trips_started_change_wow": trips - F.col("trips_started_same_day_last_week"),
            "trips_started_deviation_pct_7d": ratio(trips - week, week) * 100,
            "demand_trend": choose(up + down, "stable"),
        }
    )


def station_daily_fact(supply: DataFrame, demand: DataFrame) -> DataFrame:
    return with_trend(with_history(with_balance(supply_demand(supply, demand))))


def station_daily_fact_since(
    supply: DataFrame, demand: DataFrame, stored: DataFrame, first_day: Column
) -> DataFrame:
    """The fact from ``first_day`` on, equal to the same rows of a full refresh.

    ``supply`` and ``demand`` need only the new days. Frames reach back 27 rows, not
    27 days, so the stored fact gives each station its last 27 rows before them.
    """
    base = with_balance(
        supply_demand(
            supply.where(F.col("date_day") >= first_day),
            demand.where(F.col("date_day") >= first_day),
        )
    )
    # Of the stored rows only the columns the frames look at are read.
    used = {"station_id", "date_day", *[source for source, _ in (*ROLLING.values(), *LAGS.values())]}
    before = stored.where(F.col("date_day") < first_day).select(*[c for c in base.columns if c in used])
    history = last_rows(before, "station_id", "date_day", LOOK_BACK_ROWS)
    computed = with_trend(with_history(base.unionByName(history, allowMissingColumns=True)))
    return computed.where(F.col("date_day") >= first_day)


def frames_around(keys: DataFrame, reach: int = LOOK_BACK_ROWS) -> DataFrame:
    """Which station-days a change reaches, and which of the others their frames need.

    ``keys``: station_id, date_day, ``held`` (the row exists) and ``changed`` (it came, went
    or was worked out again). A frame holds ``reach`` rows before its own, so a change reaches
    that many rows of its station after it, and no further.
    """
    of_station = Window.partitionBy("station_id").orderBy("date_day")
    later = of_station.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    place = F.sum(F.col("held").cast("int")).over(of_station)
    placed = keys.withColumn("_place", place)
    placed = placed.withColumn("_since", F.col("_place") - F.max(F.when(F.col("changed"), F.col("_place"))).over(of_station))
    affected = F.col("held") & F.coalesce(F.col("changed") | (F.col("_since") <= reach), F.lit(False))
    placed = placed.withColumn("affected", affected)
    ahead = F.min(F.when(F.col("affected"), F.col("_place"))).over(later) - F.col("_place")
    needed = F.col("held") & F.coalesce(ahead <= reach, F.lit(False))
    return placed.select("station_id", "date_day", "affected", needed.alias("needed")).where("needed")


def station_daily_fact_around(
    supply: DataFrame, demand: DataFrame, stored: DataFrame, days: list[dt.date]
) -> tuple[DataFrame, list[dt.date]]:
    """The fact's partitions that change, whole, and their days, after the inputs of ``days``
    have changed.

    ``supply`` and ``demand`` hold those days, whole. Their rows are worked out again; so are
    the trends of the rows whose frames reach a changed row, at most 27 rows of a station
    after it. From the stored fact only the station and day of all rows are read, and more of
    the days that change or that a frame needs.
    """
    key = ["station_id", "date_day"]
    within = F.col("date_day").isin(days)
    base = stage(with_balance(supply_demand(supply, demand)), "changed-days")
    held, changed = F.lit(True).alias("held"), F.lit(True).alias("changed")
    gone = stored.where(within).select(*key).join(base.select(*key), key, "left_anti")
    keys = (
        base.select(*key, held, changed)
        .unionByName(gone.select(*key, F.lit(False).alias("held"), changed))
        .unionByName(stored.where(~within).select(*key, held, F.lit(False).alias("changed")))
    )
    frames = stage(frames_around(keys), "frames")
    # One value a day goes to the driver, so that scans prune by literals.
    flags = {r[0]: r[1] for r in frames.groupBy("date_day").agg(F.max("affected")).collect()}
    rewritten = sorted({*days, *(day for day, affected in flags.items() if affected)})
    others = [day for day in rewritten if day not in set(days)]

    affected = frames.where("affected").select(*key)
    after = stored.where(F.col("date_day").isin(others))
    kept = after.select(*base.columns).join(affected, key, "left_semi")
    used = {*key, *[source for source, _ in (*ROLLING.values(), *LAGS.values())]}
    before = stored.where(F.col("date_day").isin([d for d in flags if d not in set(days)]))
    before = before.select(*[c for c in base.columns if c in used]).join(frames.where("NOT affected").select(*key), key, "left_semi")
    rows = base.unionByName(kept).unionByName(before, allowMissingColumns=True)
    computed = with_trend(with_history(rows)).join(affected, key, "left_semi")
    return computed.select(*stored.columns).unionByName(after.join(affected, key, "left_anti").select(*stored.columns)), rewritten
