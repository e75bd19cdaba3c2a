"""Station supply: status reports, and their day summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake import rules
from ridelake.functions.bands import choose, ladder
from ridelake.functions.calendar import five_minute_start
from ridelake.functions.numeric import ratio, total
from ridelake.operators.aggregates import (
    count_slots,
    merged_mean,
    merged_stddev,
    slot_masks,
    sql_columns,
)

COUNTERS = [
    "num_bikes_available",
    "num_ebikes_available",
    "num_bikes_disabled",
    "num_docks_available",
    "num_docks_disabled",
    "num_scooters_available",
    "num_scooters_unavailable",
]


def station_metrics(status: DataFrame) -> DataFrame:
    """Capacity, occupancy and state of every report of an installed station."""
    count = {c: F.col(c) for c in COUNTERS}
    capacity = total(list(count.values()))
    rideable = count["num_bikes_available"] + count["num_ebikes_available"]
    present = rideable + count["num_scooters_available"]
    in_use = capacity - count["num_docks_available"]
    no_bikes, no_docks = rideable == 0, count["num_docks_available"] == 0
    renting, returning = F.col("is_renting"), F.col("is_returning")
    state = choose(
        [
            (~F.col("is_installed"), "not_installed"),
            (~renting & ~returning, "out_of_service"),
            (~renting, "not_renting"),
            (~returning, "not_returning"),
            (no_bikes, "empty"),
            (no_docks, "full"),
        ],
        "operational",
    )
    return status.where("is_installed").select(
        "station_id",
        "legacy_id",
        five_minute_start(F.col("last_reported")).alias("reported_at_5min"),
        "last_reported",
        *COUNTERS,
        capacity.alias("total_capacity"),
        F.when(capacity > 0, ratio(present, capacity)).alias("occupancy_ratio"),
        F.when(capacity > 0, ratio(in_use, capacity)).alias("utilization_percentage"),
        no_bikes.alias("is_empty"),
        no_docks.alias("is_full"),
        "is_installed",
        "is_renting",
        "is_returning",
        state.alias("operational_status"),
        F.when(rideable > 0, ratio(count["num_ebikes_available"], rideable)).alias("ebike_ratio"),
        "api_last_updated",
        "ingestion_timestamp",
    )


# Order of the averaged counters in the day summary.
AVERAGED_COUNTERS = [
    "num_bikes_available",
    "num_ebikes_available",
    "num_docks_available",
    "num_bikes_disabled",
    "num_docks_disabled",
    "num_scooters_available",
    "num_scooters_unavailable",
]


def _short(counter: str) -> str:
    return counter.removeprefix("num_")


def _merged_spread(column: str) -> str:
    return merged_stddev(f"{column}_n", f"{column}_mean", f"{column}_var")


def station_daily(metrics: DataFrame) -> DataFrame:
    """One row per station and day.

    Grouped in two steps. The first adds the capacity to the key, so the second can
    pick the most frequent capacity from counts instead of holding every value of a
    station-day. All first-step aggregates are plain sums, extremes and moments:
    they run as generated hash aggregation with map-side combine, on one scan.
    """
    slot = f"((unix_seconds(reported_at_5min) % 86400) div {rules.POLL_SECONDS})"
    masks = slot_masks(slot, rules.POLLS_PER_DAY)
    extremes = ["num_bikes_available", "num_docks_available", "num_scooters_available"]
    ratios = ["occupancy_ratio", "utilization_percentage"]
    averaged = [*COUNTERS, "ebike_ratio"]

    first = {"n": "count(*)"}
    for c in averaged:
        first |= {f"{c}_sum": f"sum({c})", f"{c}_n": f"count({c})"}
    for c in ratios:
        first |= {f"{c}_mean": f"avg({c})", f"{c}_var": f"var_pop({c})", f"{c}_n": f"count({c})"}
    for c in [*extremes, "occupancy_ratio"]:
        first |= {f"{c}_max": f"max({c})", f"{c}_min": f"min({c})"}
    first |= {
        "empty_n": "count_if(is_empty)",
        "full_n": "count_if(is_full)",
        "operational_n": "count_if(operational_status = 'operational')",
        "out_of_service_n": "count_if(operational_status = 'out_of_service')",
        **masks,
        "installed_all": "bool_and(is_installed)",
        "renting_any": "bool_or(is_renting)",
        "returning_any": "bool_or(is_returning)",
        "first_at": "min(last_reported)",
        "last_at": "max(last_reported)",
    }
    day = F.to_date("reported_at_5min").alias("date_day")
    parts = metrics.groupBy("station_id", day, "total_capacity").agg(*sql_columns(first))

    intervals = count_slots(list(masks))
    second = {
        "typical_capacity": "min_by(total_capacity, struct(-n, total_capacity IS NULL, total_capacity))",
        "max_capacity": "max(total_capacity)",
        "min_capacity": "min(total_capacity)",
    }
    for c in AVERAGED_COUNTERS:
        second[f"avg_{_short(c)}"] = f"try_divide(cast(sum({c}_sum) AS double), sum({c}_n))"
    for edge in ("max", "min"):
        second |= {f"{edge}_{_short(c)}": f"{edge}({c}_{edge})" for c in extremes}
    second |= {
        "avg_occupancy_ratio": merged_mean("occupancy_ratio_n", "occupancy_ratio_mean"),
        "occupancy_volatility": _merged_spread("occupancy_ratio"),
        "min_occupancy_ratio": "min(occupancy_ratio_min)",
        "max_occupancy_ratio": "max(occupancy_ratio_max)",
        "avg_utilization_percentage": merged_mean(
            "utilization_percentage_n", "utilization_percentage_mean"
        ),
        "utilization_volatility": _merged_spread("utilization_percentage"),
        "avg_ebike_ratio": "try_divide(sum(ebike_ratio_sum), sum(ebike_ratio_n))",
        "pct_time_empty": "sum(empty_n) / sum(n)",
        "pct_time_full": "sum(full_n) / sum(n)",
        "pct_time_operational": "sum(operational_n) / sum(n)",
        "pct_time_out_of_service": "sum(out_of_service_n) / sum(n)",
        "total_observations": "sum(n)",
        "unique_5min_intervals": intervals,
        "time_coverage_ratio": f"{intervals} / {rules.POLLS_PER_DAY}D",
        "was_installed_all_day": "bool_and(installed_all)",
        "was_renting_any_time": "bool_or(renting_any)",
        "was_returning_any_time": "bool_or(returning_any)",
        "first_reported_at": "min(first_at)",
        "last_reported_at": "max(last_at)",
    }
    daily = parts.groupBy("station_id", "date_day").agg(*sql_columns(second))
    unusable = F.col("pct_time_empty") + F.col("pct_time_full")
    return daily.withColumns(
        {
            "operational_health_score": ladder(
                F.col("pct_time_operational"), ">=", rules.HEALTH_SCORE
            ).cast("long"),
            "rebalancing_need": ladder(unusable, ">", rules.REBALANCING),
            "data_quality": ladder(F.col("time_coverage_ratio"), "<", rules.COVERAGE_GRADE),
        }
    )


def with_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Station-days with the day's weather, its classes, flags and scores.

    ``weather`` has one row per day; pass a stored table, so that its file size
    decides whether it is broadcast.
    """
    measures = [
        "temperature_max",
        "temperature_min",
        "temperature_mean",
        "precipitation_sum",
        "rain_sum",
        "snowfall_sum",
        "precipitation_hours",
        "weather_code",
        "wind_speed_max",
        "wind_gusts_max",
    ]
    days = weather.select("weather_date", *measures)
    joined = daily.join(days, F.col("date_day") == F.col("weather_date"), "left").drop("weather_date")
    return joined.withColumns(weather_features())


def weather_features() -> dict:
    """Class, flag and score columns from the raw weather measures."""
    rain, snow = F.col("precipitation_sum"), F.col("snowfall_sum")
    mean, wind, code = F.col("temperature_mean"), F.col("wind_speed_max"), F.col("weather_code")
    condition = F
    for label, codes in rules.WMO_CONDITIONS.items():
        condition = condition.when(code.isin(codes), label)
    condition = condition.when(code.isNotNull(), "other").otherwise("unknown")

    points = {
        "rain": rain > 0,
        "snow": snow > 0,
        "frost": mean < 0,
        "heat": mean > rules.HEAT_LIMIT,
        "wind": wind > rules.WIND_LIMIT,
    }
    severity = total(
        [F.when(c, rules.SEVERITY_POINTS[name]).otherwise(0) for name, c in points.items()]
    )
    ideal = (
        code.isin(rules.IDEAL_CODES)
        & mean.between(*rules.IDEAL_TEMPERATURE)
        & (rain == 0)
        & (wind < rules.IDEAL_WIND_BELOW)
    )
    poor = (
        (rain > rules.POOR_RAIN_ABOVE)
        | points["snow"]
        | points["frost"]
        | points["heat"]
        | (wind > rules.POOR_WIND_ABOVE)
    )
    no = F.lit(False)
    return {
        "weather_condition": condition,
        "temperature_range": F.when(mean.isNull(), "unknown").otherwise(
            ladder(mean, "<", rules.TEMPERATURE_RANGE)
        ),
        "is_raining": points["rain"],
        "is_snowing": points["snow"],
        "is_freezing": mean <= 0,
        "is_windy": points["wind"],
        "precipitation_intensity": F.when(rain == 0, "none").otherwise(
            ladder(rain, "<", rules.PRECIPITATION_INTENSITY)
        ),
        "weather_severity_score": F.least(F.lit(rules.SEVERITY_CAP), severity).cast("long"),
        "is_ideal_biking_weather": F.coalesce(ideal, no),
        "is_poor_biking_weather": F.coalesce(poor, no),
    }
