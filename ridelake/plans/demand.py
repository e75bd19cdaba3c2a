"""Rider demand per station and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake import rules
from ridelake.functions.bands import choose
from ridelake.functions.numeric import ratio
from ridelake.operators.aggregates import sql_columns
from ridelake.plans.staging import trip_ends

RIDERS = {"member": "member", "casual": "casual"}
BIKES = {"ebike": "electric_bike", "classic_bike": "classic_bike"}
QUANTILE_ACCURACY = 10_000


def _periods() -> dict[str, str]:
    morning, midday, evening = rules.MORNING_RUSH, rules.MIDDAY, rules.EVENING_RUSH
    return {
        "morning_rush": f"hour BETWEEN {morning[0]} AND {morning[1]}",
        "evening_rush": f"hour BETWEEN {evening[0]} AND {evening[1]}",
        "midday": f"hour BETWEEN {midday[0]} AND {midday[1]}",
        "night": f"hour > {evening[1]} OR hour < {morning[0]}",
    }


def duration_quantiles(minutes: str) -> str:
    """Median and 95th percentile from one sketch of bounded size, as an array; exact
    for groups within its accuracy."""
    return f"percentile_approx({minutes}, array(0.5, 0.95), {QUANTILE_ACCURACY})"


def demand_daily(trips: DataFrame) -> DataFrame:
    """Trips started and ended per station and day, with durations, riders, bikes,
    times of day, peak hours and the resulting flow."""
    ends = trip_ends(trips, ["minutes"], ["member_casual", "rideable_type"]).withColumn(
        "hour", F.hour("at").cast("long")
    )
    sides = {"started": "start", "ended": "end"}
    kinds = {name: f"member_casual = '{value}'" for name, value in RIDERS.items()}
    kinds |= {name: f"rideable_type = '{value}'" for name, value in BIKES.items()}
    kinds |= _periods()
    # ``minutes`` is null on the end side, so its aggregates see starts only.
    columns = {
        "avg_trip_duration_minutes": "avg(minutes)",
        "quantiles": duration_quantiles("minutes"),
        "min_trip_duration_minutes": "min(minutes)",
        "max_trip_duration_minutes": "max(minutes)",
        "stddev_trip_duration_minutes": "stddev_samp(minutes)",
    }
    for name, side in sides.items():
        columns[f"trips_{name}"] = f"count_if(side = '{side}')"
        for kind, test in kinds.items():
            columns[f"{kind}_trips_{name}"] = f"count_if(side = '{side}' AND ({test}))"
        # At most 24 hours to count, lowest on ties.
        columns[f"peak_{side}_hour"] = f"mode(if(side = '{side}', hour, NULL), true)"
    grouped = ends.groupBy("station_id", F.to_date("at").alias("date_day")).agg(
        *sql_columns(columns)
    )
    started, ended = F.col("trips_started"), F.col("trips_ended")
    net = started - ended
    rush = F.col("morning_rush_trips_started") + F.col("evening_rush_trips_started")
    flow = choose(
        [
            ((started == 0) & (ended == 0), "inactive"),
            (net > rules.FLOW_MARGIN, "net_source"),
            (net < -rules.FLOW_MARGIN, "net_sink"),
        ],
        "balanced",
    )
    return grouped.select(
        "station_id",
        "date_day",
        "trips_started",
        "trips_ended",
        net.alias("net_trips"),
        "avg_trip_duration_minutes",
        F.col("quantiles")[0].alias("median_trip_duration_minutes"),
        F.col("quantiles")[1].alias("p95_trip_duration_minutes"),
        "min_trip_duration_minutes",
        "max_trip_duration_minutes",
        "stddev_trip_duration_minutes",
        *[f"{r}_trips_{side}" for side in sides for r in RIDERS],
        *[f"{b}_trips_{side}" for side in sides for b in BIKES],
        *[
            f"{p}_trips_{side}"
            for side in sides
            for p in ("morning_rush", "evening_rush", "midday", "night")
        ],
        "peak_start_hour",
        "peak_end_hour",
        ratio(F.col("member_trips_started"), started).alias("member_pct_started"),
        ratio(F.col("casual_trips_started"), started).alias("casual_pct_started"),
        ratio(F.col("ebike_trips_started"), started).alias("ebike_pct_started"),
        flow.alias("station_flow_pattern"),
        ratio(rush, started).alias("rush_hour_intensity"),
    )
