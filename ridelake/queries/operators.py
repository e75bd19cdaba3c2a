"""Single operators on real feeds: joins, ranks, upserts, snapshots, slices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.calendar import date_key, five_minute_start, utc
from ridelake.functions.numeric import elapsed
from ridelake.operators import aggregates, incremental, joins, layout, ranking, scd2, windows
from ridelake.plans import daily, demand, dimensions, monitor
from ridelake.plans.dimensions import TRACKED
from ridelake.queries.models import models
from ridelake.session import stage, stage_path
from ridelake.sources.feeds import NOW

CUTOFF = dt.date(2024, 1, 20)
FIRST_SNAPSHOT = dt.datetime(2024, 1, 1)
SECOND_SNAPSHOT = dt.datetime(2024, 1, 15)


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = models(spark, sf_dir).stg_station_status
    return ranking.latest_per_key(status, ["station_id"], [F.desc("last_reported")])


def user_key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return spark.sql(
        """
        SELECT t.ride_id, coalesce(
          u.user_type_key, (SELECT user_type_key FROM {users} WHERE user_type_id = 'unknown')
        ) AS user_type_key
        FROM {trips} t LEFT JOIN {users} u ON t.member_casual = u.user_type_id
        """,
        trips=m.stg_trips,
        users=m.dim_user_type,
    )


def late_dim_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per date key while the date dimension still ends at the cutoff."""
    m = models(spark, sf_dir)
    early = stage(m.dim_date.where(F.col("full_date") < F.lit(CUTOFF)), "early_dates")
    day = F.to_date("started_at")
    found = joins.lookup(m.stg_trips, early, "full_date", day, {"date_key": "found_key"})
    keyed = found.select(
        F.coalesce("found_key", date_key(day)).alias("start_date_key"),
        F.col("found_key").isNull().alias("is_late"),
    )
    return keyed.groupBy("start_date_key", "is_late").agg(F.count("*").alias("trips"))


def star_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven dimension lookups of a trip: both stations, dates and hours, the user type."""
    m = models(spark, sf_dir)
    dates = stage(m.dim_date.select("full_date", "date_key", "day_name"), "dates")
    hours, users = F.broadcast(m.dim_time), F.broadcast(m.dim_user_type)  # 24 and 3 rows
    start, end = F.col("started_at"), F.col("ended_at")
    star = joins.lookup(m.stg_trips, m.dim_station, "station_id", "start_station_id", {"station_name": "from_name"})
    star = joins.lookup(star, m.dim_station, "station_id", "end_station_id", {"station_name": "to_name"})
    star = joins.lookup(star, dates, "full_date", F.to_date(start), {"day_name": "start_day"})
    star = joins.lookup(star, dates, "full_date", F.to_date(end), {"day_name": "end_day"})
    star = joins.lookup(star, hours, "time_key", F.hour(start), {"time_bucket": "start_bucket"})
    star = joins.lookup(star, hours, "time_key", F.hour(end), {"time_bucket": "end_bucket"})
    star = joins.lookup(star, users, "user_type_id", "member_casual", {"user_type_name": "rider"})
    roles = ["from_name", "to_name", "start_day", "end_day", "start_bucket", "end_bucket", "rider"]
    return star.select("ride_id", *roles)


def _station_history(spark: SparkSession, sf_dir: str, strategy: str, drop: bool) -> DataFrame:
    """Two snapshot runs: between them even stations are renamed, and with ``drop``
    station S29 disappears."""
    trips = models(spark, sf_dir).stg_trips
    master = stage(dimensions.station_master(trips, FIRST_SNAPSHOT), "master")
    number = F.substring("station_id", 2, 9).cast("long")
    renamed = F.when(number % 2 == 0, F.concat("station_name", F.lit(" (moved)")))
    later = master.withColumns(
        {
            "station_name": F.coalesce(renamed, "station_name"),
            "updated_at": utc(SECOND_SNAPSHOT),
        }
    )
    if drop:
        later = later.where("station_id <> 'S29'")
    return scd2.apply_snapshot(
        scd2.first_snapshot(master, "station_id"),
        later,
        "station_id",
        TRACKED,
        run_at=utc(SECOND_SNAPSHOT),
        strategy=strategy,
    )


_VERSION = ["station_id", "station_name", "is_active", "version_id", "valid_from", "valid_to"]


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _station_history(spark, sf_dir, "check", drop=False).select(*_VERSION)


def scd2_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _station_history(spark, sf_dir, "timestamp", drop=False).select(*_VERSION)


def scd2_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _station_history(spark, sf_dir, "check", drop=True).select(*_VERSION)


def pit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per station version that was valid when they started."""
    trips = models(spark, sf_dir).stg_trips.select("start_station_id", "started_at")
    history = stage(_station_history(spark, sf_dir, "check", drop=False), "history").select(
        "station_id", "station_name", "valid_from", "valid_to"
    )
    placed = joins.point_in_time(
        trips,
        history.withColumnRenamed("station_id", "start_station_id"),
        "start_station_id",
        "started_at",
        "valid_from",
        "valid_to",
    )
    return placed.groupBy("start_station_id", "station_name", "valid_from").agg(
        F.count("*").alias("trips")
    )


def salted_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station names per trip through a salted join, counted per name."""
    m = models(spark, sf_dir)
    trips = m.stg_trips.select("ride_id", F.col("start_station_id").alias("station_id"))
    names = m.dim_station.select("station_id", "station_name")
    named = joins.salted_join(trips, names, ["station_id"], F.col("ride_id"), salts=8)
    return named.groupBy("station_id", "station_name").agg(F.count("*").alias("trips"))


def mode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent bike, rider and end latitude of the trips from each station."""
    trips = models(spark, sf_dir).stg_trips.where("start_station_id is not null")
    return aggregates.modal_values(
        trips, ["start_station_id"], ["rideable_type", "member_casual"], ["end_lat"]
    )


def duration_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = elapsed("MINUTE", F.col("started_at"), F.col("ended_at"))
    trips = models(spark, sf_dir).stg_trips.withColumn("minutes", minutes)
    quantiles = {"q": demand.duration_quantiles("minutes")}
    return (
        trips.groupBy("rideable_type", F.to_date("started_at").alias("date_day"))
        .agg(*aggregates.sql_columns(quantiles))
        .select("rideable_type", "date_day", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"))
    )


def _started(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).int_trip_station_daily.select(
        "station_id", "date_day", "trips_started", "trips_ended"
    )


def rolling_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = {"started_7d": ("trips_started", 7), "ended_7d": ("trips_ended", 7)}
    return windows.trailing(_started(spark, sf_dir), "station_id", "date_day", averages)


def rolling_28d(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = {"started_28d": ("trips_started", 28)}
    return windows.trailing(_started(spark, sf_dir), "station_id", "date_day", averages)


def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = {"started_prev": ("trips_started", 1), "started_week_ago": ("trips_started", 7)}
    return windows.trailing(_started(spark, sf_dir), "station_id", "date_day", lags=back)


def order_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing averages over six years of daily orders per priority."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    days = orders.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("order_day")).agg(
        F.count("*").alias("orders"), F.max("o_totalprice").alias("largest")
    )
    return windows.trailing(
        days,
        "o_orderpriority",
        "order_day",
        {"orders_7": ("orders", 7), "largest_28": ("largest", 28)},
        {"orders_prev": ("orders", 1)},
    )


def global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip numbered by duration, longest first."""
    minutes = elapsed("MINUTE", F.col("started_at"), F.col("ended_at"))
    trips = models(spark, sf_dir).stg_trips.select("ride_id", minutes.alias("minutes"))
    return ranking.number_all(trips, [F.desc("minutes"), F.asc("ride_id")], "duration_rank")


def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.date_spine(models(spark, sf_dir).date_bounds)


def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per day after the watermark of a table loaded up to the cutoff, less one day."""
    trips = models(spark, sf_dir).stg_trips
    mark = incremental.watermark(trips.where(F.col("started_at") < F.lit(CUTOFF)), "started_at")
    fresh = incremental.newer_than(trips, "started_at", mark, dt.timedelta(days=1))
    return fresh.groupBy(F.to_date("started_at").alias("date_day")).agg(F.count("*").alias("trips"))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips at or before the watermark that an earlier load did not have, per day."""
    trips = models(spark, sf_dir).stg_trips
    number = F.substring("ride_id", 2, 18).cast("long")
    loaded = trips.where((F.col("started_at") < F.lit(CUTOFF)) & (number % 50 != 0))
    mark = incremental.watermark(loaded, "started_at")
    late = trips.where(F.col("started_at") <= F.lit(mark)).join(
        loaded.select("ride_id"), "ride_id", "left_anti"
    )
    return late.groupBy(F.to_date("started_at").alias("date_day")).agg(F.count("*").alias("late_trips"))


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip table after a merge that corrects trips, moves some to the next day and
    adds new days."""
    trips = models(spark, sf_dir).stg_trips
    number = F.substring("ride_id", 2, 18).cast("long")
    minutes = elapsed("MINUTE", F.col("started_at"), F.col("ended_at"))
    rows = trips.select("ride_id", F.to_date("started_at").alias("trip_day"), minutes.alias("minutes"), number.alias("n"))
    first = rows.where(F.col("trip_day") < F.lit(CUTOFF)).drop("n")
    path = stage_path(spark, "trip_table")
    layout.write_table(first, path, "trip_day", ["ride_id"])
    target = layout.read_table(spark, path, first)
    since = F.lit(CUTOFF - dt.timedelta(days=2))
    moved = F.when(F.col("n") % 40 == 0, F.date_add("trip_day", 1)).otherwise(F.col("trip_day"))
    changes = rows.where(F.col("trip_day") >= since).select(
        "ride_id", moved.alias("trip_day"), (F.col("minutes") + 1000).alias("minutes")
    )
    incremental.upsert(target, path, changes, ["ride_id"], "trip_day", cluster_by=["ride_id"])
    return layout.read_table(spark, path, first)


def full_refresh_equals_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station-day fact loaded up to the cutoff and then extended by the rest."""
    m = models(spark, sf_dir)
    supply = stage(m.int_station_weather_daily, "supply")
    asked = stage(m.int_trip_station_daily, "demand")
    before = F.col("date_day") < F.lit(CUTOFF)
    first = daily.station_daily_fact(supply.where(before), asked.where(before))
    path = stage_path(spark, "station_days")
    layout.write_table(first, path, "date_day", ["station_id"])
    stored = layout.read_table(spark, path, first)
    rest = daily.station_daily_fact_since(supply, asked, stored, F.lit(CUTOFF))
    incremental.upsert(stored, path, rest, ["station_id", "date_day"], "date_day", cluster_by=["station_id"])
    return layout.read_table(spark, path, first)


def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports per day after day partitions older than twenty days were dropped."""
    status = models(spark, sf_dir).stg_station_status
    dated = status.withColumn("reported_on", F.to_date("last_reported"))
    path = stage_path(spark, "status_days")
    layout.write_table(dated, path, "reported_on", ["station_id"])
    layout.expire_partitions(spark, path, "reported_on", NOW.date(), keep_days=20)
    kept = layout.read_table(spark, path, dated)
    return kept.groupBy("reported_on").agg(
        F.count("*").alias("reports"), F.sum("num_bikes_available").alias("bikes")
    )


def tumbling_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = models(spark, sf_dir).stg_station_status
    return status.groupBy("station_id", five_minute_start(F.col("last_reported")).alias("bucket_start")).agg(
        F.count("*").alias("reports"), F.avg("num_bikes_available").alias("avg_bikes")
    )


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).int_station_daily_metrics.select(
        "station_id", "date_day", "unique_5min_intervals", "time_coverage_ratio", "data_quality"
    )


def freshness_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).vw_station_operations_realtime.groupBy("data_freshness").agg(
        F.count("*").alias("stations"),
        F.max("minutes_since_last_report").alias("oldest_minutes"),
    )


def regex_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.regex_ids(models(spark, sf_dir).stg_station_status, "station_id", "^S[0-9]$")


QUERIES = {
    "dedupe_latest": dedupe_latest,
    "user_key_fallback": user_key_fallback,
    "late_dim_fallback": late_dim_fallback,
    "star_lookup": star_lookup,
    "scd2_apply": scd2_apply,
    "scd2_timestamp": scd2_timestamp,
    "scd2_deletes": scd2_deletes,
    "pit_join": pit_join,
    "salted_lookup": salted_lookup,
    "mode_value": mode_value,
    "duration_quantiles": duration_quantiles,
    "rolling_7d": rolling_7d,
    "rolling_28d": rolling_28d,
    "lags": lags,
    "order_rolling": order_rolling,
    "global_rank": global_rank,
    "date_spine": date_spine,
    "incremental_slice": incremental_slice,
    "late_rows": late_rows,
    "merge_upsert": merge_upsert,
    "full_refresh_equals_incremental": full_refresh_equals_incremental,
    "retention_filter": retention_filter,
    "tumbling_5min": tumbling_5min,
    "coverage": coverage,
    "freshness_class": freshness_class,
    "regex_ids": regex_ids,
}
