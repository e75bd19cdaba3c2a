"""The models, each as one lazy plan over the raw feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake import rules
from ridelake.plans import daily
from ridelake.plans.build import Models
from ridelake.sources.feeds import NOW, event_feeds


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(spark, event_feeds(spark, sf_dir), NOW)


def _model(table: str):
    return lambda spark, sf_dir: models(spark, sf_dir).table(table)


def station_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current attributes of the snapshot."""
    snapshot = models(spark, sf_dir).snap_station
    return snapshot.drop("version_id", "version_updated_at", "valid_from", "valid_to")


def supply_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return daily.supply_demand(m.int_station_weather_daily, m.int_trip_station_daily)


def dim_time_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time dimension with the trips that start in each hour."""
    m = models(spark, sf_dir)
    starts = m.stg_trips.groupBy(F.hour("started_at").cast("long").alias("time_key")).agg(
        F.count("*").alias("trips")
    )
    hours = m.dim_time.join(starts, "time_key", "left")
    return hours.withColumn("trips", F.coalesce("trips", F.lit(0).cast("long")))


def dim_user_type_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user types with the trips of each."""
    m = models(spark, sf_dir)
    riders = m.stg_trips.groupBy(
        F.coalesce("member_casual", F.lit("unknown")).alias("user_type_id")
    ).agg(F.count("*").alias("trips"))
    kinds = m.dim_user_type.drop("updated_at").join(riders, "user_type_id", "left")
    return kinds.withColumn("trips", F.coalesce("trips", F.lit(0).cast("long")))


def _furnished(spark: SparkSession, sf_dir: str) -> Models:
    """Models whose stations have a capacity and a region, which trips do not carry."""
    m = models(spark, sf_dir)
    n = F.regexp_extract("station_id", "[0-9]+", 0).cast("long")
    texts = [f"{name} and around" for name in rules.LIVE_BOROUGHS] + ["Hoboken"]
    region = F.element_at(F.array(*map(F.lit, texts)), (n % len(texts) + 1).cast("int"))
    m.__dict__["snap_station"] = m.snap_station.withColumns(
        {"capacity": F.when(n % 8 != 0, n * 3 - 10), "region": F.when(n % 9 != 0, region)}
    )
    return m


def realtime_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Borough by region text, and both capacity ladders, of stations that report."""
    view = _furnished(spark, sf_dir).vw_station_operations_realtime
    return view.select("station_id", "capacity", "region", "borough", "station_type", "station_size")


def station_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _furnished(spark, sf_dir).dim_station.select("station_id", "capacity", "region", "station_size")


QUERIES = {
    "stg_trips": _model("stg_trips"),
    "stg_weather": lambda spark, sf_dir: models(spark, sf_dir).stg_weather.withColumnRenamed(
        "loaded_at", "latest_load"
    ),
    "stg_station_status": _model("stg_station_status"),
    "station_metrics": _model("int_station_metrics"),
    "station_daily": _model("int_station_daily_metrics"),
    "demand_daily": _model("int_trip_station_daily"),
    "weather_enrich": _model("int_station_weather_daily"),
    "supply_demand": supply_demand,
    "station_daily_fact": _model("int_station_daily_fact"),
    "station_master": station_master,
    "dim_station": _model("dim_station"),
    "dim_date": _model("dim_date"),
    "dim_time_usage": dim_time_usage,
    "dim_user_type_usage": dim_user_type_usage,
    "fct_trips": _model("fct_trips"),
    "fct_station_day": _model("fct_station_day"),
    "station_operations": _model("vw_station_operations"),
    "realtime_places": realtime_places,
    "station_sizes": station_sizes,
    "realtime_status": _model("vw_station_operations_realtime"),
    "trip_analytics_daily": _model("vw_trip_analytics_daily"),
    "routes": _model("vw_trip_analytics_routes"),
    "weather_impact": _model("vw_weather_impact"),
}
