"""Quality checks, monitoring, analyst questions and charts, over the written layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.plans import analyst, monitor, quality
from ridelake.plans.build import Models
from ridelake.queries.ingest import warehouse
from ridelake.queries.models import models
from ridelake.sources.feeds import AS_OF, NOW, event_feeds

# Types the published tables must have; an id such as "4485.1" must stay text.
DECLARED = {
    "int_station_metrics": {"station_id": "string"},
    "int_station_daily_metrics": {"station_id": "string"},
    "int_trip_station_daily": {"station_id": "string"},
    "int_station_weather_daily": {"station_id": "string"},
    "int_station_daily_fact": {"station_id": "string", "date_day": "date"},
    "dim_station": {"station_key": "string", "station_id": "string", "capacity": "bigint"},
    "dim_date": {"date_key": "bigint", "full_date": "date"},
    "fct_trips": {"trip_key": "string", "start_date_key": "bigint", "started_at": "timestamp"},
    "fct_station_day": {"station_key": "string", "date_key": "bigint", "trips_started": "bigint"},
}


def _over_tables(check):
    return lambda spark, sf_dir: check(warehouse(spark, sf_dir).table)


def _over_layers(report):
    return lambda spark, sf_dir: report(warehouse(spark, sf_dir))


def _over_feeds(report):
    return lambda spark, sf_dir: report(models(spark, sf_dir))


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns with the verdict on their type and the rows that depend on it."""
    tables = warehouse(spark, sf_dir).table
    verdicts = quality.schema_check(spark, tables, DECLARED)
    counts = None
    for name in DECLARED:
        rows = tables(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        counts = rows if counts is None else counts.unionByName(rows)
    return verdicts.join(counts, "table_name")


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = event_feeds(spark, sf_dir)
    return monitor.source_freshness(
        {
            "trips": (feeds.trips, "started_at"),
            "weather": (feeds.weather, "loaded_at"),
            "station_status": (feeds.status, "ingestion_timestamp"),
        },
        NOW + dt.timedelta(hours=30),
    )


def trip_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = warehouse(spark, sf_dir)
    return monitor.trip_span(built.feeds.trips, built.fct_trips)


def weather_effect(m: Models) -> DataFrame:
    return analyst.weather_effect(m.fct_station_day, m.dim_date, AS_OF.year, [1])


def filtered_trips(m: Models) -> DataFrame:
    """Daily-trips charts under the dashboard controls: two weeks, members, weekdays."""
    view = analyst.filtered(
        m.vw_trip_analytics_daily,
        first=dt.date(2024, 1, 8),
        last=dt.date(2024, 1, 21),
        equal={"user_type_name": "Member", "is_weekend": False},
        between={"hour_of_day": (7, 19)},
    )
    return analyst.scorecards(view)


QUERIES = {
    # quality
    "dup_keys": _over_tables(quality.duplicate_keys),
    "layer_counts": _over_tables(quality.layer_counts),
    "fk_orphans": _over_tables(quality.fk_orphans),
    "dim_checks": _over_tables(quality.dimension_checks),
    "null_keys": _over_tables(quality.null_keys),
    "dq_not_null": _over_tables(quality.not_null),
    "dq_unique": _over_tables(quality.unique),
    "dq_accepted": _over_tables(quality.accepted_values),
    "dq_relationships": _over_tables(quality.relationships),
    "dq_expression": _over_tables(quality.expression_is_true),
    "dq_unique_combo": _over_tables(quality.unique_together),
    "dq_report": _over_tables(quality.summary),
    "schema_check": schema_check,
    # monitoring
    "source_freshness": source_freshness,
    "stream_health": _over_feeds(lambda m: monitor.stream_health(m.stg_station_status, NOW)),
    "active_entities": _over_feeds(lambda m: monitor.active_entities(m.stg_station_status, NOW)),
    "stale_entities": _over_feeds(lambda m: monitor.stale_entities(m.stg_station_status, NOW)),
    "weather_age": _over_feeds(lambda m: monitor.weather_age(m.feeds.weather, AS_OF)),
    "trip_span": trip_span,
    "recent_reports": _over_feeds(lambda m: monitor.recent_reports(m.stg_station_status, "S7")),
    # analysts
    "daily_trend": _over_layers(lambda m: analyst.daily_trend(m.fct_trips, m.dim_date, 2024, 1)),
    "topk_entities": _over_layers(
        lambda m: analyst.busiest_stations(
            m.fct_station_day, m.dim_station, m.dim_date, AS_OF - dt.timedelta(days=1)
        )
    ),
    "hourly_pattern": _over_layers(
        lambda m: analyst.hourly_pattern(m.fct_trips, m.dim_date, m.dim_time, m.dim_user_type, 2024)
    ),
    "weather_effect": _over_layers(weather_effect),
    "duration_sanity": _over_layers(lambda m: analyst.duration_sanity(m.fct_trips)),
    # charts
    "scorecards": _over_layers(lambda m: analyst.scorecards(m.vw_trip_analytics_daily)),
    "filtered_trips": _over_layers(filtered_trips),
    "chart_breakdowns": _over_layers(lambda m: analyst.chart_breakdowns(m.vw_trip_analytics_daily)),
    "hourly_table": _over_layers(lambda m: analyst.hourly_table(m.vw_trip_analytics_daily)),
    "route_scorecards": _over_layers(lambda m: analyst.route_scorecards(m.vw_trip_analytics_routes)),
    "top_routes": _over_layers(lambda m: analyst.top_routes(m.vw_trip_analytics_routes)),
    "top_start": _over_layers(lambda m: analyst.top_stations(m.vw_trip_analytics_routes, "start")),
    "top_end": _over_layers(lambda m: analyst.top_stations(m.vw_trip_analytics_routes, "end")),
    "station_map": _over_layers(lambda m: analyst.station_map(m.vw_trip_analytics_routes, "start")),
    "station_map_end": _over_layers(lambda m: analyst.station_map(m.vw_trip_analytics_routes, "end")),
    "weather_scorecards": _over_layers(lambda m: analyst.weather_scorecards(m.vw_weather_impact)),
    "trend_line": _over_layers(lambda m: analyst.trend_line(m.vw_weather_impact)),
    "weather_breakdown": _over_layers(lambda m: analyst.weather_breakdown(m.vw_weather_impact)),
    "weather_table": _over_layers(lambda m: analyst.weather_table(m.vw_weather_impact)),
}
