"""Model rules on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.operators.scd2 import first_snapshot
from ridelake.plans import daily, demand, dimensions, facts, staging, supply, views
from ridelake.schemas import STATION_STATUS, TRIPS, WEATHER, schema_differences

NOW = dt.datetime(2024, 1, 31, 12, 0, 0)


def trips(spark, *rides):
    """Rides as (id, start, end, from, to, rider); places follow the station number."""
    rows = [
        (
            ride,
            "electric_bike" if i % 2 else "classic_bike",
            start,
            end,
            a and f"Name {a}",
            a,
            b and f"Name {b}",
            b,
            40.7,
            -74.0,
            40.71,
            -73.99,
            rider,
        )
        for i, (ride, start, end, a, b, rider) in enumerate(rides)
    ]
    columns = [f.name for f in TRIPS]
    kinds = ["string"] * 8 + ["double"] * 4 + ["string"]
    return spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in zip(columns, kinds)))


GOOD = ("r1", "2024-01-15 08:30:00", "2024-01-15 08:45:00", "4485.1", "7522.02", "member")


def test_trip_staging_types_and_rejects(spark):
    raw = trips(
        spark,
        GOOD,
        ("r2", "2024-01-15 09:00:00", "2024-01-15 09:20:00", None, "2", None),
        ("same", "2024-01-15 09:00:00", "2024-01-15 09:00:00", "1", "2", "member"),
        ("back", "2024-01-15 09:00:00", "2024-01-15 08:00:00", "1", "2", "member"),
        (None, "2024-01-15 09:00:00", "2024-01-15 09:20:00", "1", "2", "member"),
        ("open", "2024-01-15 09:00:00", None, "1", "2", "member"),
    )
    staged = staging.stg_trips(raw)
    assert sorted(r.ride_id for r in staged.collect()) == ["r1", "r2"]
    assert schema_differences(staged, TRIPS) == []
    assert staged.where("ride_id = 'r1'").first().start_station_id == "4485.1"


def weather(spark, *days):
    """Days as dicts of columns; the rest is null."""
    rows = [tuple(d.get(f.name) for f in WEATHER) for d in days]
    kinds = {"date": "string", "timestamp": "string"}
    ddl = ", ".join(f"{f.name} {kinds.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in WEATHER)
    return spark.createDataFrame(rows, ddl)


def test_weather_staging_keeps_the_latest_load(spark):
    raw = weather(
        spark,
        {"weather_date": "2024-01-15", "temperature_mean": 1.0, "loaded_at": "2024-01-16 02:00:00"},
        {"weather_date": "2024-01-15", "temperature_mean": 2.0, "loaded_at": "2024-01-17 02:00:00"},
        {"weather_date": "2024-01-16", "temperature_mean": 3.0, "loaded_at": None},
        {"weather_date": None, "temperature_mean": 4.0, "loaded_at": "2024-01-17 02:00:00"},
    )
    staged = staging.stg_weather(raw)
    assert sorted(r.temperature_mean for r in staged.collect()) == [2.0, 3.0]
    assert schema_differences(staged, WEATHER) == []


STATUS_DEFAULT = {
    "station_id": "s",
    "num_bikes_available": 5,
    "num_ebikes_available": 5,
    "num_bikes_disabled": 0,
    "num_docks_available": 10,
    "num_docks_disabled": 0,
    "num_scooters_available": 0,
    "num_scooters_unavailable": 0,
    "is_installed": 1,
    "is_renting": 1,
    "is_returning": 1,
    "last_reported": "2024-01-15 10:00:00",
}


def status(spark, *reports):
    rows = [tuple({**STATUS_DEFAULT, **r}.get(f.name) for f in STATION_STATUS) for r in reports]
    kinds = {"boolean": "bigint", "timestamp": "string"}
    ddl = ", ".join(
        f"{f.name} {kinds.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in STATION_STATUS
    )
    return staging.stg_station_status(spark.createDataFrame(rows, ddl))


def test_status_staging_casts_flags_and_keeps_repeats(spark):
    staged = status(spark, {}, {}, {"is_renting": 0}, {"station_id": None}, {"last_reported": None})
    assert staged.count() == 3
    assert sorted(r.is_renting for r in staged.collect()) == [False, True, True]


@pytest.mark.parametrize(
    "report, state",
    [
        ({}, "operational"),
        ({"is_renting": 0, "is_returning": 0}, "out_of_service"),
        ({"is_renting": 0}, "not_renting"),
        ({"is_returning": 0}, "not_returning"),
        ({"num_bikes_available": 0, "num_ebikes_available": 0, "num_docks_available": 0}, "empty"),
        ({"num_docks_available": 0}, "full"),
    ],
)
def test_operational_status(spark, report, state):
    assert supply.station_metrics(status(spark, report)).first().operational_status == state


def test_metrics_with_null_or_no_capacity(spark):
    zero = {c: 0 for c in supply.COUNTERS}
    found = supply.station_metrics(
        status(spark, {"num_bikes_disabled": None, "station_id": "null"}, {**zero, "station_id": "zero"}, {"is_installed": 0})
    ).collect()
    by_id = {r.station_id: r for r in found}
    assert set(by_id) == {"null", "zero"}  # not installed: left out
    assert by_id["null"].total_capacity is None and by_id["null"].occupancy_ratio is None
    assert by_id["zero"].occupancy_ratio is None and by_id["zero"].ebike_ratio is None
    assert by_id["zero"].is_empty and by_id["zero"].is_full


def test_day_summary_modes_and_single_report(spark):
    reports = [{"num_docks_available": d, "last_reported": f"2024-01-15 10:{m:02d}:00"} for d, m in [(10, 0), (10, 1), (12, 5), (8, 11)]]
    reports.append({"station_id": "single"})
    found = {r.station_id: r for r in supply.station_daily(supply.station_metrics(status(spark, *reports))).collect()}
    assert found["s"].typical_capacity == 20
    assert (found["s"].min_capacity, found["s"].max_capacity) == (18, 22)
    assert found["s"].unique_5min_intervals == 3  # 10:00, 10:05, 10:10
    assert found["s"].total_observations == 4
    assert found["single"].occupancy_volatility is None
    assert found["single"].data_quality == "poor"


def test_weather_classes_of_missing_measures(spark):
    days = spark.sql("SELECT 's' AS station_id, date'2024-01-15' AS date_day UNION ALL SELECT 's', date'2024-01-16'")
    known = staging.stg_weather(
        weather(spark, {"weather_date": "2024-01-15", "weather_code": 3, "temperature_mean": 24.0, "precipitation_sum": 0.0, "wind_speed_max": 23.0, "loaded_at": "2024-01-16 00:00:00"})
    )
    found = {str(r.date_day): r for r in supply.with_weather(days, known).collect()}
    fine, none = found["2024-01-15"], found["2024-01-16"]
    assert (fine.weather_condition, fine.temperature_range, fine.precipitation_intensity) == ("partly_cloudy", "warm", "none")
    assert fine.is_ideal_biking_weather and not fine.is_poor_biking_weather and fine.is_snowing is None
    assert (none.weather_condition, none.temperature_range, none.precipitation_intensity) == ("unknown", "unknown", "heavy")
    assert none.weather_severity_score == 0 and none.is_ideal_biking_weather is False


def test_severity_is_capped(spark):
    features = supply.weather_features()
    row = spark.sql(
        "SELECT 1D AS precipitation_sum, 1D AS snowfall_sum, -5D AS temperature_mean, 50D AS wind_speed_max, 95L AS weather_code"
    ).select(features["weather_severity_score"].alias("s"), features["is_poor_biking_weather"].alias("p"))
    assert tuple(row.first()) == (85, True)


def test_demand_counts_both_ends_and_skips_street_trips(spark):
    found = {
        (r.station_id, str(r.date_day)): r
        for r in demand.demand_daily(
            staging.stg_trips(
                trips(
                    spark,
                    ("a", "2024-01-15 23:50:50", "2024-01-16 00:01:10", "1", "2", "member"),
                    ("b", "2024-01-15 08:00:00", "2024-01-15 08:30:00", "1", None, "casual"),
                    ("c", "2024-01-15 08:00:00", "2024-01-15 08:10:00", None, "1", None),
                )
            )
        ).collect()
    }
    assert set(found) == {("1", "2024-01-15"), ("2", "2024-01-16")}
    one = found["1", "2024-01-15"]
    assert (one.trips_started, one.trips_ended, one.net_trips) == (2, 1, 1)
    assert (one.min_trip_duration_minutes, one.max_trip_duration_minutes) == (10, 30)
    assert (one.night_trips_started, one.morning_rush_trips_started) == (1, 1)
    assert one.peak_start_hour == 8  # tie with 23: the lower hour
    assert one.member_pct_started == 0.5
    two = found["2", "2024-01-16"]
    assert two.avg_trip_duration_minutes is None and two.member_pct_started is None
    assert two.peak_start_hour is None and two.peak_end_hour == 0


def test_balance_score_edges(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES ('none', 0D, 5L), ('idle', 4D, 0L), ('unknown', NULL, 5L), ('busy', 1D, 50L),
        ('even', 4D, 4L) AS t(station_id, avg_bikes_available, trips_started)"""
    ).selectExpr("*", "date'2024-01-15' AS date_day", "0L AS trips_ended", "10L AS typical_capacity")
    scores = {r.station_id: r.supply_demand_balance_score for r in daily.with_balance(rows).collect()}
    assert scores == {"none": 100.0, "idle": -100.0, "unknown": None, "busy": 100.0, "even": 0.0}


def test_trend_classes(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES (13L, 10D), (12L, 10D), (11L, 10D), (10L, 10D), (8L, 10D), (7L, 10D), (0L, 0D), (5L, NULL)
        AS t(trips_started, avg_trips_started_7d)"""
    ).selectExpr("*", "1L AS trips_started_prev_day", "CAST(NULL AS BIGINT) AS trips_started_same_day_last_week")
    trend = [r.demand_trend for r in daily.with_trend(rows).collect()]
    assert trend == ["surge", "above_average", "stable", "stable", "below_average", "decline", "stable", "stable"]


# --- dimensions and facts ----------------------------------------------------------------------


def test_renamed_station_stays_one_row(spark):
    rides = trips(spark, GOOD, ("r2", "2024-01-16 08:00:00", "2024-01-16 09:00:00", "4485.1", "2", "member"))
    renamed = rides.withColumn(
        "start_station_name", F.when(F.col("ride_id") == "r2", "Other").otherwise(F.col("start_station_name"))
    )
    master = dimensions.station_master(staging.stg_trips(renamed), NOW)
    assert sorted(r.station_id for r in master.collect()) == ["2", "4485.1", "7522.02"]


def dimension(spark, rides):
    return dimensions.dim_station(first_snapshot(dimensions.station_master(rides, NOW), "station_id"), NOW)


def test_unknown_station_and_boroughs(spark):
    rows = dimension(spark, staging.stg_trips(trips(spark, GOOD))).collect()
    unknown = [r for r in rows if r.station_id == "-1"]
    assert len(unknown) == 1 and unknown[0].station_size == "unknown" and unknown[0].is_current
    places = spark.sql(
        "SELECT * FROM VALUES (40.81D, -73.9D), (40.8D, -73.9D), (40.66D, -73.9D), (40.65D, -74.1D), (40.6D, -73.9D), (NULL, -73.9D) AS p(a, b)"
    ).select(dimensions.borough(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in places.collect()] == ["Bronx", "Upper Manhattan", "Lower Manhattan", "Brooklyn", "Queens", "Unknown"]


def test_trip_fact_falls_back_and_never_fans_out(spark):
    rides = staging.stg_trips(
        trips(
            spark,
            GOOD,
            ("r2", "2024-01-15 09:00:00", "2024-01-15 10:01:00", "nowhere", None, None),
            ("r3", "2024-01-15 09:00:00", "2024-01-15 09:04:59", "4485.1", "4485.1", "guest"),
        )
    )
    stations = dimension(spark, rides.where("ride_id = 'r1'"))
    users = dimensions.dim_user_type(spark, NOW)
    found = {r.trip_id: r for r in facts.fct_trips(rides, stations, users, NOW).collect()}
    unknown = stations.where("station_id = '-1'").first().station_key
    assert set(found) == {"r1", "r2", "r3"}
    assert found["r2"].start_station_key == found["r2"].end_station_key == unknown
    assert found["r2"].user_type_key == found["r3"].user_type_key == 3
    assert (found["r1"].start_date_key, found["r1"].start_hour_key, found["r1"].user_type_key) == (20240115, 8, 2)
    assert found["r2"].is_long_trip and found["r2"].is_round_trip is None
    assert found["r3"].is_round_trip and found["r3"].is_short_trip and found["r3"].trip_duration_minutes == 4


def test_unmatched_stations_of_a_day_collapse(spark, sf_dir):
    from ridelake.queries.models import models

    m = models(spark, sf_dir)
    lost = m.int_station_daily_fact.join(m.dim_station.select("station_id"), "station_id", "left_anti")
    unknown = m.fct_station_day.where(F.col("station_key") == F.md5(F.lit("-1")))
    per_day = {str(r[0]): r[1] for r in lost.groupBy("date_day").agg(F.sum("trips_started")).collect()}
    assert {str(r.date_day): r.trips_started for r in unknown.collect()} == per_day
    assert unknown.groupBy("date_key").count().where("count > 1").count() == 0


def test_date_dimension_flags(spark):
    bounds = spark.sql("SELECT date'2024-02-27' AS min_date, date'2024-03-01' AS max_date")
    rows = {str(r.full_date): r for r in dimensions.dim_date(bounds, dt.date(2024, 2, 28), NOW).collect()}
    assert len(rows) == 4 + 365
    assert rows["2024-02-29"].is_month_end and not rows["2024-02-28"].is_month_end
    assert rows["2024-03-31"].is_quarter_end and rows["2024-04-01"].is_quarter_start
    assert rows["2024-12-31"].is_year_end and rows["2025-01-01"].is_year_start
    assert [rows[f"2024-{d}"].is_summer_vacation for d in ("06-14", "06-15", "08-31", "09-01")] == [False, True, True, False]
    assert rows["2024-03-02"].days_from_today == 3 and rows["2024-03-02"].is_weekend
    assert rows["2024-03-02"].date_key == 20240302 and rows["2024-03-02"].season == "Spring"


def test_empty_calendar(spark):
    bounds = spark.sql("SELECT CAST(NULL AS DATE) AS min_date, CAST(NULL AS DATE) AS max_date")
    assert dimensions.dim_date(bounds, dt.date(2024, 2, 28), NOW).count() == 0


def test_time_dimension(spark):
    rows = {r.hour: r for r in dimensions.dim_time(spark, NOW).collect()}
    assert [rows[h].hour_name for h in (0, 1, 12, 13)] == ["12:00 AM", "1:00 AM", "12:00 PM", "1:00 PM"]
    assert rows[6].time_bucket == "morning_rush" and not rows[6].is_rush_hour and rows[7].is_rush_hour
    assert [rows[h].shift for h in (5, 6, 14, 20)] == ["night", "morning", "afternoon", "evening"]


def test_realtime_view_keeps_unknown_stations_and_drops_old_reports(spark):
    metrics = supply.station_metrics(
        status(
            spark,
            {"station_id": "old", "last_reported": "2024-01-30 11:59:59"},
            {"station_id": "new", "last_reported": "2024-01-31 11:00:00"},
            {"station_id": "new", "last_reported": "2024-01-31 11:49:30", "num_docks_available": 0},
        )
    )
    rides = staging.stg_trips(trips(spark, GOOD))
    history = first_snapshot(dimensions.station_master(rides, NOW), "station_id")
    view = views.realtime_status(metrics, history, NOW).collect()
    assert len(view) == 1 and view[0].station_id is None
    assert (view[0].minutes_since_last_report, view[0].data_freshness) == (10, "Fresh")
    assert (view[0].availability_status, view[0].station_type, view[0].station_size) == ("Full", "Micro", "unknown")
