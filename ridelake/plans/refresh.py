"""Extend a written warehouse by what arrived since the last run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.calendar import date_key, utc
from ridelake.operators import incremental, scd2
from ridelake.operators.layout import partition_values, replace_table, write_table
from ridelake.operators.ranking import latest_per_key
from ridelake.plans import daily, dimensions, facts, staging, supply
from ridelake.plans.build import TABLES, Models
from ridelake.plans.demand import demand_daily
from ridelake.session import stage
from ridelake.sources.feeds import Feeds


def _swap(m: Models, name: str, rows: DataFrame, values: list) -> DataFrame:
    """Replace the partitions of the given values by ``rows``, which may be worked out from
    them; those without rows go."""
    _, partition_by, cluster_by = TABLES[name]
    write_table(rows, m.path(name), partition_by, cluster_by, drop=[str(v) for v in values])
    return m.reopen(name)


def _whole(m: Models, name: str, rows: DataFrame) -> DataFrame:
    replace_table(rows, m.path(name))
    return m.reopen(name)


def changed_days(arrived: Feeds) -> list[dt.date]:
    """Days that rows of any feed belong to; a trip to the days of both its ends. One
    value a day goes to the driver, so that scans below prune by literals."""
    trips = staging.stg_trips(arrived.trips)
    dated = [
        trips.select(F.explode(F.array(F.to_date("started_at"), F.to_date("ended_at"))).alias("day")),
        staging.stg_station_status(arrived.status).select(F.to_date("last_reported").alias("day")),
        arrived.weather.select(F.to_date("weather_date").alias("day")).where("day IS NOT NULL"),
    ]
    days = dated[0].unionByName(dated[1]).unionByName(dated[2]).distinct()
    return sorted(row[0] for row in days.collect())


def _on(days: list[dt.date], column: Column) -> Column:
    return column.isin(days)


def _in_months(months: list[str], day_key: Column) -> Column:
    """Whether a day's number (yyyyMMdd) lies in one of the months (yyyy-MM)."""
    return F.floor(day_key / 100).isin([int(month.replace("-", "")) for month in months])


def _add_stations(m: Models, fresh: DataFrame, reloaded: list[str]) -> None:
    """Count the stations of new trips, anew for months that were loaded again, and bring the
    station dimension up to date."""
    counts = stage(dimensions.station_counts(fresh), "station-counts")
    months = [r[0] for r in counts.select("month").distinct().collect()]  # one per month
    stored = m.station_counts.where(F.col("month").isin(sorted(set(months) - set(reloaded))))
    write_table(dimensions.merged_counts(stored, counts), m.path("station_counts"), "month", ["station_id"], drop=reloaded)
    master = dimensions.master_of(m.reopen("station_counts"), m.now)
    history = scd2.apply_snapshot(
        m.snap_station, master, "station_id", dimensions.TRACKED, utc(m.now), tolerance=dimensions.MOVED
    )
    _whole(m, "dim_station", dimensions.dim_station(_whole(m, "snap_station", history), m.now))


def _replaced(m: Models, fresh: DataFrame, reloaded: list[str], days: list[int]) -> DataFrame:
    """(trip_key, start_date_key, end_date_key) of the stored trips that give way: all of the
    months loaded again, and those that came anew, on the days they start on."""
    keys = fresh.select(facts.trip_key().alias("trip_key"))
    stored = m.fct_trips.select("trip_key", "start_date_key", "end_date_key")
    again, other = _in_months(reloaded, F.col("start_date_key")), F.col("start_date_key").isin(days)
    return stored.where(again).unionByName(stored.where(~again & other).join(keys, "trip_key", "left_semi"))


def _together(*steps: Callable[[], None]) -> None:
    """Run steps that do not need each other, so that their jobs share the executors."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for job in [pool.submit(step) for step in steps]:
            job.result()


def _as_day(key: int) -> dt.date:
    return dt.date(key // 10000, key // 100 % 100, key % 100)


def refresh(
    spark: SparkSession, feeds: Feeds, arrived: Feeds, now: dt.datetime, root: str, reloaded: list[str] = ()
) -> Models:
    """Bring the tables under ``root`` up to ``feeds``, and open them.

    ``arrived`` holds the rows of ``feeds`` that came since the last run, of whatever age:
    the slice is by load, not by time of the event, so feeds may lag behind each other and
    old months may be filled in. The months of trips in ``reloaded`` (yyyy-MM) were loaded
    again: ``arrived`` holds all their trips, and what they held before is taken out, trips
    that the new load lacks included. Other arrived trips are merged by key into the days
    they start on.

    Measures of the days that arrived or replaced rows belong to are worked out again from
    all rows of those days; trends are where their frames reach such a day. Every stored
    table is brought up to date, by partitions of those days. The result is that of a full
    build.

    Stations are snapshotted by change: facts keep the version valid when they happened,
    and the dimension keeps all versions.
    """
    m, reloaded = Models.opened(spark, feeds, now, root), sorted(set(reloaded))
    fresh = staging.stg_trips(arrived.trips)
    starts = [r[0] for r in fresh.select(date_key(F.to_date("started_at"))).distinct().collect()]  # one per day
    replaced = _replaced(m, fresh, reloaded, starts)
    old = replaced.select(F.explode(F.array("start_date_key", "end_date_key"))).distinct().collect()  # one per day
    days = sorted({*changed_days(arrived), *(_as_day(r[0]) for r in old)})

    def trips() -> None:
        _add_stations(m, fresh, reloaded)
        loaded = facts.fct_trips(fresh, m.dim_station, m.dim_user_type, now)
        loaded = stage(latest_per_key(loaded, ["trip_key"], facts.first_trip(loaded)), "loaded-trips")
        kept = m.fct_trips.where(F.col("start_date_key").isin(starts) & ~_in_months(reloaded, F.col("start_date_key")))
        emptied = [v for v in partition_values(spark, m.path("fct_trips"), "start_date_key") if f"{v[:4]}-{v[4:6]}" in reloaded]
        _swap(m, "fct_trips", incremental.merged(kept, loaded, ["trip_key"]), emptied)

    def supplied() -> None:
        reports = m.stg_station_status.where(_on(days, F.to_date("last_reported")))
        rows = supply.station_daily(supply.station_metrics(reports)).where(_on(days, F.col("date_day")))
        table = _swap(m, "int_station_daily_metrics", rows, days).where(_on(days, F.col("date_day")))
        _swap(m, "int_station_weather_daily", supply.with_weather(table, m.weather_days), days)

    def demanded() -> None:
        rides = m.stg_trips.where(_on(days, F.to_date("started_at")) | _on(days, F.to_date("ended_at")))
        _swap(m, "int_trip_station_daily", demand_daily(rides).where(_on(days, F.col("date_day"))), days)

    rewritten: list[dt.date] = []

    def measured() -> None:
        _together(supplied, demanded)
        changed = _on(days, F.col("date_day"))
        rows, reached = daily.station_daily_fact_around(
            m.int_station_weather_daily.where(changed), m.int_trip_station_daily.where(changed), m.int_station_daily_fact, days
        )
        _swap(m, "int_station_daily_fact", rows, reached)
        rewritten.extend(reached)

    _together(*([trips, measured] if days else [trips]))
    if days:

        def station_days() -> None:
            recent = m.int_station_daily_fact.where(_on(rewritten, F.col("date_day")))
            _swap(m, "fct_station_day", facts.fct_station_day(recent, m.dim_station, now), rewritten)

        def dates() -> None:
            held = partition_values(spark, m.path("int_station_daily_fact"), "date_day")
            span = {"min_date": min(held, default=None), "max_date": max(held, default=None)}
            bounds = spark.range(1).select(*[F.lit(day).cast("date").alias(name) for name, day in span.items()])
            _whole(m, "dim_date", dimensions.dim_date(bounds, now.date(), now))

        _together(station_days, dates)
    return m
