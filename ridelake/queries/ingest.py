"""Feeds written in their landing form and read back by the ingestion jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.calendar import utc
from ridelake.operators import layout
from ridelake.plans import build, monitor
from ridelake.plans.build import TABLES, Models
from ridelake.plans.refresh import refresh
from ridelake.plans.supply import COUNTERS
from ridelake.schemas import TRIPS
from ridelake.session import stage, stage_path
from ridelake.sources import status, trips, weather
from ridelake.sources.feeds import NOW, NUMBERED_STATUS_SQL, Feeds, event_feeds, events

STATIONS_PER_POLL = 32
LINES_A_FILE = 1_000_000
CUTOFF = dt.date(2024, 1, 20)
# Early enough for most trips of the month to give a station its new name.
RENAMED = dt.date(2024, 1, 10)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Trips as CSV files, landed as month-partitioned Parquet."""
    raw = event_feeds(spark, sf_dir).trips
    csv, landing = stage_path(spark, "trip_csv"), stage_path(spark, "trip_landing")
    raw.write.option("header", True).option("timestampNTZFormat", trips.TIMESTAMP_FORMAT).csv(csv)
    trips.land_trips(trips.read_trip_csv(spark, csv), landing)
    return landing


def _all_months(spark: SparkSession, landing: str) -> list[str]:
    years = layout.partition_values(spark, landing, "year")
    return [f"{y}-{m}" for y in years for m in layout.partition_values(spark, f"{landing}/year={y}", "month")]


def land_trips_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _landed(spark, sf_dir)
    return trips.read_months(spark, landing, _all_months(spark, landing)).drop("source")


def land_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed a second time replace what they brought the first time."""
    csv, landing = stage_path(spark, "trip_csv"), stage_path(spark, "trip_landing")
    raw = event_feeds(spark, sf_dir).trips
    raw.write.option("header", True).option("timestampNTZFormat", trips.TIMESTAMP_FORMAT).csv(csv)
    for _ in range(2):
        trips.land_trips(trips.read_trip_csv(spark, csv), landing)
    return trips.read_months(spark, landing, _all_months(spark, landing)).drop("source")


def _write_lines(lines: DataFrame, header: str, path: str, lines_a_file: int = LINES_A_FILE) -> None:
    """Lines (day, value) as text files that each begin with the header. A file holds a day,
    or a bucket of one where there are many lines; lines are streamed out, none gathered."""
    buckets = 1 + lines.count() // lines_a_file
    cut = lines.select("day", F.pmod(F.xxhash64("value"), F.lit(buckets)).alias("bucket"), F.lit(1).alias("place"), "value")
    heads = cut.select("day", "bucket").distinct().select("day", "bucket", F.lit(0).alias("place"), F.lit(header).alias("value"))
    rows = cut.unionByName(heads).repartition("day", "bucket").sortWithinPartitions("day", "bucket", "place")
    rows.select("day", "bucket", "value").write.partitionBy("day", "bucket").option("lineSep", "\n").text(path)


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines read, kept and rejected, by reason. Of the trips, every 50th has a broken time,
    every 70th a field too few, every 90th no id, and every third no milliseconds."""
    path = stage_path(spark, "trip_csv")
    n = F.regexp_extract("ride_id", "[0-9]+", 0).cast("long")
    at = F.date_format("started_at", "yyyy-MM-dd HH:mm:ss")
    start = F.when(n % 50 == 0, F.lit("yesterday")).when(n % 3 == 0, at).otherwise(F.concat(at, F.lit(".250")))
    end = F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss.SSS")
    ride = F.when(n % 90 == 0, F.lit("")).otherwise(F.col("ride_id"))
    head = F.concat_ws(",", ride, "rideable_type", start, end, F.lit("A,1,B,2,40.7,-74.0,40.8,-74.1"))
    line = F.when(n % 70 == 0, head).otherwise(F.concat(head, F.lit(",member")))
    header = ",".join(f.name for f in TRIPS)
    _write_lines(event_feeds(spark, sf_dir).trips.select(F.to_date("started_at").alias("day"), line.alias("value")), header, path)
    kept = trips.read_trip_csv(spark, path).select(F.lit("kept").alias("outcome"))
    rejected = trips.trip_csv_rejects(spark, path).select(F.col("reason").alias("outcome"))
    return kept.unionByName(rejected).groupBy("outcome").agg(F.count("*").alias("n_lines"))


def load_added_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that the files of a later month add, loaded with its month."""
    landing, raw = stage_path(spark, "order_landing"), stage_path(spark, "order_raw")
    rides = _order_rides(spark, sf_dir)
    early = F.col("started_at") < "1996-01-01"
    trips.land_trips(rides.where(early).drop("priority"), landing)
    trips.land_trips(rides.where(~early), landing)
    trips.load_months(spark, landing, raw, ["1995-01"])
    for _ in range(2):  # the second load replaces the first
        trips.load_months(spark, landing, raw, ["1996-06"])
    loaded = trips.read_raw(spark, raw)
    return loaded.groupBy("started_month").agg(F.count("*").alias("trips"), F.count("priority").alias("priorities"))


def load_trips_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw trips table after one month was appended."""
    landing, raw = _landed(spark, sf_dir), stage_path(spark, "trips_raw")
    trips.load_months(spark, landing, raw, ["2024-01"])
    return trips.read_raw(spark, raw)


def backfill_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stand-in for many months: trips per month of a backfill of three.

    The events span one month, so each order becomes a trip start on its order day.
    """
    rides = _order_rides(spark, sf_dir).drop("priority")
    landing, raw = stage_path(spark, "order_landing"), stage_path(spark, "order_raw")
    trips.land_trips(rides, landing)
    trips.load_months(spark, landing, raw, ["1995-01", "1996-06", "2001-07"])
    return trips.read_raw(spark, raw).groupBy("started_month").agg(
        F.count("*").alias("trips"), F.min("started_at").alias("first_start")
    )


def _order_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    start = F.col("o_orderdate").cast("timestamp")
    none, place = F.lit(None).cast("string"), F.lit(None).cast("double")
    return orders.select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("ride_id"),
        F.lit("classic_bike").alias("rideable_type"),
        start.alias("started_at"),
        (start + F.expr("interval 10 minutes")).alias("ended_at"),
        *[none.alias(c) for c in ("start_station_name", "start_station_id", "end_station_name", "end_station_id")],
        *[place.alias(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")],
        F.lit("member").alias("member_casual"),
        F.col("o_orderkey").cast("string").alias("priority"),
    )


def _weather_responses(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """Weather rows as service responses of up to eight days; every fifth lacks rain_sum."""
    source = events(spark, sf_dir)
    rows = spark.sql(
        """
        SELECT event_id DIV 8 AS response, event_id,
          date_format(ts, 'yyyy-MM-dd') AS time,
          cast(event_id % 40 AS DOUBLE) AS hi, cast(event_id % 45 AS DOUBLE) AS wind,
          cast(event_id % 50 AS DOUBLE) / 100 AS rain, event_id % 8 AS code
        FROM {events}
        """,
        events=source,
    )
    day = F.sort_array(F.collect_list(F.struct("event_id", "time", "hi", "wind", "rain", "code")))
    # At most eight rows per response, by the key.
    days = rows.groupBy("response").agg(day.alias("d"))

    def array(field: str, shift: float = 0.0) -> Column:
        return F.transform("d", lambda x: x[field] + shift) if shift else F.col(f"d.{field}")

    rain_sum = F.when(F.col("response") % 5 != 0, F.col("d.rain"))
    daily = F.struct(
        F.col("d.time").alias("time"),
        array("hi").alias("temperature_2m_max"),
        array("hi", -10).alias("temperature_2m_min"),
        array("hi", -5).alias("temperature_2m_mean"),
        array("rain").alias("precipitation_sum"),
        rain_sum.alias("rain_sum"),
        array("code").alias("weather_code"),
        array("wind").alias("wind_speed_10m_max"),
        array("wind", 10).alias("wind_gusts_10m_max"),
    )
    return days.select(*(["response"] if numbered else []), F.to_json(F.struct(daily.alias("daily"))).alias("body"))


def weather_json_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = weather.parse_weather(_weather_responses(spark, sf_dir), "body", NOW)
    path = stage_path(spark, "weather_raw")
    weather.append_weather(parsed, path)
    return layout.read_table(spark, path, parsed)


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status reports as polls of up to 32 stations, with defects: report times that are
    missing, 0 or from 1970, missing counters, flags and ids."""
    reports = spark.sql(NUMBERED_STATUS_SQL, events=events(spark, sf_dir))
    n, epoch = F.col("event_id"), F.unix_seconds(F.col("last_reported").cast("timestamp"))
    reported = F.when(n % 97 == 6, 0).when(n % 97 == 7, 86400).when(n % 97 != 5, epoch)
    counters = [c for c in COUNTERS if c != "num_docks_disabled"]
    station = F.struct(
        "station_id",
        F.when(n % 7 != 0, F.col("legacy_id")).alias("legacy_id"),
        *counters,
        F.when(n % 6 != 1, F.col("num_docks_disabled")).alias("num_docks_disabled"),
        *status.FLAGS,
        F.when(n % 10 != 3, F.struct(F.col("eightd_has_available_keys").alias("has_available_keys"))).alias("eightd"),
        reported.alias("last_reported"),
    )
    # At most 32 rows per poll, by the key.
    grouped = reports.groupBy(F.floor(n / STATIONS_PER_POLL).alias("poll")).agg(
        F.max(epoch).alias("last_updated"), F.collect_list(station).alias("stations")
    )
    body = F.to_json(F.struct("last_updated", F.struct("stations").alias("data")))
    return grouped.select("poll", F.to_date(F.timestamp_seconds("last_updated")).alias("day"), body.alias("value"))


def parsed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.parse_stations(polls(spark, sf_dir), "value", utc(NOW))


def status_json_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.accepted(parsed_polls(spark, sf_dir))


def status_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = status.rejected(parsed_polls(spark, sf_dir))
    return rejects.groupBy("station_id", "timestamp").agg(F.count("*").alias("rejects"))


def broken_polls(rows: DataFrame) -> DataFrame:
    """Polls of which every tenth is cut off and every eleventh has no stations."""
    n = F.col("poll")
    broken = F.when(n % 10 == 3, F.expr("substring(value, 1, length(value) div 2)")).when(n % 11 == 4, '{"last_updated": 1}')
    return rows.withColumn("value", F.coalesce(broken, F.col("value")))


def poll_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls that give rows, and those that do not, by reason. Every tenth poll is cut off,
    every eleventh has no stations."""
    rows = broken_polls(polls(spark, sf_dir))
    bad = status.rejected_polls(rows, "value").select(F.col("reason").alias("outcome"))
    good = status.parse_stations(rows, "value", utc(NOW), ["poll"]).select("poll").distinct().select(F.lit("read").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("n_polls"))


def weather_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days read, and responses and days that are not, by reason. Every tenth response is cut
    off, every eleventh is an error message, and of every seventh a date is wrong."""
    body = F.col("body")
    rows = _weather_responses(spark, sf_dir, numbered=True)
    n = F.col("response")
    broken = F.when(n % 10 == 3, F.expr("substring(body, 1, length(body) div 2)")).when(n % 11 == 4, '{"error": true}')
    wrong = F.when(n % 7 == 2, F.regexp_replace(body, '"time":\\["[0-9-]+"', '"time":["some day"'))
    rows = rows.withColumn("body", F.coalesce(broken, wrong, body))
    good = weather.parse_weather(rows, "body", NOW).select(F.lit("read").alias("outcome"))
    bad = weather.weather_rejects(rows, "body").select(F.col("reason").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("n"))


def status_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.to_messages(status.accepted(parsed_polls(spark, sf_dir)))


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics taken while the parse was written, as one row."""
    observed, metrics = monitor.observed_parse(polls(spark, sf_dir), "value", utc(NOW))
    written = stage(observed, "parsed")
    counts = metrics.get
    outcome = "success" if counts["published"] else "failed"
    # The observed numbers next to those of the stored table.
    return monitor.ingest_metrics(written).select(
        *[F.lit(counts[c]).cast("long").alias(f"observed_{c}") for c in ("fetched", "published", "skipped")],
        "fetched",
        "published",
        "skipped",
        F.when(F.col("status") == outcome, F.col("status")).alias("status"),
    )


def ingest_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of two runs: one over all polls, one over reports that all are unusable."""
    rows = polls(spark, sf_dir)
    useless = rows.withColumn("value", F.regexp_replace("value", '"last_reported":[0-9]+', '"last_reported":7'))
    runs = {"all": rows, "useless": useless}
    report = None
    for run_id, source in runs.items():
        path = stage_path(spark, "reports")
        row = monitor.run_report(spark, run_id, lambda: monitor.ingest_polls(source, "value", utc(NOW), path))
        report = row if report is None else report.unionByName(row)
    timed = (F.col("ended_at") >= F.col("started_at")) & (F.col("duration_seconds") >= 0)
    return report.select("run_id", timed.alias("timed"), "fetched", "published", "skipped", "status", "error")


def backfill_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather of the days to the 20th, of which those from the 10th on were filled in later,
    twice."""
    parsed = weather.parse_weather(_weather_responses(spark, sf_dir), "body", NOW)
    path, tenth = stage_path(spark, "weather_raw"), dt.date(2024, 1, 10)
    weather.append_weather(parsed.where(F.col("weather_date") < F.lit(tenth)), path)
    for _ in range(2):
        weather.load_weather_range(parsed, path, tenth, CUTOFF)
    return layout.read_table(spark, path, parsed)


_WAREHOUSES: dict[tuple[str, str], Models] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Models:
    """All layers written once per session and input; reports read these tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        root = stage_path(spark, "warehouse")
        _WAREHOUSES[key] = Models(spark, event_feeds(spark, sf_dir), NOW, root).build()
    return _WAREHOUSES[key]


def run_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table of a full build."""
    built = warehouse(spark, sf_dir)
    counts = None
    for name, (layer, _, _) in TABLES.items():
        row = built.table(name).agg(F.count("*").alias("n")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n"
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts


def _refreshed(spark: SparkSession, sf_dir: str, name: str, late: dict[str, Column], first_run: dt.datetime = NOW, feeds: Feeds | None = None) -> Models:
    """A warehouse built without the ``late`` rows of each feed, then refreshed with them;
    once per session, input and name, like ``warehouse``."""
    cached = (spark.sparkContext.applicationId, f"{sf_dir}, {name}")
    if cached not in _WAREHOUSES:
        feeds = feeds or event_feeds(spark, sf_dir)
        tables = {"trips": feeds.trips, "weather": feeds.weather, "status": feeds.status}
        none = F.lit(False)
        early = Feeds(**{k: t.where(~late.get(k, none)) for k, t in tables.items()})
        arrived = Feeds(**{k: t.where(late.get(k, none)) for k, t in tables.items()})
        root = stage_path(spark, "refreshed")
        Models(spark, early, first_run, root).build()
        _WAREHOUSES[cached] = refresh(spark, feeds, arrived, NOW, root)
    return _WAREHOUSES[cached]


def _in_step(spark: SparkSession, sf_dir: str) -> Models:
    """All feeds end at the cutoff in the first run."""
    late = {"trips": F.col("started_at") >= F.lit(CUTOFF), "status": F.col("last_reported") >= F.lit(CUTOFF)}
    return _refreshed(spark, sf_dir, "in step", late, dt.datetime.combine(CUTOFF, dt.time()))


def refresh_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip fact after an incremental run; station keys stay those of the first run."""
    return _in_step(spark, sf_dir).fct_trips


def refresh_station_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station-day fact after an incremental run."""
    return _in_step(spark, sf_dir).fct_station_day


def refresh_lagging_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-days where status was current and the trips of twenty days came later."""
    late = {"trips": F.col("started_at") >= F.lit(NOW.date() - dt.timedelta(days=20))}
    return _refreshed(spark, sf_dir, "lagging trips", late).fct_station_day


def _backfilled(spark: SparkSession, sf_dir: str) -> Models:
    return _refreshed(spark, sf_dir, "backfill", {"trips": F.col("started_at") < F.lit(CUTOFF)})


def refresh_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips where the older ones were filled in after the newer ones."""
    return _backfilled(spark, sf_dir).fct_trips


def refresh_backfill_station_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfilled(spark, sf_dir).fct_station_day


def refresh_late_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-days where the weather of every other day came later."""
    late = {"weather": F.dayofmonth("weather_date") % 2 == 0}
    return _refreshed(spark, sf_dir, "late weather", late).fct_station_day


def _reloaded(spark: SparkSession, sf_dir: str) -> Models:
    """A warehouse whose trips of January were loaded again: the first load had trips that the
    second lacks, lacked some, and had others on other days, at other stations and longer."""
    cached = (spark.sparkContext.applicationId, f"{sf_dir}, reloaded")
    if cached not in _WAREHOUSES:
        feeds = event_feeds(spark, sf_dir)
        n, start, end = F.regexp_extract("ride_id", "[0-9]+", 0).cast("long"), F.col("started_at"), F.col("ended_at")
        earlier = F.expr("make_interval(0, 0, 0, 2)")
        first = feeds.trips.where(n % 29 != 3).withColumns(
            {
                "started_at": F.when(n % 13 == 5, start - earlier).otherwise(start),
                "ended_at": F.when(n % 13 == 5, end - earlier).when(n % 17 == 2, end + earlier).otherwise(end),
                "end_station_id": F.when(n % 19 == 7, F.lit("S29")).otherwise(F.col("end_station_id")),
            }
        )
        gone = feeds.trips.where(n % 31 == 4).withColumn("ride_id", F.concat(F.lit("X"), "ride_id"))
        january = F.date_format("started_at", "yyyy-MM") == "2024-01"
        first = first.unionByName(gone).where(january)
        root = stage_path(spark, "reloaded")
        Models(spark, Feeds(first, feeds.weather, feeds.status), NOW, root).build()
        arrived = Feeds(feeds.trips, feeds.weather.limit(0), feeds.status.limit(0))
        _WAREHOUSES[cached] = refresh(spark, feeds, arrived, NOW, root, reloaded=["2024-01"])
    return _WAREHOUSES[cached]


def refresh_reloaded_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip fact after a month was loaded again, with trips removed, added and corrected."""
    return _reloaded(spark, sf_dir).fct_trips


def refresh_reloaded_station_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reloaded(spark, sf_dir).fct_station_day


def refresh_daily_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-days of the three daily tables after an incremental run, by day and table."""
    m, tables = _in_step(spark, sf_dir), None
    for name, measure in (("int_station_daily_metrics", "total_observations"), ("int_trip_station_daily", "trips_started"), ("int_station_weather_daily", "total_observations")):
        rows = m.table(name).select(F.lit(name).alias("table_name"), "station_id", "date_day", F.col(measure).cast("long").alias("measure"))
        tables = rows if tables is None else tables.unionByName(rows)
    return tables


def refresh_station_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supply table, whole, after an incremental run."""
    return _in_step(spark, sf_dir).int_station_daily_metrics


def refresh_demand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand table, whole, after a month was loaded again."""
    return _reloaded(spark, sf_dir).int_trip_station_daily


def refresh_weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supply table with weather after the weather of every other day came later."""
    late = {"weather": F.dayofmonth("weather_date") % 2 == 0}
    return _refreshed(spark, sf_dir, "late weather", late).int_station_weather_daily


def refresh_renamed_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the operations view per station, and facts without a dimension row, after
    a station got another name between two runs, which most of its trips came to give it."""
    feeds = event_feeds(spark, sf_dir)
    renamed = {
        f"{end}_station_name": F.when(
            (F.col(f"{end}_station_id") == "S7") & (F.col("started_at") >= F.lit(RENAMED)), F.lit("Corner of S7")
        ).otherwise(F.col(f"{end}_station_name"))
        for end in ("start", "end")
    }
    feeds = Feeds(trips=feeds.trips.withColumns(renamed), weather=feeds.weather, status=feeds.status)
    late = {"trips": F.col("started_at") >= F.lit(RENAMED), "status": F.col("last_reported") >= F.lit(RENAMED)}
    m = _refreshed(spark, sf_dir, "renamed", late, dt.datetime.combine(RENAMED, dt.time()), feeds)
    known = m.dim_station.select("station_key")
    ends = m.fct_trips.select(F.explode(F.array("start_station_key", "end_station_key")).alias("station_key"))
    orphans = ends.unionByName(m.fct_station_day.select("station_key")).join(known, "station_key", "left_anti")
    orphans = orphans.agg(F.count("*").alias("orphans"))
    versions = m.dim_station.groupBy("station_id").agg(F.count("*").alias("versions"))
    days = m.vw_station_operations.groupBy("station_id").agg(F.count("*").alias("days"))
    # One row of counts.
    return days.join(versions, "station_id").crossJoin(orphans)


def clustered_row_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and station keys of each day of the written trip fact, from the footers of its
    files, and how many row groups overlap the one before them."""
    groups = layout.row_groups(spark, warehouse(spark, sf_dir).path("fct_trips"), "start_station_key")
    return layout.overlapping(groups).withColumn("start_date_key", F.col("value").cast("long")).drop("value")


def materialize_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather view stored by day, after a refresh of its last ten days."""
    view = stage(warehouse(spark, sf_dir).vw_weather_impact, "view")
    path = stage_path(spark, "stored_view")
    build.materialize_view(view, path, "date_day", ["weather_category"])
    recent = view.where(F.col("date_day") > F.lit(NOW.date() - dt.timedelta(days=10)))
    build.materialize_view(recent, path, "date_day", ["weather_category"])
    return layout.read_table(spark, path, view)


QUERIES = {
    "land_trips_csv": land_trips_csv,
    "land_twice": land_twice,
    "csv_rejects": csv_rejects,
    "load_trips_month": load_trips_month,
    "load_added_field": load_added_field,
    "backfill_months": backfill_months,
    "weather_json_to_rows": weather_json_to_rows,
    "status_json_to_rows": status_json_to_rows,
    "status_rejects": status_rejects,
    "poll_rejects": poll_rejects,
    "weather_rejects": weather_rejects,
    "status_to_messages": status_to_messages,
    "backfill_weather": backfill_weather,
    "ingest_metrics": ingest_metrics,
    "ingest_run_report": ingest_run_report,
    "run_layer": run_layer,
    "refresh_trips": refresh_trips,
    "refresh_station_days": refresh_station_days,
    "refresh_lagging_trips": refresh_lagging_trips,
    "refresh_backfill": refresh_backfill,
    "refresh_backfill_station_days": refresh_backfill_station_days,
    "refresh_late_weather": refresh_late_weather,
    "refresh_renamed_station": refresh_renamed_station,
    "refresh_reloaded_month": refresh_reloaded_month,
    "refresh_reloaded_station_days": refresh_reloaded_station_days,
    "refresh_daily_tables": refresh_daily_tables,
    "refresh_station_daily": refresh_station_daily,
    "refresh_demand_daily": refresh_demand_daily,
    "refresh_weather_daily": refresh_weather_daily,
    "clustered_row_groups": clustered_row_groups,
    "materialize_view": materialize_view,
}
