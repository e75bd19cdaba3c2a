"""Freshness and volume reports on the feeds. ``now`` is always passed in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ridelake import rules
from ridelake.functions.bands import ladder
from ridelake.functions.calendar import utc
from ridelake.functions.numeric import elapsed
from ridelake.operators.ranking import top_k
from ridelake.sources.status import accepted, parse_stations


def source_freshness(sources: Mapping[str, tuple[DataFrame, str]], now: dt.datetime) -> DataFrame:
    """Hours since the last load of each source, as pass, warn or error.

    ``sources`` maps a name to the table and its load-time column.
    """
    parts = [
        df.agg(F.max(F.col(column).cast("timestamp")).alias("max_loaded_at")).select(
            F.lit(name).alias("source"), "max_loaded_at"
        )
        for name, (df, column) in sources.items()
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    minutes = elapsed("MINUTE", F.col("max_loaded_at"), utc(now))
    status = (
        F.when(minutes > rules.SOURCE_ERROR_HOURS * 60, "error")
        .when(minutes > rules.SOURCE_WARN_HOURS * 60, "warn")
        .when(minutes.isNotNull(), "pass")
        .otherwise("error")
    )
    return table.select(
        "source",
        "max_loaded_at",
        elapsed("HOUR", F.col("max_loaded_at"), utc(now)).alias("hours_old"),
        status.alias("status"),
    )


def stream_health(status: DataFrame, now: dt.datetime) -> DataFrame:
    """Newest report, its age, the stations seen, and the class of the age."""
    age = elapsed("MINUTE", F.col("latest_data"), utc(now))
    newest = status.agg(
        F.max("last_reported").alias("latest_data"),
        F.count_distinct("station_id").alias("stations"),
    )
    return newest.select(
        "latest_data",
        age.alias("minutes_old"),
        "stations",
        ladder(age, "<", rules.STREAM_AGE_MINUTES).alias("status"),
    )


def active_entities(status: DataFrame, now: dt.datetime, minutes: int = 10) -> DataFrame:
    """Stations that reported in the last minutes."""
    since = utc(now) - F.make_dt_interval(mins=F.lit(minutes))
    active = status.where(F.col("last_reported") >= since).agg(
        F.count_distinct("station_id").alias("active_stations")
    )
    return active.withColumn(
        "status", ladder(F.col("active_stations"), ">", rules.ACTIVE_STATIONS)
    )


def stale_entities(
    status: DataFrame, now: dt.datetime, minutes: int = rules.STALE_AFTER_MINUTES
) -> DataFrame:
    """Stations that reported today, but not lately; longest silence first."""
    today = F.to_date("last_reported") == F.lit(now.date())
    latest = status.where(today).groupBy("station_id").agg(F.max("last_reported").alias("last_update"))
    silent = elapsed("MINUTE", F.col("last_update"), utc(now))
    return (
        latest.withColumn("minutes_stale", silent)
        .where(F.col("minutes_stale") > minutes)
        .orderBy(F.desc("minutes_stale"), "station_id")
    )


def weather_age(weather: DataFrame, as_of: dt.date) -> DataFrame:
    newest = weather.agg(F.max("weather_date").alias("latest_day"))
    days = F.datediff(F.lit(as_of), F.col("latest_day")).cast("long")
    return newest.select(
        "latest_day",
        days.alias("days_old"),
        ladder(days, "<", rules.WEATHER_AGE_DAYS).alias("status"),
    )


def trip_span(raw: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows and first and last start of the raw trips and of the trip fact."""

    def span(name: str, df: DataFrame) -> DataFrame:
        start = F.col("started_at").cast("timestamp")
        return df.agg(
            F.count("*").alias("trips"),
            F.min(start).alias("first_start"),
            F.max(start).alias("last_start"),
        ).select(F.lit(name).alias("layer"), "trips", "first_start", "last_start")

    return span("raw", raw).unionByName(span("fact", facts))


def recent_reports(status: DataFrame, station_id: str, k: int = 10) -> DataFrame:
    """The reports of one station that came in last."""
    newest = [F.desc("ingestion_timestamp"), F.desc("last_reported")]
    return top_k(status.where(F.col("station_id") == station_id), k, newest)


def regex_ids(table: DataFrame, column: str, pattern: str) -> DataFrame:
    """Ids that match a pattern, with their rows."""
    return table.where(F.col(column).rlike(pattern)).groupBy(column).agg(F.count("*").alias("n"))


def observed_parse(polls: DataFrame, body: str, ingested_at: Column) -> tuple[DataFrame, Observation]:
    """The parsed stations, and run metrics that are ready once they were written."""
    metrics = Observation("status_ingest")
    parsed = parse_stations(polls, body, ingested_at)
    observed = parsed.observe(
        metrics,
        F.count(F.lit(1)).alias("fetched"),
        F.count_if("valid").alias("published"),
        F.count_if(~F.col("valid")).alias("skipped"),
    )
    return observed, metrics


def ingest_metrics(parsed: DataFrame) -> DataFrame:
    """The same metrics from a stored parse, with the outcome of the run."""
    counts = parsed.agg(
        F.count("*").alias("fetched"),
        F.count_if("valid").alias("published"),
        F.count_if(~F.col("valid")).alias("skipped"),
    )
    outcome = F.when(F.col("published") > 0, "success").otherwise("failed")
    return counts.withColumn("status", outcome)


RUN_REPORT = (
    "run_id STRING, started_at TIMESTAMP, ended_at TIMESTAMP, duration_seconds DOUBLE, "
    "fetched BIGINT, published BIGINT, skipped BIGINT, status STRING, error STRING"
)


def run_report(spark: SparkSession, run_id: str, job: Callable[[], dict[str, int]]) -> DataFrame:
    """One row about a run of ``job``, which returns its counts: when it ran, how long, with
    what outcome, and the text of the error that ended it."""
    started, counts, error = dt.datetime.now(dt.timezone.utc), {}, None
    try:
        counts = job()
    except Exception as failure:  # the report is how failures are told
        error = str(failure).splitlines()[0] if str(failure) else type(failure).__name__
    ended = dt.datetime.now(dt.timezone.utc)
    numbers = [counts.get(c) for c in ("fetched", "published", "skipped")]
    status = "success" if error is None else "failed"
    row = (run_id, started, ended, (ended - started).total_seconds(), *numbers, status, error)
    return spark.createDataFrame([row], RUN_REPORT)


def ingest_polls(polls: DataFrame, body: str, ingested_at: Column, path: str) -> dict[str, int]:
    """Parse polls, write the accepted reports to ``path`` and return the counts of the run.
    Polls of which no report can be published fail the run."""
    observed, metrics = observed_parse(polls, body, ingested_at)
    accepted(observed).write.mode("overwrite").parquet(path)
    if not metrics.get["published"]:
        raise ValueError(f"none of {metrics.get['fetched']} reports could be published")
    return dict(metrics.get)
