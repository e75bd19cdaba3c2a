"""Daily weather responses: JSON with parallel arrays, to one row per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.calendar import utc
from ridelake.schemas import WEATHER_RESPONSE
from ridelake.sources.status import unreadable

CITY, LATITUDE, LONGITUDE = "New York City", "40.7128", "-74.0060"
# Response array -> column.
ARRAYS = {
    "time": "weather_date",
    "temperature_2m_max": "temperature_max",
    "temperature_2m_min": "temperature_min",
    "temperature_2m_mean": "temperature_mean",
    "precipitation_sum": "precipitation_sum",
    "rain_sum": "rain_sum",
    "snowfall_sum": "snowfall_sum",
    "precipitation_hours": "precipitation_hours",
    "weather_code": "weather_code",
    "wind_speed_10m_max": "wind_speed_max",
    "wind_gusts_10m_max": "wind_gusts_max",
}


def parse_weather(responses: DataFrame, body: str, loaded_at: dt.datetime) -> DataFrame:
    """One row per day of every response. A missing array gives nulls, and arrays
    zip by position; days beyond the ``time`` array do not exist."""
    daily = F.from_json(F.col(body), WEATHER_RESPONSE)["daily"]
    days = responses.select(daily.alias("daily")).select(
        *[F.col(f"daily.{a}").alias(c) for a, c in ARRAYS.items()]
    )
    size = F.size("weather_date")
    padded = [
        F.coalesce(F.slice(c, 1, size), F.array_repeat(F.lit(None), size).cast(t)).alias(c)
        for c, t in days.dtypes
    ]
    zipped = F.arrays_zip(*ARRAYS.values())
    rows = days.where("weather_date is not null").select(*padded).select(F.inline(zipped))
    dated = rows.withColumn("weather_date", F.expr("try_cast(weather_date AS DATE)"))
    return dated.where("weather_date IS NOT NULL").select(
        "weather_date",
        *[c for c in ARRAYS.values() if c != "weather_date"],
        F.lit(LATITUDE).alias("latitude"),
        F.lit(LONGITUDE).alias("longitude"),
        F.lit(CITY).alias("city"),
        utc(loaded_at).alias("loaded_at"),
    )


def weather_rejects(responses: DataFrame, body: str) -> DataFrame:
    """(document, reason): responses without readable days, and days without a date."""
    text = F.col(body)
    days = F.from_json(text, WEATHER_RESPONSE)["daily"]["time"]
    undated = F.filter(days, lambda d: F.coalesce(d, F.lit("")).try_cast("date").isNull())
    faults = F.when(days.isNull(), F.array(F.struct(text.alias("document"), unreadable(text, "no days").alias("reason")))).otherwise(
        F.transform(undated, lambda d: F.struct(d.alias("document"), F.lit("no date").alias("reason")))
    )
    return responses.select(F.inline(faults))


def append_weather(rows: DataFrame, path: str) -> None:
    """Append to day partitions, latest day first inside a file."""
    rows.sortWithinPartitions(F.desc("weather_date")).write.mode("append").partitionBy(
        "weather_date"
    ).parquet(path)


def load_weather_range(rows: DataFrame, path: str, first: dt.date, last: dt.date) -> None:
    """Replace the days from ``first`` to ``last`` by those of ``rows``: a backfill that may
    be repeated. Days that ``rows`` lacks keep what they have."""
    days = rows.where(F.col("weather_date").between(F.lit(first), F.lit(last)))
    writer = days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("weather_date").parquet(path)
