"""Station-status polls: JSON with one array of stations, to one row per station.

The functions take batch and streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.plans.supply import COUNTERS
from ridelake.rules import MIN_VALID_EPOCH
from ridelake.schemas import STATUS_RESPONSE

FLAGS = ["is_installed", "is_renting", "is_returning"]


def parse_stations(polls: DataFrame, body: str, ingested_at: Column, keep: list[str] = ()) -> DataFrame:
    """One row per station of every poll, with defaults for missing fields; columns of the
    poll named in ``keep`` go along.

    ``valid`` tells whether the report time is usable; ``reported_epoch`` keeps the
    time as it came. Both outputs below filter this one parse.
    """
    poll = F.from_json(F.col(body), STATUS_RESPONSE)
    stations = polls.select(poll.alias("_poll"), ingested_at.alias("ingestion_timestamp"), *keep).select(
        F.coalesce("_poll.last_updated", F.lit(0)).alias("last_updated"),
        "ingestion_timestamp",
        *keep,
        F.explode("_poll.data.stations").alias("s"),
    )
    epoch = F.col("s.last_reported")
    return stations.select(
        F.coalesce("s.station_id", F.lit("")).alias("station_id"),
        *[F.coalesce(f"s.{c}", F.lit(0)).alias(c) for c in [*COUNTERS, *FLAGS]],
        F.timestamp_seconds(epoch).alias("last_reported"),
        F.coalesce("s.eightd.has_available_keys", F.lit(False)).alias("eightd_has_available_keys"),
        F.coalesce("s.legacy_id", F.lit("")).alias("legacy_id"),
        F.timestamp_seconds("last_updated").alias("api_last_updated"),
        "ingestion_timestamp",
        *keep,
        F.col("s.station_id").alias("reported_id"),
        F.coalesce(epoch, F.lit(0)).alias("reported_epoch"),
        (F.coalesce(epoch, F.lit(0)) >= MIN_VALID_EPOCH).alias("valid"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("valid").drop("valid", "reported_epoch", "reported_id")


def rejected(parsed: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Stations without a usable report time, with the time they gave."""
    return parsed.where("not valid").select(
        F.coalesce("reported_id", F.lit("unknown")).alias("station_id"),
        F.col("reported_epoch").alias("timestamp"),
        *keep,
    )


def unreadable(body: Column, otherwise: str) -> Column:
    """Why a document gave nothing."""
    return F.when(F.try_parse_json(body).isNull(), "not JSON").otherwise(otherwise)


def rejected_polls(polls: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """(document, reason) of polls that hold no stations, and so give no rows."""
    poll = F.from_json(F.col(body), STATUS_RESPONSE)
    broken = polls.where(F.coalesce(F.size(poll["data"]["stations"]), F.lit(0)) < 1)
    return broken.select(F.col(body).alias("document"), unreadable(F.col(body), "no stations").alias("reason"), *keep)


def iso_utc(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_messages(rows: DataFrame) -> DataFrame:
    """One text per station, ``{"data": "<station as JSON>"}``, times in ISO format."""
    times = ["last_reported", "api_last_updated", "ingestion_timestamp"]
    station = F.to_json(
        F.struct(*[iso_utc(F.col(c)).alias(c) if c in times else F.col(c) for c in rows.columns])
    )
    return rows.select(F.to_json(F.struct(station.alias("data"))).alias("value"))
