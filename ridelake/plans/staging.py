"""Typed, cleaned feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.operators.ranking import latest_per_key
from ridelake.schemas import STATION_STATUS, TRIPS, WEATHER, conform


def _present(*columns: str) -> str:
    """Plain null tests, which the Parquet scan can use; ``dropna`` hides them."""
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def stg_trips(raw: DataFrame) -> DataFrame:
    """Trips with an id, both times, and a positive duration."""
    known = raw.where(_present("ride_id", "started_at", "ended_at"))
    return conform(known, TRIPS).where("started_at < ended_at")


def stg_weather(raw: DataFrame) -> DataFrame:
    """The latest load of each day. Loads with equal times differ by value, highest first."""
    typed = conform(raw.where(_present("weather_date")), WEATHER)
    rest = [c for c in typed.columns if c not in ("weather_date", "loaded_at")]
    order = [F.desc_nulls_last(c) for c in ["loaded_at", *rest]]
    return latest_per_key(typed, ["weather_date"], order)


def stg_station_status(raw: DataFrame) -> DataFrame:
    """Every report with a station and a time; repeated reports are kept."""
    return conform(raw.where(_present("station_id", "last_reported")), STATION_STATUS)


# What a trip end can carry, by side.
END_FIELDS = {
    "station_name": ("start_station_name", "end_station_name"),
    "latitude": ("start_lat", "end_lat"),
    "longitude": ("start_lng", "end_lng"),
    # Only the start has a duration, so that aggregates count each trip once.
    "minutes": (
        "timestampdiff(MINUTE, started_at, ended_at)",
        "CAST(NULL AS BIGINT)",
    ),
}


def trip_ends(trips: DataFrame, fields: list[str], keep: list[str] = ()) -> DataFrame:
    """Two rows per trip: where it starts and where it ends.

    Per-station demand and the station list need both ends. Unfolding them reads
    the trips once and groups them once, where two aggregates and a full outer
    join would read and shuffle twice. The listed ``fields`` alone are unfolded:
    the scan reads every column that goes into the pair.
    """

    def end(side: int, name: str, station: str, at: str) -> str:
        extra = "".join(f", {END_FIELDS[f][side]} AS {f}" for f in fields)
        return f"struct('{name}' AS side, {station} AS station_id, {at} AS at{extra})"

    pair = (
        end(0, "start", "start_station_id", "started_at"),
        end(1, "end", "end_station_id", "ended_at"),
    )
    unfolded = trips.selectExpr(*keep, f"inline(array({', '.join(pair)}))")
    return unfolded.where("station_id IS NOT NULL")
