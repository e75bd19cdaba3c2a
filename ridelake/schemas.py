"""Declared column types of the raw feeds and the typed staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STRING, LONG, DOUBLE, BOOLEAN = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, INSTANT = T.DateType(), T.TimestampType()


def _table(required: list[str], groups: list[tuple[T.DataType, str]]) -> T.StructType:
    """Fields from (type, names) groups, in order."""
    return T.StructType(
        [
            T.StructField(name, kind, name not in required)
            for kind, names in groups
            for name in names.split()
        ]
    )


TRIPS = _table(
    ["ride_id", "rideable_type", "started_at", "ended_at"],
    [
        (STRING, "ride_id rideable_type"),
        (INSTANT, "started_at ended_at"),
        (STRING, "start_station_name start_station_id end_station_name end_station_id"),
        (DOUBLE, "start_lat start_lng end_lat end_lng"),
        (STRING, "member_casual"),
    ],
)
WEATHER = _table(
    ["weather_date"],
    [
        (DATE, "weather_date"),
        (DOUBLE, "temperature_max temperature_min temperature_mean"),
        (DOUBLE, "precipitation_sum rain_sum snowfall_sum precipitation_hours"),
        (LONG, "weather_code"),
        (DOUBLE, "wind_speed_max wind_gusts_max latitude longitude"),
        (STRING, "city"),
        (INSTANT, "loaded_at"),
    ],
)
STATION_STATUS = _table(
    ["station_id"],
    [
        (STRING, "station_id legacy_id"),
        (LONG, "num_bikes_available num_ebikes_available num_bikes_disabled"),
        (LONG, "num_docks_available num_docks_disabled"),
        (LONG, "num_scooters_available num_scooters_unavailable"),
        (BOOLEAN, "is_installed is_renting is_returning eightd_has_available_keys"),
        (INSTANT, "last_reported api_last_updated ingestion_timestamp"),
    ],
)

# One response of the daily weather service: a struct of parallel arrays.
WEATHER_RESPONSE = """
    daily STRUCT<
      time: ARRAY<STRING>, temperature_2m_max: ARRAY<DOUBLE>, temperature_2m_min: ARRAY<DOUBLE>,
      temperature_2m_mean: ARRAY<DOUBLE>, precipitation_sum: ARRAY<DOUBLE>, rain_sum: ARRAY<DOUBLE>,
      snowfall_sum: ARRAY<DOUBLE>, precipitation_hours: ARRAY<DOUBLE>, weather_code: ARRAY<BIGINT>,
      wind_speed_10m_max: ARRAY<DOUBLE>, wind_gusts_10m_max: ARRAY<DOUBLE>>
"""

# One poll of the station-status service: all stations in one message.
STATUS_RESPONSE = """
    last_updated BIGINT,
    data STRUCT<stations: ARRAY<STRUCT<
      station_id: STRING, legacy_id: STRING,
      num_bikes_available: BIGINT, num_ebikes_available: BIGINT, num_bikes_disabled: BIGINT,
      num_docks_available: BIGINT, num_docks_disabled: BIGINT,
      num_scooters_available: BIGINT, num_scooters_unavailable: BIGINT,
      is_installed: BIGINT, is_renting: BIGINT, is_returning: BIGINT,
      eightd: STRUCT<has_available_keys: BOOLEAN>, last_reported: BIGINT>>>
"""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the names, order and types of ``schema``."""
    return df.selectExpr(
        *[f"cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    )


def schema_differences(df: DataFrame, schema: T.StructType) -> list[tuple[str, str, str]]:
    """(column, declared type, actual type) wherever the two disagree."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    declared = {f.name: f.dataType.simpleString() for f in schema}
    return [
        (name, declared.get(name, "absent"), actual.get(name, "absent"))
        for name in [*declared, *[n for n in actual if n not in declared]]
        if declared.get(name) != actual.get(name)
    ]
