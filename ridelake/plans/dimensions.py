"""Dimensions: station, date, time of day, user type."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake import rules
from ridelake.functions import calendar
from ridelake.functions.bands import choose, in_lists, in_ranges, ladder
from ridelake.functions.calendar import utc
from ridelake.functions.keys import instant_text, surrogate_key
from ridelake.plans.staging import trip_ends

TRACKED = ["station_name", "latitude", "longitude", "capacity", "region", "is_active"]
# Degrees (about 100 m) below which a place counts as the same: positions are measured.
MOVED = {"latitude": 0.001, "longitude": 0.001}
# Decimals of a degree (about 10 m) of the cells that places are counted in.
CELL_DIGITS = 4


def station_counts(trips: DataFrame) -> DataFrame:
    """How many trip ends give a station a name and a place, per month of start.

    Places are counted in cells, so noise of measured positions does not make the table grow:
    it holds a row for each month, station, name and cell. Counts of a month are added up
    or, when the month is loaded again, replaced.
    """
    month = F.date_format("started_at", "yyyy-MM").alias("month")
    ends = trip_ends(trips.withColumn("month", month), ["station_name", "latitude", "longitude"], ["month"])
    cells = {f"{c}_cell": F.round(c, CELL_DIGITS) for c in ("latitude", "longitude")}
    return _summed(ends.where("station_name IS NOT NULL").withColumns(cells).withColumn("n", F.lit(1).cast("long")))


def merged_counts(*counts: DataFrame) -> DataFrame:
    """Counts of several sets of trips as those of all."""
    return _summed(reduce(DataFrame.unionByName, counts))


_COUNTED = ["month", "station_id", "station_name", "latitude_cell", "longitude_cell"]


def _summed(rows: DataFrame) -> DataFrame:
    places = [F.min(c).alias(c) for c in ("latitude", "longitude")]
    return rows.groupBy(*_COUNTED).agg(*places, F.sum("n").alias("n")).select("station_id", "station_name", "latitude_cell", "longitude_cell", "latitude", "longitude", "n", "month")


def station_master(trips: DataFrame, updated_at: dt.datetime) -> DataFrame:
    """Every station named by a trip end, with its most frequent name and place."""
    return master_of(station_counts(trips), updated_at)


def master_of(counts: DataFrame, updated_at: dt.datetime) -> DataFrame:
    """Stations with the name that most trip ends give them, the lowest on ties, and the
    cell that most lie in; the place is the lowest latitude and longitude found there.

    Exactly one row per id: two rows for a renamed station would later double its
    trips. Trips carry neither capacity nor region.
    """
    names = counts.groupBy("station_id", "station_name").agg(F.sum("n").alias("n"))
    names = names.groupBy("station_id").agg(F.min_by("station_name", F.struct(-F.col("n"), "station_name")).alias("station_name"))
    cell = ["latitude_cell", "longitude_cell"]
    places = counts.groupBy("station_id", *cell).agg(F.sum("n").alias("n"), F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    # A known place before an unknown one, whatever their numbers.
    order = F.struct(F.col("latitude_cell").isNull() | F.col("longitude_cell").isNull(), -F.col("n"), *cell)
    places = places.groupBy("station_id").agg(F.min_by(F.struct("latitude", "longitude"), order).alias("place"))
    return names.join(places, "station_id").select(
        "station_id",
        "station_name",
        "place.latitude",
        "place.longitude",
        F.lit(None).cast("long").alias("capacity"),
        F.lit(None).cast("string").alias("region"),
        F.lit(True).alias("is_active"),
        utc(updated_at).alias("updated_at"),
    )


def borough(latitude: Column, longitude: Column) -> Column:
    steps = [(latitude.isNull(), "Unknown")]
    steps += [(latitude > bound, name) for bound, name in rules.BOROUGH_BY_LATITUDE]
    steps.append((longitude < rules.BROOKLYN_WEST_OF, "Brooklyn"))
    return choose(steps, "Queens")


def dim_station(history: DataFrame, created_at: dt.datetime) -> DataFrame:
    """All station versions and the row that unmatched facts point to. Facts keep the key
    of the version that was valid when they happened."""
    created = utc(created_at).cast("timestamp_ntz")
    current = history.select(
        surrogate_key(F.col("station_id"), instant_text(F.col("valid_from"))).alias("station_key"),
        "station_id",
        "station_name",
        "latitude",
        "longitude",
        "capacity",
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        "is_active",
        borough(F.col("latitude"), F.col("longitude")).alias("borough"),
        ladder(F.col("capacity"), ">=", rules.STATION_SIZE).alias("station_size"),
        F.col("valid_from").cast("timestamp_ntz").alias("effective_date"),
        F.col("valid_to").cast("timestamp_ntz").alias("end_date"),
        F.col("valid_to").isNull().alias("is_current"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        created.alias("created_at"),
    )
    known = {
        "station_key": surrogate_key(F.lit(rules.UNKNOWN_STATION_ID)),
        "station_id": F.lit(rules.UNKNOWN_STATION_ID),
        "station_name": F.lit("Unknown Station"),
        "region": F.lit("Unknown"),
        "is_active": F.lit(False),
        "borough": F.lit("Unknown"),
        "station_size": F.lit("unknown"),
        "effective_date": F.lit("1900-01-01 00:00:00"),
        "is_current": F.lit(True),
        "created_at": created,
    }
    unknown = history.sparkSession.range(1).select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in current.schema]
    )
    return current.unionByName(unknown)


def date_bounds(*dated: DataFrame) -> DataFrame:
    """First and last ``date_day`` over all inputs: one row, no shuffle of the data."""
    spans = [d.agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi")) for d in dated]
    merged = reduce(DataFrame.unionByName, spans)
    return merged.agg(F.min("lo").alias("min_date"), F.max("hi").alias("max_date"))


def date_spine(bounds: DataFrame, look_ahead: int = rules.CALENDAR_LOOKAHEAD_DAYS) -> DataFrame:
    """Every day from the first date to ``look_ahead`` days after the last."""
    last = F.date_add("max_date", look_ahead)
    return bounds.where("min_date is not null").select(
        F.explode(F.sequence("min_date", last)).alias("full_date")
    )


def dim_date(bounds: DataFrame, as_of: dt.date, created_at: dt.datetime) -> DataFrame:
    day, today = F.col("full_date"), F.lit(as_of)
    of_month, of_year = F.dayofmonth(day), F.dayofyear(day)
    month, quarter, year = F.month(day), F.quarter(day), F.year(day)
    ends_month = day == F.last_day(day)
    columns = {
        "date_key": calendar.date_key(day),
        "full_date": day,
        "day_of_month": of_month,
        "day_of_week": F.dayofweek(day),
        "day_of_year": of_year,
        "day_name": calendar.day_name(day),
        "day_name_short": F.date_format(day, "E"),
        "week_of_year": calendar.sunday_week(day),
        "iso_week_of_year": F.weekofyear(day),
        "week_of_month": F.ceil(of_month / 7),
        "month": month,
        "month_name": calendar.month_name(day),
        "month_name_short": F.date_format(day, "MMM"),
        "quarter": quarter,
        "quarter_name": F.concat(F.lit("Q"), quarter.cast("string")),
        "year": year,
        "fiscal_year": year,
        "fiscal_quarter": quarter,
        "is_weekend": calendar.is_weekend(day),
        "is_weekday": ~calendar.is_weekend(day),
        "is_month_start": of_month == 1,
        "is_month_end": ends_month,
        "is_quarter_start": (of_month == 1) & (month % 3 == 1),
        "is_quarter_end": ends_month & (month % 3 == 0),
        "is_year_start": of_year == 1,
        "is_year_end": ends_month & (month == 12),
        "days_from_today": F.datediff(day, today),
        "weeks_from_today": calendar.weeks_between(day, today),
        "months_from_today": calendar.months_between_starts(day, today),
        "season": in_lists(month, rules.SEASON_OF_MONTH),
        "is_peak_biking_season": month.between(*rules.PEAK_BIKING_MONTHS),
        "is_summer_vacation": month.isin(7, 8) | ((month == 6) & (of_month >= 15)),
        "created_at": utc(created_at),
    }
    dated = date_spine(bounds).select(*[c.alias(name) for name, c in columns.items()])
    integers = [f.name for f in dated.schema if isinstance(f.dataType, T.IntegerType)]
    return dated.withColumns({c: F.col(c).cast("long") for c in integers})


def dim_time(spark: SparkSession, created_at: dt.datetime) -> DataFrame:
    """The 24 hours of a day."""
    hour = F.col("hour")
    half_day = F.when(hour < 12, "AM").otherwise("PM")
    twelve = F.pmod(hour + 11, F.lit(12)) + 1
    rush = reduce(lambda a, b: a | b, [hour.between(*r) for r in rules.RUSH_HOURS])
    columns = {
        "time_key": hour,
        "hour": hour,
        "hour_12": twelve,
        "am_pm": half_day,
        "hour_name": F.concat(twelve.cast("string"), F.lit(":00 "), half_day),
        "time_bucket": in_ranges(hour, rules.TIME_BUCKETS),
        "is_rush_hour": rush,
        "is_morning_rush": hour.between(*rules.MORNING_RUSH),
        "is_evening_rush": hour.between(*rules.EVENING_RUSH),
        "is_business_hours": hour.between(*rules.BUSINESS_HOURS),
        "is_peak_biking_hours": hour.between(*rules.PEAK_BIKING_HOURS),
        "shift": in_ranges(hour, rules.SHIFTS, "night"),
        "created_at": utc(created_at),
    }
    return spark.range(24).select(F.col("id").alias("hour")).select(
        *[c.alias(name) for name, c in columns.items()]
    )


def user_type_keys() -> dict[str, int]:
    """Key of each user type: its position among the sorted ids."""
    ids = sorted(row[0] for row in rules.USER_TYPES)
    return {user_type: position for position, user_type in enumerate(ids, start=1)}


def dim_user_type(spark: SparkSession, created_at: dt.datetime) -> DataFrame:
    keys = user_type_keys()
    rows = [(keys[row[0]], *row) for row in rules.USER_TYPES]
    schema = (
        "user_type_key BIGINT, user_type_id STRING, user_type_name STRING, "
        "user_type_description STRING, has_subscription BOOLEAN"
    )
    stamp = utc(created_at)
    return spark.createDataFrame(rows, schema).select(
        "*", stamp.alias("created_at"), stamp.alias("updated_at")
    )
