"""Calendar parts of a date column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyymmdd as a number."""
    return F.year(day).cast("long") * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def sunday_week(day: Column) -> Column:
    """Week of the year, 0-53; a week starts on Sunday."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("long")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def weeks_between(day: Column, base: Column) -> Column:
    """Sundays crossed on the way from ``base`` to ``day``."""

    def sunday_before(d: Column) -> Column:
        return F.date_sub(d, F.dayofweek(d) - 1)

    return (F.datediff(sunday_before(day), sunday_before(base)) / 7).cast("long")


def months_between_starts(day: Column, base: Column) -> Column:
    """Month starts crossed on the way from ``base`` to ``day``."""
    years = F.year(day) - F.year(base)
    return (years * 12 + F.month(day) - F.month(base)).cast("long")


def parts(day: Column) -> dict[str, Column]:
    """The eight calendar columns carried by the station-day tables."""
    return {
        "day_of_week": F.dayofweek(day).cast("long"),
        "day_name": day_name(day),
        "is_weekend": is_weekend(day),
        "month": F.month(day).cast("long"),
        "month_name": month_name(day),
        "quarter": F.quarter(day).cast("long"),
        "year": F.year(day).cast("long"),
        "week_of_year": sunday_week(day),
    }


def five_minute_start(at: Column) -> Column:
    """Start of the five-minute interval that holds ``at``."""
    seconds = F.unix_seconds(at)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(300)))


def utc(moment: dt.datetime) -> Column:
    """A naive datetime as the instant it names in UTC, whatever the driver's own zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")
