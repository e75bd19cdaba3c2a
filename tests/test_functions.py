"""Rules of single functions that are easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.functions import bands, calendar, keys, numeric


def one(spark, column, **values):
    fields = ", ".join(f"{v} AS {k}" for k, v in values.items()) or "1 AS one"
    return spark.sql(f"SELECT {fields}").select(column.alias("x")).first().x


def test_clamp_keeps_null_while_least_and_greatest_skip_it(spark):
    bare = F.least(F.lit(100.0), F.greatest(F.lit(-100.0), F.col("v")))
    assert one(spark, bare, v="CAST(NULL AS DOUBLE)") == -100.0
    assert one(spark, numeric.clamp(F.col("v"), -100, 100), v="CAST(NULL AS DOUBLE)") is None
    assert one(spark, numeric.clamp(F.col("v"), -100, 100), v="250D") == 100.0


def test_null_strict(spark):
    column = numeric.null_strict(F.least, F.col("a"), F.col("b"))
    assert one(spark, column, a="1", b="CAST(NULL AS INT)") is None
    assert one(spark, column, a="1", b="2") == 1


def test_ratio_by_zero_is_null(spark):
    assert one(spark, numeric.ratio(F.col("a"), F.col("b")), a="1", b="0") is None


@pytest.mark.parametrize(
    "end, minutes", [("2024-01-01 00:01:10", 0), ("2024-01-01 00:01:50", 1), ("2024-01-01 00:00:49", 0)]
)
def test_minutes_are_whole_and_cut(spark, end, minutes):
    column = numeric.elapsed("MINUTE", F.col("a"), F.col("b"))
    assert one(spark, column, a="timestamp'2024-01-01 00:00:50'", b=f"timestamp'{end}'") == minutes


def test_distance(spark):
    column = numeric.great_circle_km(*[F.col(c) for c in "abcd"])
    assert one(spark, column, a="40.7128D", b="-74.0060D", c="40.7306D", d="-73.9866D") == 2.57
    assert one(spark, column, a="40D", b="-74D", c="40D", d="-74D") == 0.0
    assert one(spark, column, a="40D", b="-74D", c="CAST(NULL AS DOUBLE)", d="-74D") is None


@pytest.mark.parametrize(
    "day, week",
    [("2023-01-01", 1), ("2024-01-01", 0), ("2024-01-06", 0), ("2024-01-07", 1), ("2024-12-31", 52)],
)
def test_week_starts_on_sunday(spark, day, week):
    assert one(spark, calendar.sunday_week(F.col("d")), d=f"date'{day}'") == week


@pytest.mark.parametrize(
    "day, weeks, months",
    [("2024-01-30", 0, 0), ("2024-02-03", 0, 1), ("2024-02-04", 1, 1), ("2024-01-27", -1, 0), ("2023-12-31", -4, -1)],
)
def test_boundaries_are_counted(spark, day, weeks, months):
    base = F.lit(dt.date(2024, 1, 30))
    assert one(spark, calendar.weeks_between(F.col("d"), base), d=f"date'{day}'") == weeks
    assert one(spark, calendar.months_between_starts(F.col("d"), base), d=f"date'{day}'") == months


def test_five_minute_start(spark):
    column = calendar.five_minute_start(F.col("t")).cast("string")
    assert one(spark, column, t="timestamp'2024-01-01 10:09:59.9'") == "2024-01-01 10:05:00"
    assert one(spark, column, t="timestamp'2024-01-01 10:10:00'") == "2024-01-01 10:10:00"


def test_surrogate_key(spark):
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    assert one(spark, keys.unknown_station_key()) == md5("-1")
    pair = keys.surrogate_key(F.col("a"), F.col("b"))
    assert one(spark, pair, a="'S1'", b="CAST(NULL AS STRING)") == md5("S1-_dbt_utils_surrogate_key_null_")


@pytest.mark.parametrize(
    "at, text",
    [
        ("2024-01-30 23:59:59", "2024-01-30 23:59:59+00"),
        ("2024-01-30 23:59:59.5", "2024-01-30 23:59:59.500+00"),
        ("2024-01-30 23:59:59.000001", "2024-01-30 23:59:59.000001+00"),
    ],
)
def test_instant_text(spark, at, text):
    assert one(spark, keys.instant_text(F.col("t")), t=f"timestamp'{at}'") == text


def test_ladder_sends_null_to_the_rest(spark):
    rule = ([(50, "large"), (30, "medium")], "micro")
    column = bands.ladder(F.col("v"), ">=", rule)
    assert [one(spark, column, v=v) for v in ("50", "49", "1", "CAST(NULL AS INT)")] == [
        "large",
        "medium",
        "micro",
        "micro",
    ]


def test_utc_does_not_depend_on_the_driver_zone(spark):
    moment = dt.datetime(2024, 1, 30, 23, 59, 59)
    assert one(spark, calendar.utc(moment).cast("string")) == "2024-01-30 23:59:59"
