"""Incremental runs: every stored table as after a full build, at bounded cost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.operators import layout
from ridelake.plans import daily, dimensions, staging
from ridelake.plans.build import TABLES, Models
from ridelake.plans.refresh import refresh
from ridelake.sources.feeds import NOW, Feeds, event_feeds

STORED = [name for name, (layer, _, _) in TABLES.items() if layer != "staging" and name != "int_station_metrics"]
AUDIT = ("loaded_at", "created_at")


def same(a, b):
    a, b = (d.drop(*AUDIT) for d in (a, b))
    assert a.dtypes == b.dtypes
    doubles = [c for c, t in a.dtypes if t == "double"]
    a, b = (d.withColumns({c: F.round(c, 6) for c in doubles}) for d in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def assert_as_built(refreshed, built):
    for name in STORED:
        assert same(refreshed.table(name), built.table(name)), name
    assert same(refreshed.station_counts, built.station_counts)


@pytest.fixture(scope="module")
def two_months(spark, sf_dir):
    """Trips of two months: every second one is 25 days later."""
    feeds = event_feeds(spark, sf_dir)
    n = F.regexp_extract("ride_id", "[0-9]+", 0).cast("long")
    shift = F.when(n % 2 == 0, F.expr("make_interval(0, 0, 0, 25)")).otherwise(F.expr("make_interval(0, 0, 0, 0)"))
    trips = feeds.trips.withColumns({c: F.col(c) + shift for c in ("started_at", "ended_at")})
    return Feeds(trips, feeds.weather, feeds.status), n


@pytest.fixture(scope="module")
def built(spark, two_months, tmp_path_factory):
    return Models(spark, two_months[0], NOW, str(tmp_path_factory.mktemp("built"))).build()


def test_a_month_loaded_again_replaces_what_it_held(spark, two_months, built, tmp_path):
    feeds, n = two_months
    january = F.date_format("started_at", "yyyy-MM") == "2024-01"
    moved = F.expr("make_interval(0, 0, 0, 3)")
    wrong = feeds.trips.where(january & (n % 9 != 1)).withColumns(
        {
            "started_at": F.when(n % 7 == 3, F.col("started_at") - moved).otherwise(F.col("started_at")),
            "start_station_name": F.lit("misprint"),
            "start_lat": F.col("start_lat") + 1,
        }
    )
    extra = feeds.trips.where(january & (n % 5 == 0)).withColumn("ride_id", F.concat(F.lit("X"), "ride_id"))
    first = feeds.trips.where(~january).unionByName(wrong.where(january)).unionByName(extra)
    root = str(tmp_path / "w")
    # The stations' first snapshot is that of the right names: versions are another matter.
    early = Models(spark, Feeds(first, feeds.weather, feeds.status), NOW, root)
    early.__dict__["snap_station"] = built.snap_station
    early.build()
    assert early.station_counts.where("station_name = 'misprint'").count()
    layout.replace_table(built.snap_station, early.path("snap_station"))
    assert not same(early.fct_trips, built.fct_trips)
    arrived = Feeds(feeds.trips.where(january), feeds.weather.limit(0), feeds.status.limit(0))
    february = {f for f in layout.manifest(spark, early.path("fct_trips")).folders if "=202402" in f}
    refreshed = refresh(spark, feeds, arrived, NOW, root, reloaded=["2024-01"])
    assert_as_built(refreshed, built)
    assert february and february <= set(layout.manifest(spark, early.path("fct_trips")).folders)
    # Once more changes nothing.
    assert_as_built(refresh(spark, feeds, arrived, NOW, root, reloaded=["2024-01"]), built)


def test_a_month_may_be_loaded_empty(spark, two_months, tmp_path):
    feeds, _ = two_months
    january = F.date_format("started_at", "yyyy-MM") == "2024-01"
    root = str(tmp_path / "w")
    Models(spark, feeds, NOW, root).build()
    rest = Feeds(feeds.trips.where(~january), feeds.weather, feeds.status)
    nothing = Feeds(feeds.trips.limit(0), feeds.weather.limit(0), feeds.status.limit(0))
    refreshed = refresh(spark, rest, nothing, NOW, root, reloaded=["2024-01"])
    again = Models(spark, rest, NOW, str(tmp_path / "v")).build()
    for name in ("fct_trips", "int_trip_station_daily", "int_station_daily_fact", "fct_station_day"):
        assert same(refreshed.table(name), again.table(name)), name


def test_late_rows_of_all_feeds_reach_every_table(spark, two_months, built, tmp_path):
    feeds, n = two_months
    late = {
        "trips": F.to_date("started_at").isin(dt.date(2024, 1, 9), dt.date(2024, 2, 3)),
        "weather": F.to_date("weather_date") == dt.date(2024, 1, 12),
        "status": F.to_date("last_reported") == dt.date(2024, 1, 5),
    }
    tables = {"trips": feeds.trips, "weather": feeds.weather, "status": feeds.status}
    root = str(tmp_path / "w")
    Models(spark, Feeds(**{k: t.where(~late[k]) for k, t in tables.items()}), NOW, root).build()
    arrived = Feeds(**{k: t.where(late[k]) for k, t in tables.items()})
    assert_as_built(refresh(spark, feeds, arrived, NOW, root), built)


# --- how far a change reaches ------------------------------------------------------------------


def test_a_change_reaches_27_rows_of_its_station(spark):
    first = dt.date(2023, 1, 1)
    day = lambda i: first + dt.timedelta(days=i)
    rows = [("daily", day(i), True, i == 100) for i in range(300)]
    rows += [("weekly", day(7 * i), True, i == 10) for i in range(60)]
    rows += [("other", day(i), True, False) for i in range(300)]
    rows += [("gone", day(i), i != 50, i == 50) for i in range(200)]
    keys = spark.createDataFrame(rows, "station_id string, date_day date, held boolean, changed boolean")
    got = daily.frames_around(keys).collect()
    affected = {s: sorted((r.date_day - first).days for r in got if r.station_id == s and r.affected) for s in ("daily", "weekly", "other", "gone")}
    assert affected == {"daily": list(range(100, 128)), "weekly": [7 * i for i in range(10, 38)], "other": [], "gone": list(range(51, 78))}
    needed = {s: sorted((r.date_day - first).days for r in got if r.station_id == s) for s in affected}
    assert needed == {"daily": list(range(73, 128)), "weekly": [7 * i for i in range(38)], "other": [], "gone": [i for i in range(23, 78) if i != 50]}


def test_a_late_day_rewrites_28_days_and_reads_27_before_it(spark, built):
    """Over a stored fact of 300 days; only keys are read of the others."""
    one = built.int_station_daily_fact.where("date_day = date'2024-01-10'")
    shift = F.explode(F.sequence(F.lit(0), F.lit(299)))
    long = one.withColumn("i", shift).withColumn("date_day", F.date_add(F.lit("2023-01-01").cast("date"), F.col("i"))).drop("i")
    path = built.path("long_fact")
    layout.write_table(long, path, "date_day")
    stored, late = layout.read_table(spark, path), dt.date(2023, 5, 1)
    on = F.col("date_day") == F.lit(late)
    supply = stored.where(on).select("station_id", "date_day", *daily.SUPPLY, *daily.WEATHER)
    demand = stored.where(on).select("station_id", "date_day", *daily.DEMAND)
    rows, rewritten = daily.station_daily_fact_around(supply, demand, stored, [late])
    assert rewritten == [late + dt.timedelta(days=i) for i in range(28)]
    assert {r[0] for r in rows.select("date_day").distinct().collect()} == set(rewritten)
    assert rows.count() == one.count() * 28
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    scans = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "long_fact" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = [s.split("PartitionFilters: [")[1].split("PushedFilters")[0] for s in scans]
    assert filters and all("2023-05" in f or "2023-04" in f for f in filters)
    assert not any("2023-06" in f or "2023-03" in f for f in filters)


# --- stations ------------------------------------------------------------------------------------


def rides(spark, ends):
    """One trip for each (name, latitude) of station S, at one longitude."""
    rows = [(f"R{i}", dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 9), "S", name, lat, -74.0) for i, (name, lat) in enumerate(ends)]
    table = spark.createDataFrame(rows, "ride_id string, started_at timestamp, ended_at timestamp, start_station_id string, start_station_name string, start_lat double, start_lng double")
    none = {"rideable_type": "string", "member_casual": "string", "end_station_id": "string", "end_station_name": "string", "end_lat": "double", "end_lng": "double"}
    return staging.stg_trips(table.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}))


def test_the_name_is_that_of_most_trips(spark):
    ends = [("New", 40.7)] * 100 + [("Old", 40.7 + i / 10) for i in (1, 2, 3)]
    row = dimensions.station_master(rides(spark, ends), NOW).first()
    assert (row.station_name, row.latitude, row.longitude) == ("New", 40.7, -74.0)
    tie = [("B", 40.1), ("A", None), ("A", 40.1), ("B", None), ("B", None), ("A", None)]
    row = dimensions.station_master(rides(spark, tie), NOW).first()
    assert (row.station_name, row.latitude) == ("A", 40.1)


def test_noise_of_positions_does_not_make_the_counts_grow(spark):
    noisy = [("S", 40.70001 + (i % 97) * 4e-7) for i in range(3000)]
    counts = dimensions.station_counts(rides(spark, noisy))
    assert counts.count() == 1 and counts.first().n == 3000
    assert dimensions.master_of(counts, NOW).first().latitude == pytest.approx(40.7, abs=1e-4)


def test_counts_of_parts_add_up(spark):
    ends = [("A", 40.1), ("B", 40.1), ("A", 40.2), ("A", 40.10001)]
    whole = dimensions.station_counts(rides(spark, ends))
    parts = dimensions.merged_counts(*[dimensions.station_counts(rides(spark, part)) for part in (ends[:1], ends[1:3], ends[3:])])
    assert whole.exceptAll(parts).count() == 0 == parts.exceptAll(whole).count()
