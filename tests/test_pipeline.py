"""Whole jobs: layered build, incremental equality, quality failures, ingestion, streams."""

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ridelake import session
from ridelake.functions.calendar import utc
from ridelake.operators import layout
from ridelake.plans import monitor, quality
from ridelake.plans.build import TABLES, VIEWS, WAVES, Models
from ridelake.queries.ingest import warehouse
from ridelake.queries.models import models
from ridelake.session import stage_root
from ridelake.sources import status, trips, weather
from ridelake.sources.feeds import NOW, Feeds, event_feeds
from ridelake.streaming import status_stream as stream


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    return warehouse(spark, sf_dir)


def test_layers_equal_the_lazy_models(spark, sf_dir, built):
    lazy = models(spark, sf_dir)
    for name in ("int_station_daily_fact", "fct_trips", "fct_station_day", "dim_date", "dim_station"):
        a = built.table(name).drop("loaded_at", "created_at")
        b = lazy.table(name).drop("loaded_at", "created_at")
        doubles = [c for c, t in a.dtypes if t == "double"]
        a, b = (d.withColumns({c: F.round(c, 6) for c in doubles}) for d in (a, b))
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_written_facts_prune_partitions(built):
    day = built.fct_station_day.where("date_day = date'2024-01-10'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_day" in plan
    trips_plan = built.vw_trip_analytics_daily  # planned over the partitioned fact
    assert trips_plan.count() > 0


def test_small_tables_are_broadcast_by_their_size_not_by_a_hint(spark, sf_dir):
    fact = models(spark, sf_dir).fct_trips
    assert "BroadcastHashJoin" in fact._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = models(spark, sf_dir).fct_trips
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2  # both station roles
        assert big.count() == fact.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def session_like(configured=None, context_dir=None, master="local[2]"):
    context = SimpleNamespace(getCheckpointDir=lambda: context_dir, master=master)
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_stage_folder_comes_from_the_session():
    assert stage_root(session_like(configured="hdfs://shared/ckpt/")) == "hdfs://shared/ckpt"
    assert stage_root(session_like(context_dir="/shared/set-by-job")) == "/shared/set-by-job"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stage_root(session_like(master="spark://host:7077"))


def test_staged_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_STAGED", [])
    session.stage(spark.range(3), "short_lived")
    (path,) = session._STAGED
    assert spark.read.parquet(path).count() == 3
    assert session.drop_staged(spark) == 1
    fs, folder = session.filesystem(spark, path)
    assert not fs.exists(folder)


def pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_staging_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    from ridelake.plans import demand, staging, supply
    from ridelake.sources.feeds import event_feeds

    feeds = event_feeds(spark, sf_dir)
    feeds.trips.write.parquet(f"{tmp_path}/trips")
    feeds.status.write.parquet(f"{tmp_path}/status")
    rides = demand.demand_daily(staging.stg_trips(spark.read.parquet(f"{tmp_path}/trips")))
    (scan,) = pushed(rides)  # one scan feeds both ends of the trips
    assert "IsNotNull(ride_id)" in scan
    assert "start_lat" not in scan and "start_station_name" not in scan
    reports = staging.stg_station_status(spark.read.parquet(f"{tmp_path}/status"))
    (scan,) = pushed(supply.station_daily(supply.station_metrics(reports)))
    assert "IsNotNull(station_id)" in scan and "IsNotNull(last_reported)" in scan
    assert "legacy_id" not in scan and "api_last_updated" not in scan


# --- quality -----------------------------------------------------------------------------------


def broken(built):
    """The built tables with one defect of each kind in the trip fact."""
    good = built.fct_trips
    row = good.limit(1)
    bad = good.unionByName(row).unionByName(
        row.withColumn("trip_key", F.lit("x")).withColumns(
            {
                "start_station_key": F.lit("lost"),
                "user_type_key": F.lit(None).cast("long"),
                "bike_type": F.lit("tandem"),
                "trip_duration_minutes": F.lit(-1).cast("long"),
            }
        )
    )
    return lambda name: bad if name == "fct_trips" else built.table(name)


def test_clean_layers_pass_and_defects_fail(built):
    clean = quality.summary(built.table)
    assert clean.where("section IN ('foreign_keys', 'dimensions', 'null_keys') AND failed > 0").count() == 0
    tables = broken(built)

    def failed(report):
        found = report.where("table_name = 'fct_trips' AND failures > 0").collect()
        return {(r.target, r.failures) for r in found}

    assert failed(quality.unique(tables)) == {("trip_key", 1)}
    assert failed(quality.not_null(tables)) == {("user_type_key", 1)}
    assert failed(quality.accepted_values(tables)) == {("bike_type", 1)}
    assert failed(quality.expression_is_true(tables)) == {("trip_duration_minutes >= 0", 1)}
    assert failed(quality.relationships(tables)) == {("start_station_key -> dim_station.station_key", 1)}
    assert failed(quality.fk_orphans(tables)) == {
        ("start_station_key -> dim_station.station_key", 1),
        ("user_type_key -> dim_user_type.user_type_key", 1),
    }
    assert quality.layer_counts(tables).first().status == "WARNING"
    with pytest.raises(ValueError, match="foreign_keys"):
        quality.assert_valid(quality.summary(tables))


def test_number_of_declared_assertions():
    count = lambda d: sum(len(v) for v in d.values())
    assert count(quality.NOT_NULL) == 47
    assert count(quality.UNIQUE) == 8
    assert count(quality.UNIQUE_TOGETHER) == 5
    assert count(quality.ACCEPTED) == 9
    assert len(quality.RELATIONSHIPS) == 7
    assert count(quality.expressions()) == 7
    assert len(quality.MODEL_KEYS) == 14


# --- ingestion -----------------------------------------------------------------------------------


def test_csv_with_empty_fields_lands_by_month(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    header = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"
    (tmp_path / "csv" / "a.csv").write_text(
        header + 'R1,classic_bike,2024-01-31 23:59:59.123,2024-02-01 00:10:00.000,"A, B",4485.10,,,40.7,-74.0,,,member\n'
    )
    (tmp_path / "csv" / "b.csv").write_text(
        header + "R2,electric_bike,2024-02-01 00:00:00.000,2024-02-01 00:10:00.000,,,C,7522.02,,,40.7,-74.0,casual\n"
    )
    landing = str(tmp_path / "landing")
    trips.land_trips(trips.read_trip_csv(spark, str(tmp_path / "csv")), landing)
    january = trips.read_months(spark, landing, ["2024-01"])
    row = january.first()
    assert january.count() == 1
    assert (row.start_station_name, row.start_station_id, row.end_station_id, row.end_lat) == ("A, B", "4485.10", None, None)
    assert row.started_at.microsecond == 123000
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1]


def test_files_of_one_name_do_not_replace_each_other(spark, tmp_path):
    landing = str(tmp_path / "landing")
    rides = spark.sql("SELECT timestamp'2024-01-02' AS started_at, id FROM VALUES ('a'), ('b') AS t(id)")
    for folder in "ab":
        rides.where(F.col("id") == folder).coalesce(1).write.parquet(str(tmp_path / folder / "x"))
        (made,) = (tmp_path / folder / "x").glob("part-*")
        made.rename(tmp_path / folder / "trips.parquet")
    for folder in "aba":
        trips.land_trips(spark.read.parquet(str(tmp_path / folder / "trips.parquet")), landing)
    assert rows(spark.read.parquet(landing), "id") == [("a",), ("b",)]
    for name in ("one", "two", "one"):
        trips.land_trips(rides.limit(1), landing, source=name)
    assert spark.read.parquet(landing).count() == 4


def test_backfill_months_cross_the_year():
    assert trips.last_months(dt.date(2024, 2, 15)) == ["2023-11", "2023-12", "2024-01"]
    assert trips.last_months(dt.date(2024, 1, 1), 1) == ["2023-12"]
    assert trips.months_between("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]


def test_new_column_in_a_later_month(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    spark.sql("SELECT 'R1' AS ride_id, timestamp'2024-01-02' AS started_at, '2024' AS year, '01' AS month").write.partitionBy("year", "month").parquet(landing)
    trips.load_months(spark, landing, raw, ["2024-01"])
    spark.sql("SELECT 'R2' AS ride_id, 5.0D AS fare, '2024-02' AS started_month").write.mode("append").partitionBy("started_month").parquet(raw)
    table = trips.read_raw(spark, raw)
    assert {"ride_id", "fare", "member_casual"} <= set(table.columns)
    assert rows(table, "ride_id", "fare") == [("R1", None), ("R2", 5.0)]


def test_weather_arrays(spark):
    body = {"daily": {"time": ["2024-01-15", "2024-01-16"], "temperature_2m_max": [1.0, None], "weather_code": [3, 61]}}
    responses = spark.createDataFrame([(json.dumps(body),), (json.dumps({"daily": {"time": []}}),), ("{}",)], "body string")
    parsed = weather.parse_weather(responses, "body", NOW)
    assert rows(parsed, F.col("weather_date").cast("string"), "temperature_max", "weather_code", "rain_sum") == [
        ("2024-01-15", 1.0, 3, None),
        ("2024-01-16", None, 61, None),
    ]


def poll(*stations, at=1705312800):
    return json.dumps({"last_updated": at, "data": {"stations": list(stations)}})


FULL = {"station_id": "a", "num_bikes_available": 3, "is_renting": 1, "last_reported": 1705312790, "eightd": {"has_available_keys": True}}


def test_status_defaults_and_rejects(spark):
    bodies = [poll(FULL, {"station_id": "b", "last_reported": 1577836800}, {"station_id": "c"}, {"last_reported": 86400}), poll(), "{}"]
    polls = spark.createDataFrame([(b,) for b in bodies], "value string")
    parsed = status.parse_stations(polls, "value", utc(NOW))
    good = {r.station_id: r for r in status.accepted(parsed).collect()}
    assert set(good) == {"a", "b"}
    assert (good["b"].num_bikes_available, good["b"].legacy_id, good["b"].eightd_has_available_keys) == (0, "", False)
    assert good["a"].eightd_has_available_keys
    assert rows(status.rejected(parsed), "station_id", "timestamp") == [("c", 0), ("unknown", 86400)]
    message = json.loads(status.to_messages(status.accepted(parsed).where("station_id = 'a'")).first().value)
    station = json.loads(message["data"])
    assert station["last_reported"] == "2024-01-15T09:59:50Z" and station["num_docks_available"] == 0


def test_observed_metrics(spark):
    polls = spark.createDataFrame([(poll(FULL, {"station_id": "c"}),)], "value string")
    observed, metrics = monitor.observed_parse(polls, "value", utc(NOW))
    observed.write.format("noop").mode("overwrite").save()
    assert metrics.get == {"fetched": 2, "published": 1, "skipped": 1}


def test_refresh_of_a_day_reads_that_day_alone(spark, sf_dir, tmp_path):
    from ridelake.plans import refresh

    feeds = event_feeds(spark, sf_dir)
    late = Feeds(
        trips=feeds.trips.where("started_at >= '2024-01-25' AND started_at < '2024-01-26' AND ended_at < '2024-01-26'"),
        weather=feeds.weather.limit(0),
        status=feeds.status.limit(0),
    )
    assert refresh.changed_days(late) == [dt.date(2024, 1, 25)]
    assert refresh.changed_days(Feeds(late.trips.limit(0), late.weather, late.status)) == []


def test_defining_views_starts_no_job(spark, sf_dir, tmp_path):
    feeds = event_feeds(spark, sf_dir)
    built = Models(spark, feeds, NOW, str(tmp_path / "w")).build()
    group = "views-are-lazy"
    spark.sparkContext.setJobGroup(group, "views")
    try:
        for view in VIEWS:
            built.table(view)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# --- streams -----------------------------------------------------------------------------------------


def test_stream_restarts_where_it_stopped_and_repeats_cleanly(spark, tmp_path):
    source, table, rejects, ckpt = (str(tmp_path / n) for n in ("in", "out", "bad", "ckpt"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(poll(FULL, {"station_id": "x"}) + "\n")

    def run():
        stream.write_status(stream.read_polls(spark, source), table, rejects, ckpt).awaitTermination()

    run()
    run()  # nothing new
    (tmp_path / "in" / "2.json").write_text(poll({**FULL, "station_id": "b"}) + "\n")
    run()
    assert rows(spark.read.parquet(table), "station_id") == [("a",), ("b",)]
    assert rows(spark.read.parquet(rejects), "station_id", "timestamp") == [("x", 0)]


def test_latest_state_ignores_late_reports(spark, tmp_path):
    source, state, ckpt = (str(tmp_path / n) for n in ("in", "state", "ckpt"))
    (tmp_path / "in").mkdir()
    times = {"1": 1705312790, "2": 1705312999, "3": 1705312800}
    for name, at in times.items():
        (tmp_path / "in" / f"{name}.json").write_text(poll({**FULL, "last_reported": at, "num_bikes_available": int(name)}) + "\n")
        stream.keep_latest(stream.read_polls(spark, source), state, ckpt).awaitTermination()
    assert rows(stream.read_latest(spark, state), "station_id", "num_bikes_available") == [("a", 2)]
    assert len(layout.partition_values(spark, state, "bucket")) == 1


def test_duplicates_across_batches_are_dropped(spark, tmp_path):
    source, table, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    (tmp_path / "in").mkdir()
    for name in ("1", "2"):
        (tmp_path / "in" / f"{name}.json").write_text(poll(FULL) + "\n")
    polls = stream.read_polls(spark, source, files_per_batch=1)
    stream.write_distinct(polls, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 1


def test_archive_keeps_text_as_it_came(spark, tmp_path):
    source, table, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(poll(FULL) + "\n")
    stream.archive_raw(stream.read_polls(spark, source), table, ckpt, "sub").awaitTermination()
    row = spark.read.parquet(table).first()
    assert row.data == poll(FULL) and row.subscription_name == "sub" and row.message_id
    assert json.loads(row.attributes)["file_name"] == "1.json"
    assert row.publish_time == dt.datetime.fromtimestamp(1705312800)


def test_files_of_polls_are_read_line_by_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    named = [json.dumps({"message_id": f"m{i}", **json.loads(poll(FULL))}) for i in (1, 2, 2)]
    (tmp_path / "in" / "1.json").write_text("\n".join([*named, poll(FULL), ""]))
    polls = stream.read_polls(spark, str(tmp_path / "in"))
    assert "wholetext -> true" not in polls._jdf.queryExecution().logical().toString().lower()
    table, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    stream.archive_raw(polls, table, ckpt, "sub").awaitTermination()
    ids = [r.message_id for r in spark.read.parquet(table).collect()]
    assert sorted(i for i in ids if i[0] == "m") == ["m1", "m2", "m2"] and len(ids) == 4


def test_files_of_polls_grow_in_number(spark, sf_dir, monkeypatch):
    from ridelake.queries import streams

    few = [spark.read.text(make(spark, sf_dir)).inputFiles() for make in (streams._poll_files, streams._shuffled_files)]
    monkeypatch.setattr(streams, "POLLS_A_FILE", 1)
    many = [spark.read.text(make(spark, sf_dir)).inputFiles() for make in (streams._poll_files, streams._shuffled_files)]
    assert all(len(b) > len(a) for a, b in zip(few, many))


def test_csv_lines_are_streamed_out_in_several_files_a_day(spark, tmp_path):
    from ridelake.queries.ingest import _write_lines

    path = str(tmp_path / "csv")
    lines = spark.range(1000).selectExpr("date'2024-01-01' + cast(id % 2 AS int) AS day", "concat('a', id) AS value")
    _write_lines(lines, "head,er", path, lines_a_file=100)
    files = [p.read_text().splitlines() for p in (tmp_path / "csv").rglob("part-*")]
    assert len(files) == 22 and all(f[0] == "head,er" and "head,er" not in f[1:] for f in files)
    assert sorted(x for f in files for x in f[1:]) == sorted(f"a{i}" for i in range(1000))


def test_freshness_classes(spark):
    empty = spark.createDataFrame([], "t timestamp")
    old = spark.sql("SELECT timestamp'2024-01-28 23:00:00' AS t")
    warm = spark.sql("SELECT timestamp'2024-01-29 23:00:00' AS t")
    report = monitor.source_freshness({"none": (empty, "t"), "old": (old, "t"), "warm": (warm, "t")}, NOW)
    assert rows(report, "source", "status") == [("none", "error"), ("old", "error"), ("warm", "warn")]


def test_every_table_is_in_one_wave():
    assert sorted(name for wave in WAVES for name in wave) == sorted(TABLES)


def test_build_writes_every_stored_table(spark, built):
    stored = [n for n, (layer, _, _) in TABLES.items() if layer != "staging" and n != "int_station_metrics"]
    for name in stored:
        assert spark.read.parquet(built.data_path(name)).count() == built.table(name).count(), name
    assert isinstance(built, Models)
