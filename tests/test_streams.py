"""Sinks that lose and double nothing, and tables whose changes are interrupted."""

import json

import pytest
from pyspark.sql import functions as F

from ridelake.operators import incremental, layout
from ridelake.streaming import status_stream as stream

AT = 1705312800


def station(name="a", at=AT - 10, bikes=3):
    return {"station_id": name, "num_bikes_available": bikes, "is_renting": 1, "last_reported": at}


def poll(*stations, name=None, at=AT):
    named = {"message_id": name} if name else {}
    return json.dumps({**named, "last_updated": at, "data": {"stations": list(stations)}})


@pytest.fixture
def feed(tmp_path):
    (tmp_path / "in").mkdir()

    def add(file, *messages):
        (tmp_path / "in" / f"{file}.json").write_text("".join(m + "\n" for m in messages))
        return str(tmp_path / "in")

    add.path = lambda name: str(tmp_path / name)
    return add


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- tables with a manifest -------------------------------------------------------------------


class Stopped(Exception):
    pass


def days(spark, n, of=4, value=0):
    return spark.range(n).selectExpr("id", f"concat('2024-01-0', 1 + id % {of}) AS day", f"{value} AS v")


def stop_at(monkeypatch, step):
    """Let a change die before its files, before its manifest, or after it."""
    name = {"before the manifest": "commit", "after the manifest": "_delete"}[step]
    monkeypatch.setattr(layout, name, lambda *args, **more: (_ for _ in ()).throw(Stopped()))


def grown(spark, path):
    """A table of several batches whose first day has been brought together before."""
    for i in range(3):
        layout.write_table(days(spark, 20, value=i), path, "day", mode="append", batch=("s", i))
    layout.compact(spark, path, ["2024-01-01"])
    layout.write_table(days(spark, 20, value=3), path, "day", mode="append", batch=("s", 3))


@pytest.mark.parametrize("step", ["before the manifest", "after the manifest"])
def test_interrupted_compaction_keeps_all_rows_once(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    grown(spark, path)
    before = rows(layout.read_table(spark, path), "id", "day", "v")
    for _ in range(2):  # also when the repeat dies
        with monkeypatch.context() as m, pytest.raises(Stopped):
            stop_at(m, step)
            layout.compact(spark, path, ["2024-01-01", "2024-01-02"])
            if step == "after the manifest":
                layout.compact(spark, path, ["2024-01-03"])
        assert rows(layout.read_table(spark, path), "id", "day", "v") == before
    layout.compact(spark, path, ["2024-01-01", "2024-01-02"])
    layout.compact(spark, path, ["2024-01-03", "2024-01-04"])
    assert rows(layout.read_table(spark, path), "id", "day", "v") == before
    assert len(layout.manifest(spark, path).folders) == 4
    layout.vacuum(spark, path)
    assert rows(layout.read_table(spark, path), "id", "day", "v") == before
    assert layout.vacuum(spark, path) == 0


@pytest.mark.parametrize("step", ["before the manifest", "after the manifest"])
def test_interrupted_upsert_and_replacement(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    start = days(spark, 12)
    layout.write_table(start, path, "day")
    changes = spark.createDataFrame([(1, "2024-01-04", 9), (50, "2024-01-09", 9)], start.schema)
    old = rows(layout.read_table(spark, path), "id", "day", "v")
    new = sorted([r for r in old if r[0] != 1] + [(1, "2024-01-04", 9), (50, "2024-01-09", 9)], key=repr)
    with monkeypatch.context() as m, pytest.raises(Stopped):
        stop_at(m, step)
        incremental.upsert(layout.read_table(spark, path), path, changes, ["id"], "day")
        incremental.upsert(layout.read_table(spark, path), path, changes, ["id"], "day")
    assert rows(layout.read_table(spark, path), "id", "day", "v") == (old if step == "before the manifest" else new)
    incremental.upsert(layout.read_table(spark, path), path, changes, ["id"], "day")
    assert rows(layout.read_table(spark, path), "id", "day", "v") == new
    layout.write_table(start.where("id < 2"), path, "day", whole=True)
    assert rows(layout.read_table(spark, path), "id") == [(0,), (1,)]


def test_a_failing_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.write_table(days(spark, 12), path, "day")
    broken = days(spark, 12).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        layout.write_table(broken, path, "day")
    assert layout.read_table(spark, path).count() == 12


def test_readers_keep_the_state_they_opened_for_one_change(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.write_table(days(spark, 8), path, "day")
    opened = layout.read_table(spark, path)
    layout.write_table(days(spark, 8, value=1), path, "day")
    assert {r.v for r in opened.collect()} == {0} and {r.v for r in layout.read_table(spark, path).collect()} == {1}


def test_two_writers_cannot_both_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.write_table(days(spark, 8), path, "day")
    state = layout.manifest(spark, path)
    with pytest.raises(RuntimeError, match="another job"):
        layout.commit(spark, path, state)


def test_dropped_and_empty_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.write_table(days(spark, 8), path, "day")
    layout.write_table(days(spark, 1, value=5), path, "day", drop=["2024-01-02", "2024-02-09"])
    assert rows(layout.read_table(spark, path), "id", "v") == [(0, 5), (2, 0), (3, 0), (6, 0), (7, 0)]
    layout.drop_partitions(spark, path, "day", ["2024-01-01", "2024-01-03", "2024-01-04"])
    empty = layout.read_table(spark, path)
    assert empty.count() == 0 and empty.columns == ["id", "day", "v"]


# --- status stream -------------------------------------------------------------------------------


def test_messages_that_do_not_parse_are_rejected_with_their_text(spark, feed):
    cut = poll(station())[:40]
    source = feed("1", poll(station(), station("x", at=5), name="m1"), cut, poll(name="m2"), "{}")
    table, rejects = feed.path("t"), feed.path("r")
    for _ in range(2):
        stream.write_status(stream.read_polls(spark, source), table, rejects, feed.path("ckpt")).awaitTermination()
    assert rows(layout.read_table(spark, table), "station_id", "message_id") == [("a", "m1")]
    bad = layout.read_table(spark, rejects)
    assert rows(bad.where("document IS NULL"), "station_id", "timestamp", "message_id", "reason") == [("x", 5, "m1", "no report time")]
    assert rows(bad.where("document IS NOT NULL"), "document", "reason") == sorted([(cut, "not JSON"), (poll(name="m2"), "no stations"), ("{}", "no stations")], key=repr)


def interrupted(monkeypatch, module, nth):
    """Let the ``nth`` table write of a batch die."""
    calls, write = [0], module.write_table

    def dying(*args, **more):
        calls[0] += 1
        if calls[0] == nth:
            raise Stopped()
        return write(*args, **more)

    monkeypatch.setattr(module, "write_table", dying)


def test_a_batch_that_dies_between_its_two_tables_is_written_once(spark, feed, monkeypatch):
    source = feed("1", poll(station(), name="m1"), "{")
    table, rejects = feed.path("t"), feed.path("r")

    def run():
        stream.write_status(stream.read_polls(spark, source), table, rejects, feed.path("ckpt")).awaitTermination()

    with monkeypatch.context() as m, pytest.raises(Exception):
        interrupted(m, stream, 2)
        run()
    run()
    assert layout.read_table(spark, table).count() == 1 and layout.read_table(spark, rejects).count() == 1


@pytest.mark.parametrize("dies_at", [None, 1, 2])
def test_windows_count_a_message_once(spark, feed, monkeypatch, dies_at):
    first, second = poll(station(), station("b"), name="m1"), poll(station(bikes=9), name="m2")
    table, ckpt = feed.path("w"), feed.path("ckpt")

    def run():
        stream.write_windows(stream.read_polls(spark, feed.path("in"), 1), table, ckpt).awaitTermination()

    feed("1", first, first)
    run()
    feed("2", second, first, poll(station("c", at=AT - 86400 * 3), at=AT - 86400 * 3, name="m0"))
    if dies_at:
        with monkeypatch.context() as m, pytest.raises(Exception):
            interrupted(m, stream, dies_at)
            run()
    run()
    feed("3", second, second)
    run()
    got = stream.read_windows(spark, table).groupBy("station_id").agg(F.sum("reports").alias("n"), F.sum("avg_bikes").alias("b"))
    assert rows(got, "station_id", "n", "b") == [("a", 2, 6.0), ("b", 1, 3.0), ("c", 1, 3.0)]


def test_one_rule_for_two_reports_whatever_the_batches(spark, feed):
    polls = [poll(station(bikes=4), name="m1"), poll(station(bikes=7), name="m2"), poll(station(bikes=5), name="m3", at=AT + 300)]
    results = []
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        run = "".join(map(str, order))
        for i, k in enumerate(order):
            feed(f"{run}-{i}", polls[k])
            source = stream.read_polls(spark, feed.path("in"), 1).where(F.col("attributes").contains(f'"{run}-'))
            stream.write_distinct(source, feed.path(f"t{run}"), feed.path(f"ckpt{run}")).awaitTermination()
        results.append(rows(stream.read_distinct(spark, feed.path(f"t{run}")), "station_id", "num_bikes_available"))
    assert results == [[("a", 5)]] * 3


def test_untouched_buckets_keep_their_files(spark, feed):
    state, ckpt = feed.path("s"), feed.path("ckpt")

    def run():
        stream.keep_latest(stream.read_polls(spark, feed.path("in")), state, ckpt).awaitTermination()
        return {f.split("/")[0]: f for f in layout.manifest(spark, state).folders}

    feed("1", poll(*[station(f"s{i}") for i in range(200)]))
    before = run()
    feed("2", poll(station("s7", bikes=9, at=AT), station("s8", bikes=9, at=AT - 1000)))
    after = run()
    changed = {b for b in after if after[b] != before[b]}
    assert set(before) == set(after) and 1 <= len(changed) <= 2 < len(before)
    got = dict(rows(stream.read_latest(spark, state), "station_id", "num_bikes_available"))
    assert len(got) == 200 and got["s7"] == 9 and got["s8"] == 3
