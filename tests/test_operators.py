"""Operators on small tables, against brute force where there is one."""

import datetime as dt
import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridelake.functions.calendar import utc
from ridelake.operators import aggregates, incremental, joins, layout, ranking, scd2, windows
from ridelake.session import stage_path


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    latest = ranking.latest_per_key(df, ["k"], [F.desc("v")])
    assert rows(latest, "k", "v") == [(0, 999), (1, 997), (2, 998)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_number_all_equals_a_plain_window_on_a_skewed_table(spark):
    rng = random.Random(7)
    values = [(i, 1 if rng.random() < 0.4 else rng.randrange(50)) for i in range(500)]
    df = spark.createDataFrame(values, "id long, v long").repartition(7)
    ranked = ranking.number_all(df, [F.desc("v"), F.asc("id")], "rank")
    expected = [
        (i, place) for place, (i, _) in enumerate(sorted(values, key=lambda r: (-r[1], r[0])), 1)
    ]
    assert rows(ranked, "id", "rank") == sorted(expected)


def test_number_all_within_keys_splits_a_hot_key(spark):
    rng = random.Random(11)
    values = [("hot" if rng.random() < 0.6 else rng.choice(["a", None]), rng.randrange(9), i) for i in range(400)]
    df = spark.createDataFrame(values, "k string, v long, id long").repartition(5)
    order = [F.desc("v"), F.asc("id")]
    ranked = ranking.number_all(df, order, "rank", keys=["k"])
    place, expected = Counter(), []
    for k, v, i in sorted(values, key=lambda r: (-r[1], r[2])):
        place[k] += 1
        expected.append((i, place[k]))
    assert rows(ranked, "id", "rank") == sorted(expected)


def test_number_by_leading_key(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("c", 3)], "day string, place long"
    )
    ranked = ranking.number_by_leading_key(df, "day", "place", "overall")
    assert rows(ranked, "overall", "day", "place") == [
        (1, "c", 1),
        (2, "c", 2),
        (3, "c", 3),
        (4, "b", 1),
        (5, "a", 1),
        (6, "a", 2),
    ]


def test_top_k_does_not_sort_everything(spark):
    top = ranking.top_k(spark.range(100), 3, [F.desc("id")])
    assert rows(top, "id") == [(97,), (98,), (99,)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_modal_values_ties_nulls_and_negative_numbers(spark):
    df = spark.createDataFrame(
        [
            ("s", "b", -2.0),
            ("s", "a", -10.0),
            ("s", None, None),
            ("t", None, 1.0),
            ("t", None, 1.0),
            ("t", "z", 2.0),
        ],
        "k string, name string, lat double",
    )
    modes = aggregates.modal_values(df, ["k"], ["name"], ["lat"])
    # Lowest value on ties, a value before null, and null where it is most frequent.
    assert rows(modes, "k", "name", "lat") == [("s", "a", -10.0), ("t", None, 1.0)]


def test_merged_moments_and_slots_equal_direct_aggregates(spark):
    rng = random.Random(3)
    data = [("k", rng.randrange(4), rng.random(), rng.randrange(288)) for _ in range(300)]
    data += [("one", 1, 0.5, 287), ("none", 1, None, 0)]
    df = spark.createDataFrame(data, "k string, part int, v double, slot long")
    masks = aggregates.slot_masks("slot", 288)
    parts = df.groupBy("k", "part").agg(
        *aggregates.sql_columns({"n": "count(v)", "m": "avg(v)", "s": "var_pop(v)", **masks})
    )
    merged = parts.groupBy("k").agg(
        *aggregates.sql_columns(
            {
                "mean": aggregates.merged_mean("n", "m"),
                "dev": aggregates.merged_stddev("n", "m", "s"),
                "slots": aggregates.count_slots(list(masks)),
            }
        )
    )
    found = {r.k: r for r in merged.collect()}
    values = [v for k, _, v, _ in data if k == "k"]
    assert found["k"].mean == pytest.approx(statistics.mean(values))
    assert found["k"].dev == pytest.approx(statistics.stdev(values))
    assert found["k"].slots == len({s for k, _, _, s in data if k == "k"})
    assert (found["one"].mean, found["one"].dev, found["one"].slots) == (0.5, None, 1)
    assert (found["none"].mean, found["none"].dev) == (None, None)


def test_salted_join_equals_the_plain_join(spark):
    large = spark.createDataFrame(
        [(i, "hot" if i % 3 else None if i % 2 else "cold") for i in range(60)], "id long, k string"
    )
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3)], "k string, v long")
    for how in ("left", "inner"):
        salted = joins.salted_join(large, small, ["k"], F.col("id"), 4, how)
        plain = large.join(small, "k", how)
        key = lambda r: tuple((x is None, x) for x in r)
        assert sorted(map(tuple, salted.select("id", "k", "v").collect()), key=key) == sorted(
            map(tuple, plain.select("id", "k", "v").collect()), key=key
        )
    with pytest.raises(ValueError):
        joins.salted_join(large, small, ["k"], F.col("id"), 4, "right")


def test_point_in_time_picks_the_valid_version_only(spark):
    history = spark.sql(
        """SELECT * FROM VALUES
        ('s', 'old', timestamp'2024-01-01', timestamp'2024-01-10'),
        ('s', 'new', timestamp'2024-01-10', NULL) AS h(id, name, f, t)"""
    )
    events = spark.sql(
        """SELECT * FROM VALUES (1, 's', timestamp'2023-12-31'), (2, 's', timestamp'2024-01-09 23:59:59'),
        (3, 's', timestamp'2024-01-10'), (4, 'x', timestamp'2024-01-10') AS e(n, id, at)"""
    )
    placed = joins.point_in_time(events, history, "id", "at", "f", "t")
    assert sorted((r.n, r.name) for r in placed.collect()) == [
        (1, None),
        (2, "old"),
        (3, "new"),
        (4, None),
    ]


def test_trailing_frames_count_rows_over_gaps(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-09"]
    df = spark.createDataFrame([("s", d, float(i)) for i, d in enumerate(days)], "k string, d string, v double")
    out = windows.trailing(df, "k", "d", {"avg2": ("v", 2)}, {"prev": ("v", 1), "back7": ("v", 7)})
    assert [tuple(r)[3:] for r in out.orderBy("d").collect()] == [
        (0.0, None, None),
        (0.5, 0.0, None),
        (1.5, 1.0, None),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# --- incremental ---------------------------------------------------------------------------


def _table(spark, data):
    df = spark.createDataFrame(data, "id long, day date, v long")
    path = stage_path(spark, "t")
    layout.write_table(df, path, "day", ["id"])
    return df, path


D = [dt.date(2024, 1, d) for d in range(1, 6)]


def test_upsert_replaces_moves_and_adds(spark):
    start, path = _table(spark, [(1, D[0], 10), (2, D[0], 20), (3, D[1], 30), (4, D[2], 40)])
    changes = spark.createDataFrame([(1, D[0], 11), (3, D[3], 31), (5, D[4], 50)], "id long, day date, v long")
    target = layout.read_table(spark, path, start)
    touched = incremental.upsert(target, path, changes, ["id"], "day")
    assert touched == ["2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05"]
    assert rows(layout.read_table(spark, path, start), "id", "day", "v") == [
        (1, D[0], 11),
        (2, D[0], 20),
        (3, D[3], 31),
        (4, D[2], 40),
        (5, D[4], 50),
    ]
    # The day trip 3 left is gone, and the untouched day was not rewritten.
    assert layout.partition_values(spark, path, "day") == [str(D[i]) for i in (0, 2, 3, 4)]


def test_upsert_twice_changes_nothing_more(spark):
    start, path = _table(spark, [(1, D[0], 10), (2, D[1], 20)])
    changes = spark.createDataFrame([(2, D[1], 21), (3, D[2], 30)], "id long, day date, v long")
    for _ in range(2):
        incremental.upsert(layout.read_table(spark, path, start), path, changes, ["id"], "day")
    assert rows(layout.read_table(spark, path, start), "id", "v") == [(1, 10), (2, 21), (3, 30)]


def test_upsert_takes_the_first_of_several_changes(spark):
    start, path = _table(spark, [(1, D[0], 10)])
    changes = spark.createDataFrame([(1, D[0], 12), (1, D[0], 15)], "id long, day date, v long")
    target = layout.read_table(spark, path, start)
    incremental.upsert(target, path, changes, ["id"], "day", order=[F.desc("v")])
    assert rows(layout.read_table(spark, path, start), "id", "v") == [(1, 15)]


def test_slice_with_look_back_and_empty_target(spark):
    df = spark.createDataFrame([(i, D[i], i) for i in range(5)], "id long, day date, v long")
    mark = incremental.watermark(df.where("id <= 2"), "day")
    assert rows(incremental.newer_than(df, "day", mark), "id") == [(3,), (4,)]
    assert rows(incremental.newer_than(df, "day", mark, dt.timedelta(days=1)), "id") == [(2,), (3,), (4,)]
    none = incremental.watermark(df.where("false"), "day")
    assert incremental.newer_than(df, "day", none).count() == 5


def test_retention_drops_whole_days(spark):
    start, path = _table(spark, [(i, D[i], i) for i in range(5)])
    dropped = layout.expire_partitions(spark, path, "day", D[4], keep_days=2)
    assert dropped == [str(D[0]), str(D[1])]
    kept = layout.read_table(spark, path, start)
    assert rows(kept, "id") == rows(layout.within_retention(start, "day", D[4], 2), "id") == [(2,), (3,), (4,)]


# --- history ---------------------------------------------------------------------------------

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 10, 20))


def stations(spark, names, at):
    df = spark.createDataFrame(list(names.items()), "id string, name string")
    return df.withColumn("updated_at", utc(at))


def run(history, spark, names, at, **options):
    return scd2.apply_snapshot(history, stations(spark, names, at), "id", ["name"], utc(at), **options)


def versions(history):
    text = lambda c: F.date_format(c, "dd").alias(c)
    found = history.select("id", "name", text("valid_from"), text("valid_to")).collect()
    return sorted(map(tuple, found), key=lambda r: (r[0], r[2]))


def test_snapshot_changes_deletes_and_returns(spark):
    history = scd2.first_snapshot(stations(spark, {"a": "A", "b": "B", "c": None}, T1), "id")
    history = run(history, spark, {"a": "A2", "c": None, "d": "D"}, T2)
    assert versions(history) == [
        ("a", "A", "01", "10"),
        ("a", "A2", "10", None),
        ("b", "B", "01", "10"),
        ("c", None, "01", None),
        ("d", "D", "10", None),
    ]
    # b comes back: a new version, the closed one stays.
    history = run(history, spark, {"a": "A2", "b": "B", "c": None, "d": "D"}, T3)
    assert [v for v in versions(history) if v[0] == "b"] == [("b", "B", "01", "10"), ("b", "B", "20", None)]
    assert history.select("version_id").distinct().count() == history.count()
    open_per_id = Counter(v[0] for v in versions(history) if v[3] is None)
    assert set(open_per_id.values()) == {1}


def test_versions_never_overlap(spark):
    rng = random.Random(5)
    history = scd2.first_snapshot(stations(spark, {"a": "0", "b": "0"}, T1), "id")
    for step, at in enumerate((T2, T3), 1):
        names = {k: str(rng.randrange(step + 1)) for k in "abc" if rng.random() < 0.8}
        history = run(history, spark, names or {"a": "9"}, at)
    spans = defaultdict(list)
    for key, _, start, end in versions(history):
        spans[key].append((start, end))
    for intervals in spans.values():
        for (_, end), (start, _) in zip(intervals, intervals[1:]):
            assert end is not None and end <= start


def test_timestamp_strategy_versions_every_run_and_can_keep_missing(spark):
    history = scd2.first_snapshot(stations(spark, {"a": "A", "b": "B"}, T1), "id")
    again = run(history, spark, {"a": "A"}, T2, strategy="timestamp", close_missing=False)
    assert versions(again) == [("a", "A", "01", "10"), ("a", "A", "10", None), ("b", "B", "01", None)]
    same = run(history, spark, {"a": "A"}, T1, strategy="timestamp", close_missing=False)
    assert versions(same) == versions(history)
    with pytest.raises(ValueError):
        run(history, spark, {"a": "A"}, T2, strategy="guess")


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "table")
    layout.replace_table(spark.range(3), path)
    broken = spark.range(4).selectExpr("raise_error('lost') AS id")
    with pytest.raises(Exception, match="lost"):
        layout.replace_table(broken, path)
    assert spark.read.parquet(layout.current_path(spark, path)).count() == 3
    # A table may be replaced by what is worked out from it.
    for n in (6, 12, 24):
        table = spark.read.parquet(layout.current_path(spark, path))
        layout.replace_table(table.union(table), path)
        assert spark.read.parquet(layout.current_path(spark, path)).count() == n
    assert len(layout.partition_values(spark, path, "version")) == 2


def test_upsert_takes_one_of_repeated_changes(spark, tmp_path):
    path = str(tmp_path / "table")
    start = spark.createDataFrame([(1, "a", 1), (2, "a", 2)], "id int, day string, v int")
    layout.write_table(start, path, "day")
    changes = spark.createDataFrame([(1, "a", 7), (1, "a", 9), (1, "a", 8)], "id int, day string, v int")
    for search_all in (True, False):
        target = layout.read_table(spark, path, start)
        incremental.upsert(target, path, changes, ["id"], "day", search_all=search_all)
        assert sorted(tuple(r) for r in layout.read_table(spark, path, start).collect()) == [(1, "a", 9), (2, "a", 2)]


def test_measured_places_open_no_version_and_moves_do(spark):
    schema = "id string, name string, lat double, updated_at timestamp"

    def at(day, lat):
        return spark.createDataFrame([("s", "S", lat)], "id string, name string, lat double").withColumn("updated_at", F.lit(dt.datetime(2024, 1, day)))

    history = scd2.first_snapshot(at(1, 40.7), "id").select(*schema.replace(",", "").split()[::2], *scd2.VALIDITY)
    for day, lat, versions in ((2, 40.70001, 1), (3, 40.69999, 1), (4, 40.71, 2)):
        history = scd2.apply_snapshot(history, at(day, lat), "id", ["name", "lat"], F.lit(dt.datetime(2024, 1, day)), tolerance={"lat": 0.001})
        assert history.count() == versions


def test_version_lookup_is_open_to_the_left(spark):
    versions = spark.sql(
        """SELECT * FROM VALUES ('s', 1, timestamp_ntz'2024-01-10', timestamp_ntz'2024-01-20'),
           ('s', 2, timestamp_ntz'2024-01-20', null), ('t', 3, timestamp_ntz'2024-01-15', null)
           AS v(id, key, effective_date, end_date)"""
    )
    facts = spark.sql("SELECT * FROM VALUES ('s', timestamp'2023-01-01'), ('s', timestamp'2024-01-20'), ('t', timestamp'2024-01-01'), ('u', timestamp'2024-01-01') AS f(sid, at)")
    found = joins.lookup_version(facts, versions, "id", "sid", F.col("at"), {"key": "k"})
    assert sorted((r.sid, r.at.year, r.k) for r in found.collect()) == [("s", 2023, 1), ("s", 2024, 2), ("t", 2024, 3), ("u", 2024, None)]


def test_stddev_of_large_values_keeps_its_digits(spark):
    """Values near 1e9 in uneven parts, against two passes over all of them."""
    rows = [("g", i % 7, 1e9 + (i * 37 % 101) / 1000) for i in range(500)] + [("one", 0, 5.0), ("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, part int, v double")
    parts = df.groupBy("g", "part").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    got = {r.g: r.dev for r in parts.groupBy("g").agg(F.expr(aggregates.merged_stddev("n", "m", "s")).alias("dev")).collect()}
    values = [Decimal(v) for g, _, v in rows if g == "g"]
    mean = sum(values) / len(values)
    want = float((sum((v - mean) ** 2 for v in values) / (len(values) - 1)).sqrt())
    assert abs(got["g"] - want) < 1e-6 and got["one"] is None and got["none"] is None


def test_numbers_by_levels(spark):
    rows = [(i % 5, f"s{i % 7}" if i % 11 else None, f"e{i % 13}", i) for i in range(700)]
    df = spark.createDataFrame(rows, "n int, a string, b string, c int")
    got = {r.c: r.rank for r in ranking.number_by_levels(df, "n", "a", ["b", "c"], "rank").collect()}
    order = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or "", r[2], r[3]))
    assert got == {r[3]: i for i, r in enumerate(order, 1)}


def test_row_groups_show_clustering(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id % 2 AS day", "md5(cast(id AS string)) AS k", "repeat(md5(cast(id * 7 AS string)), 4) AS rest")
    conf, key = spark._jsc.hadoopConfiguration(), "parquet.block.size"
    conf.set(key, str(200_000))
    try:
        layout.write_table(df, str(tmp_path / "sorted"), "day", ["k"])
        layout.write_table(df, str(tmp_path / "loose"), "day", ["rest"])
    finally:
        conf.unset(key)
    groups = layout.row_groups(spark, str(tmp_path / "sorted"), "k")
    assert groups.count() > 6
    by_day = {r.value: r for r in layout.overlapping(groups).collect()}
    assert {(r.n_rows, r.overlaps) for r in by_day.values()} == {(30_000, 0)}
    ends = {str(r.day): (r.lo, r.hi) for r in df.groupBy("day").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()}
    assert {d: (r.lowest, r.highest) for d, r in by_day.items()} == ends
    assert sum(r.overlaps for r in layout.overlapping(layout.row_groups(spark, str(tmp_path / "loose"), "k")).collect()) > 2
    assert layout.row_groups(spark, str(tmp_path / "sorted"), "k", ["1"]).select("value").distinct().count() == 1
