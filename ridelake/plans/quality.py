"""Data-quality assertions, declared as data and run table by table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake import rules
from ridelake.functions.calendar import date_key

RESULT = "table_name STRING, check_name STRING, target STRING, failures BIGINT, status STRING"

# Declared assertions on the models.
NOT_NULL = {
    "stg_trips": ["ride_id", "rideable_type", "started_at", "ended_at", "member_casual"],
    "stg_weather": ["weather_date"],
    "stg_station_status": ["station_id", "last_reported", "ingestion_timestamp"],
    "int_station_metrics": ["station_id", "reported_at_5min", "total_capacity"],
    "int_station_daily_metrics": ["station_id", "date_day"],
    "int_trip_station_daily": ["station_id", "date_day"],
    "int_station_weather_daily": ["station_id", "date_day"],
    "int_station_daily_fact": ["station_id", "date_day"],
    "dim_date": ["date_key", "full_date"],
    "dim_user_type": ["user_type_key", "user_type_id", "user_type_name"],
    "dim_time": ["time_key", "hour"],
    "dim_station": ["station_key", "station_id", "is_active", "is_current"],
    "fct_trips": [
        "trip_key",
        "trip_id",
        "start_station_key",
        "end_station_key",
        "start_date_key",
        "end_date_key",
        "start_hour_key",
        "end_hour_key",
        "user_type_key",
        "started_at",
        "ended_at",
        "trip_duration_minutes",
    ],
    "fct_station_day": ["station_key", "date_key", "trips_started", "trips_ended"],
}
UNIQUE = {
    "stg_trips": [["ride_id"]],
    "stg_weather": [["weather_date"]],
    "dim_date": [["date_key"]],
    "dim_user_type": [["user_type_key"], ["user_type_id"]],
    "dim_time": [["time_key"]],
    "dim_station": [["station_key"]],
    "fct_trips": [["trip_key"]],
}
UNIQUE_TOGETHER = {
    "int_station_daily_metrics": [["station_id", "date_day"]],
    "int_trip_station_daily": [["station_id", "date_day"]],
    "int_station_weather_daily": [["station_id", "date_day"]],
    "int_station_daily_fact": [["station_id", "date_day"]],
    "fct_station_day": [["station_key", "date_key"]],
}
ACCEPTED = {
    "stg_trips": {
        "rideable_type": ["classic_bike", "electric_bike"],
        "member_casual": ["member", "casual"],
    },
    "dim_user_type": {"user_type_id": ["member", "casual", "unknown"]},
    "dim_time": {"time_bucket": list(rules.TIME_BUCKETS)},
    "dim_station": {
        "borough": [
            "Bronx",
            "Brooklyn",
            "Manhattan",
            "Queens",
            "Staten Island",
            "Upper Manhattan",
            "Midtown Manhattan",
            "Lower Manhattan",
            "Unknown",
        ],
        "station_size": ["micro", "small", "medium", "large", "unknown"],
    },
    "fct_trips": {"bike_type": ["electric_bike", "classic_bike"]},
    "fct_station_day": {
        "station_flow_pattern": ["net_source", "net_sink", "balanced", "inactive"],
        "demand_trend": ["surge", "above_average", "stable", "below_average", "decline"],
    },
}
# (table, foreign key, dimension, its key)
RELATIONSHIPS = [
    ("fct_trips", "start_station_key", "dim_station", "station_key"),
    ("fct_trips", "end_station_key", "dim_station", "station_key"),
    ("fct_trips", "start_date_key", "dim_date", "date_key"),
    ("fct_trips", "start_hour_key", "dim_time", "time_key"),
    ("fct_trips", "user_type_key", "dim_user_type", "user_type_key"),
    ("fct_station_day", "station_key", "dim_station", "station_key"),
    ("fct_station_day", "date_key", "dim_date", "date_key"),
]


def expressions() -> dict[str, dict[str, Column]]:
    """Row conditions that must hold; an unknown result counts as a failure."""
    return {
        "dim_date": {"date_key matches full_date": F.col("date_key") == date_key(F.col("full_date"))},
        "dim_station": {
            "unknown station is named": (F.col("station_id") != rules.UNKNOWN_STATION_ID)
            | (F.col("station_name") == "Unknown Station")
        },
        "fct_trips": {
            "trip_duration_minutes >= 0": F.col("trip_duration_minutes") >= 0,
            "trip_duration_seconds >= 0": F.col("trip_duration_seconds") >= 0,
            "started_at < ended_at": F.col("started_at") < F.col("ended_at"),
        },
        "fct_station_day": {
            "trips_started >= 0": F.col("trips_started") >= 0,
            "trips_ended >= 0": F.col("trips_ended") >= 0,
        },
    }


# Keys of the validation run: (table, key columns).
MODEL_KEYS = {
    "stg_trips": ["ride_id"],
    "stg_weather": ["weather_date"],
    "stg_station_status": ["station_id", "last_reported"],
    "int_station_metrics": ["station_id", "reported_at_5min"],
    "int_station_daily_metrics": ["station_id", "date_day"],
    "int_trip_station_daily": ["station_id", "date_day"],
    "int_station_weather_daily": ["station_id", "date_day"],
    "int_station_daily_fact": ["station_id", "date_day"],
    "dim_date": ["date_key"],
    "dim_station": ["station_key"],
    "dim_time": ["time_key"],
    "dim_user_type": ["user_type_key"],
    "fct_trips": ["trip_key"],
    "fct_station_day": ["station_key", "date_key"],
}
VALIDATED_RELATIONSHIPS = [r for r in RELATIONSHIPS if r[1] != "start_hour_key"]
VALIDATED_NOT_NULL = {
    "fct_trips": [
        "trip_key",
        "start_station_key",
        "end_station_key",
        "start_date_key",
        "user_type_key",
    ],
    "fct_station_day": ["station_key", "date_key"],
}

Tables = Callable[[str], DataFrame]


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _verdict(failures: Column, otherwise: str = "FAIL") -> Column:
    return F.when(failures == 0, "PASS").otherwise(otherwise)


def _conditions(table: str, df: DataFrame, check: str, failing: dict[str, Column]) -> DataFrame:
    """Count the rows failing each condition: one pass over the table for all of them."""
    names = list(failing)
    counts = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(failing.values())])
    entries = [
        F.struct(F.lit(name).alias("target"), F.col(f"c{i}").alias("failures"))
        for i, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*entries))).select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        "target",
        "failures",
        _verdict(F.col("failures")).alias("status"),
    )


def not_null(tables: Tables, declared: dict[str, list[str]] = NOT_NULL) -> DataFrame:
    return _stack(
        [
            _conditions(t, tables(t), "not_null", {c: F.col(c).isNull() for c in columns})
            for t, columns in declared.items()
        ]
    )


def accepted_values(tables: Tables) -> DataFrame:
    """Values outside the declared list; null is accepted."""
    return _stack(
        [
            _conditions(
                t, tables(t), "accepted_values", {c: ~F.col(c).isin(v) for c, v in columns.items()}
            )
            for t, columns in ACCEPTED.items()
        ]
    )


def expression_is_true(tables: Tables) -> DataFrame:
    return _stack(
        [
            _conditions(
                t,
                tables(t),
                "expression",
                {name: ~F.coalesce(holds, F.lit(False)) for name, holds in checks.items()},
            )
            for t, checks in expressions().items()
        ]
    )


def _repeated_keys(table: str, df: DataFrame, check: str, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once, nulls aside."""
    known = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)) if check == "unique" else df
    repeated = known.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(", ".join(keys)).alias("target"),
        "failures",
        _verdict(F.col("failures")).alias("status"),
    )


def unique(tables: Tables) -> DataFrame:
    return _stack(
        [_repeated_keys(t, tables(t), "unique", k) for t, keys in UNIQUE.items() for k in keys]
    )


def unique_together(tables: Tables) -> DataFrame:
    return _stack(
        [
            _repeated_keys(t, tables(t), "unique_combination", k)
            for t, keys in UNIQUE_TOGETHER.items()
            for k in keys
        ]
    )


def _orphans(tables: Tables, relation: tuple, check: str, null_is_orphan: bool) -> DataFrame:
    table, key, dimension, dimension_key = relation
    # Distinct keys first: the join then sees each key once, however often it is used.
    keys = tables(table).groupBy(key).agg(F.count("*").alias("n"))
    if not null_is_orphan:
        keys = keys.where(F.col(key).isNotNull())
    known = tables(dimension).select(F.col(dimension_key).alias("_key"))
    lost = keys.join(known, F.col(key) == F.col("_key"), "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(f"{key} -> {dimension}.{dimension_key}").alias("target"),
        "failures",
        _verdict(F.col("failures")).alias("status"),
    )


def relationships(tables: Tables) -> DataFrame:
    """Foreign keys without a dimension row; a null key is not checked."""
    return _stack([_orphans(tables, r, "relationship", False) for r in RELATIONSHIPS])


def fk_orphans(tables: Tables) -> DataFrame:
    """The same for the validation run, where a null key is an orphan."""
    return _stack([_orphans(tables, r, "foreign_key", True) for r in VALIDATED_RELATIONSHIPS])


def duplicate_keys(tables: Tables) -> DataFrame:
    """Rows beyond the first of each key, per model; rows with a null key part are not counted."""

    def check(table: str, keys: list[str]) -> DataFrame:
        sizes = tables(table).groupBy(*keys).agg(F.count("*").alias("n"))
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        records = F.coalesce(F.sum("n"), F.lit(0))
        distinct = F.count_if(complete)
        return sizes.agg(records.alias("total_records"), distinct.alias("unique_keys")).select(
            F.lit(table).alias("table_name"),
            F.lit(", ".join(keys)).alias("key_columns"),
            "total_records",
            "unique_keys",
            (F.col("total_records") - F.col("unique_keys")).alias("duplicates"),
            _verdict(F.col("total_records") - F.col("unique_keys")).alias("status"),
        )

    return _stack([check(t, k) for t, k in MODEL_KEYS.items()])


def layer_counts(tables: Tables, layers: tuple[str, ...] = ("stg_trips", "fct_trips")) -> DataFrame:
    """Row counts of the same data in several layers, as one line."""
    counts = _stack(
        [
            tables(t).agg(F.count("*").alias("n")).select(F.lit(t).alias("layer"), "n")
            for t in layers
        ]
    )
    text = F.concat(F.col("layer"), F.lit(": "), F.format_number("n", 0))
    return counts.agg(
        F.array_join(F.sort_array(F.collect_list(text)), " | ").alias("counts"),
        F.when(F.count_distinct("n") == 1, "PASS").otherwise("WARNING").alias("status"),
    ).select(F.lit("trip_counts").alias("check_name"), "counts", "status")


def dimension_checks(tables: Tables) -> DataFrame:
    """Completeness of each dimension in one uniform shape."""

    def row(table: str, records: Column, expected: Column, passed: Callable, otherwise: str) -> DataFrame:
        found = tables(table).agg(records.alias("records"), expected.alias("expected"))
        verdict = F.when(passed(F.col("records"), F.col("expected")), "PASS").otherwise(otherwise)
        return found.select(
            F.lit(table).alias("table_name"),
            "records",
            F.col("expected").cast("long").alias("expected"),
            verdict.alias("status"),
        )

    rows = F.count("*")
    return _stack(
        [
            row(
                "dim_date",
                rows,
                F.datediff(F.max("full_date"), F.min("full_date")) + 1,
                lambda a, b: a == b,
                "WARNING",
            ),
            row("dim_station", rows, F.count_distinct("station_id"), lambda a, b: a >= b, "FAIL"),
            row("dim_time", rows, F.lit(24), lambda a, b: a == b, "FAIL"),
            row("dim_user_type", rows, F.lit(len(rules.USER_TYPES)), lambda a, b: a == b, "FAIL"),
        ]
    )


def null_keys(tables: Tables) -> DataFrame:
    return not_null(tables, VALIDATED_NOT_NULL)


def summary(tables: Tables) -> DataFrame:
    """Passed, failed and warned checks of the whole validation run."""
    statuses = _stack(
        [
            duplicate_keys(tables).select(F.lit("duplicate_keys").alias("section"), "status"),
            fk_orphans(tables).select(F.lit("foreign_keys").alias("section"), "status"),
            dimension_checks(tables).select(F.lit("dimensions").alias("section"), "status"),
            null_keys(tables)
            .groupBy("table_name")
            .agg(F.sum("failures").alias("failures"))
            .select(F.lit("null_keys").alias("section"), _verdict(F.col("failures")).alias("status")),
        ]
    )
    return statuses.groupBy("section").agg(
        F.count("*").alias("checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if(F.col("status") == "WARNING").alias("warnings"),
    )


def assert_valid(report: DataFrame) -> None:
    """Raise when the summary holds a failed check."""
    failed = [row["section"] for row in report.where("failed > 0").collect()]  # four rows at most
    if failed:
        raise ValueError(f"validation failed: {', '.join(sorted(failed))}")


def schema_check(spark: SparkSession, tables: Tables, expected: dict[str, dict[str, str]]) -> DataFrame:
    """Columns whose type differs from the declared one."""
    rows = []
    for table, columns in expected.items():
        actual = dict(tables(table).dtypes)
        for column, declared in columns.items():
            found = actual.get(column, "absent")
            rows.append((table, "schema", column, int(found != declared), "PASS" if found == declared else "FAIL"))
    return spark.createDataFrame(rows, RESULT)
