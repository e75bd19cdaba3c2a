"""The model graph over a set of feeds, lazily or written layer by layer."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.layout import current_path, read_table, replace_table, write_table
from ridelake.operators.scd2 import first_snapshot
from ridelake.plans import daily, demand, dimensions, facts, staging, supply, views
from ridelake.session import configure, stage
from ridelake.sources.feeds import Feeds

# Layer, partition column and cluster keys of each table, in build order.
TABLES: dict[str, tuple[str, str | None, list[str]]] = {
    "stg_trips": ("staging", None, []),
    "stg_weather": ("staging", None, []),
    "stg_station_status": ("staging", None, []),
    "int_station_metrics": ("intermediate", None, []),
    "int_station_daily_metrics": ("intermediate", "date_day", ["station_id"]),
    "int_trip_station_daily": ("intermediate", "date_day", ["station_id"]),
    "int_station_weather_daily": ("intermediate", "date_day", ["station_id"]),
    "int_station_daily_fact": ("intermediate", "date_day", ["station_id"]),
    "snap_station": ("snapshots", None, []),
    "dim_station": ("marts", None, []),
    "dim_date": ("marts", None, []),
    "dim_time": ("marts", None, []),
    "dim_user_type": ("marts", None, []),
    "fct_trips": ("marts", "start_date_key", ["start_station_key", "user_type_key"]),
    "fct_station_day": ("marts", "date_day", ["station_key"]),
}
# What can be written at the same time, in dependency order.
WAVES = [
    ["stg_trips"],
    ["stg_weather"],
    ["stg_station_status"],
    ["int_station_metrics"],
    ["int_station_daily_metrics", "int_trip_station_daily", "snap_station", "dim_time", "dim_user_type"],
    ["int_station_weather_daily", "dim_station"],
    ["int_station_daily_fact", "fct_trips"],
    ["dim_date", "fct_station_day"],
]
VIEWS = [
    "vw_station_operations",
    "vw_station_operations_realtime",
    "vw_trip_analytics_daily",
    "vw_trip_analytics_routes",
    "vw_weather_impact",
]


class Models:
    """Every model, as a DataFrame defined on first use.

    Without a ``root`` the models stay one lazy plan over the feeds; only the two
    tables that later joins look up (weather and stations) are staged, so that
    their real size decides the join. With a ``root`` each table is written there,
    in its layer, and read back by what comes after it.
    """

    def __init__(self, spark: SparkSession, feeds: Feeds, now: dt.datetime, root: str | None = None):
        self.spark = configure(spark)
        self.feeds = feeds
        self.now = now
        self.as_of = now.date()
        self.root = root

    @classmethod
    def opened(cls, spark: SparkSession, feeds: Feeds, now: dt.datetime, root: str) -> Models:
        """The tables written under ``root`` by an earlier run. Nothing is worked out again."""
        models = cls(spark, feeds, now, root)
        stored = [n for n, (layer, _, _) in TABLES.items() if layer != "staging" and n != "int_station_metrics"]
        with ThreadPoolExecutor(8) as pool:  # most of the time goes to listing files
            list(pool.map(models.reopen, [*stored, "station_counts"]))
        return models

    def reopen(self, name: str) -> DataFrame:
        """The table as it is stored now; later uses of the model see it."""
        self.__dict__[name] = read_table(self.spark, self.data_path(name))
        return self.__dict__[name]

    def path(self, name: str) -> str:
        layer = TABLES[name][0] if name in TABLES else "state"
        return f"{self.root}/{layer}/{name}"

    def data_path(self, name: str) -> str:
        """Folder of the files: tables without partitions are replaced as a whole, and
        lie in a folder for each version."""
        return current_path(self.spark, self.path(name))

    def _keep(self, name: str, df: DataFrame, small: bool = False) -> DataFrame:
        if self.root is None:
            return stage(df, name) if small else df
        layer, partition_by, cluster_by = TABLES[name]
        if layer == "staging":  # views over the raw tables
            return df
        if partition_by:
            write_table(df, self.path(name), partition_by, cluster_by, whole=True)
        else:
            replace_table(df, self.path(name))
        return read_table(self.spark, self.data_path(name), df)

    @cached_property
    def stg_trips(self) -> DataFrame:
        return self._keep("stg_trips", staging.stg_trips(self.feeds.trips))

    @cached_property
    def stg_weather(self) -> DataFrame:
        return self._keep("stg_weather", staging.stg_weather(self.feeds.weather))

    @cached_property
    def weather_days(self) -> DataFrame:
        """Weather as a stored table, for lookups."""
        return stage(self.stg_weather, "weather_days")

    @cached_property
    def stg_station_status(self) -> DataFrame:
        return self._keep("stg_station_status", staging.stg_station_status(self.feeds.status))

    @cached_property
    def int_station_metrics(self) -> DataFrame:
        # A view in every mode: it is as large as the raw status and only adds columns.
        return supply.station_metrics(self.stg_station_status)

    @cached_property
    def int_station_daily_metrics(self) -> DataFrame:
        return self._keep("int_station_daily_metrics", supply.station_daily(self.int_station_metrics))

    @cached_property
    def int_trip_station_daily(self) -> DataFrame:
        return self._keep("int_trip_station_daily", demand.demand_daily(self.stg_trips))

    @cached_property
    def int_station_weather_daily(self) -> DataFrame:
        joined = supply.with_weather(self.int_station_daily_metrics, self.weather_days)
        return self._keep("int_station_weather_daily", joined)

    @cached_property
    def int_station_daily_fact(self) -> DataFrame:
        fact = daily.station_daily_fact(self.int_station_weather_daily, self.int_trip_station_daily)
        return self._keep("int_station_daily_fact", fact)

    @cached_property
    def station_counts(self) -> DataFrame:
        """Names and places of stations so far, counted by month. Kept, so that a refresh adds
        those of new trips instead of reading all trips again."""
        counts = dimensions.station_counts(self.stg_trips)
        if self.root is None:
            return counts
        write_table(counts, self.path("station_counts"), "month", ["station_id"], whole=True)
        return read_table(self.spark, self.path("station_counts"), counts)

    @cached_property
    def snap_station(self) -> DataFrame:
        master = dimensions.master_of(self.station_counts, self.now)
        return self._keep("snap_station", first_snapshot(master, "station_id"))

    @cached_property
    def dim_station(self) -> DataFrame:
        return self._keep("dim_station", dimensions.dim_station(self.snap_station, self.now), small=True)

    @cached_property
    def date_bounds(self) -> DataFrame:
        """Span of the station-day fact. From the written fact where there is one;
        otherwise from the inputs it keeps every row of, which saves the join."""
        if self.root is not None:
            return dimensions.date_bounds(self.int_station_daily_fact)
        reports = self.stg_station_status.where("is_installed")
        return dimensions.date_bounds(
            reports.select(F.to_date("last_reported").alias("date_day")),
            staging.trip_ends(self.stg_trips, []).select(F.to_date("at").alias("date_day")),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._keep("dim_date", dimensions.dim_date(self.date_bounds, self.as_of, self.now))

    @cached_property
    def dim_time(self) -> DataFrame:
        return self._keep("dim_time", dimensions.dim_time(self.spark, self.now))

    @cached_property
    def dim_user_type(self) -> DataFrame:
        return self._keep("dim_user_type", dimensions.dim_user_type(self.spark, self.now))

    @cached_property
    def fct_trips(self) -> DataFrame:
        fact = facts.fct_trips(self.stg_trips, self.dim_station, self.dim_user_type, self.now)
        return self._keep("fct_trips", fact)

    @cached_property
    def fct_station_day(self) -> DataFrame:
        fact = facts.fct_station_day(self.int_station_daily_fact, self.dim_station, self.now)
        return self._keep("fct_station_day", fact)

    @cached_property
    def vw_station_operations(self) -> DataFrame:
        return views.station_operations(
            self.fct_station_day, self.dim_station, self.dim_date, self.as_of
        )

    @cached_property
    def vw_station_operations_realtime(self) -> DataFrame:
        return views.realtime_status(self.int_station_metrics, self.snap_station, self.now)

    @cached_property
    def vw_trip_analytics_daily(self) -> DataFrame:
        return views.trip_analytics_daily(
            self.fct_trips, self.dim_date, self.dim_time, self.dim_user_type, self.as_of
        )

    @cached_property
    def vw_trip_analytics_routes(self) -> DataFrame:
        return views.routes(self.fct_trips, self.dim_station, self.dim_user_type, self.as_of)

    @cached_property
    def vw_weather_impact(self) -> DataFrame:
        return views.weather_impact(self.fct_station_day, self.dim_date, self.as_of)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def build(self) -> Models:
        """Write every table. Tables of one wave do not need each other, so their jobs
        are submitted together and share the executors."""
        if self.root is None:
            raise ValueError("a root folder is needed to write tables")
        for wave in WAVES:
            with ThreadPoolExecutor(len(wave)) as pool:
                list(pool.map(self.table, wave))
        return self


def materialize_view(view: DataFrame, path: str, partition_by: str, cluster_by: list[str]) -> None:
    """Refresh a stored view: only the days present in ``view`` are replaced."""
    write_table(view, path, partition_by, cluster_by)
