"""Wall time of the headline queries; prints one JSON line.

Every query runs from the raw feeds to a no-op sink: once to compile, then timed.
``build_warehouse`` writes all layers; the ``dashboard_*`` entries read them, as the
dashboards do.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ridelake.plans.build import VIEWS, Models  # noqa: E402
from ridelake.plans.refresh import refresh  # noqa: E402
from ridelake.queries import all_queries  # noqa: E402
from ridelake.session import local_session, stage_path  # noqa: E402
from ridelake.sources.feeds import NOW, Feeds, event_feeds, events  # noqa: E402

HEADLINE = [
    "stg_trips",
    "station_metrics",
    "station_daily",
    "demand_daily",
    "weather_enrich",
    "station_daily_fact",
    "station_master",
    "fct_trips",
    "fct_station_day",
    "station_operations",
    "realtime_status",
    "trip_analytics_daily",
    "routes",
    "weather_impact",
    "pit_join",
    "global_rank",
    "merge_upsert",
    "full_refresh_equals_incremental",
    "land_trips_csv",
    "status_json_to_rows",
    "weather_json_to_rows",
    "stream_status_sink",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = local_session(cores)
    queries = all_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        seconds[f"cold_{name}"] = timed(lambda: drain(queries[name](spark, sf_dir)))
        seconds[name] = timed(lambda: drain(queries[name](spark, sf_dir)))

    if not only or "build_warehouse" in only:
        def build() -> Models:
            root = stage_path(spark, "bench")
            return Models(spark, event_feeds(spark, sf_dir), NOW, root).build()

        build()
        built: list[Models] = []
        seconds["build_warehouse"] = timed(lambda: built.append(build()))
        for view in VIEWS:
            drain(built[0].table(view))
            fresh = Models(spark, built[0].feeds, NOW, built[0].root)
            # The layers written above, with the views planned anew.
            fresh.__dict__.update(
                {k: v for k, v in built[0].__dict__.items() if not k.startswith("vw_")}
            )
            seconds[f"dashboard_{view}"] = timed(lambda: drain(fresh.table(view)))

        # The last day arrives after a build of all days before it.
        feeds = event_feeds(spark, sf_dir)
        late = {"trips": "started_at", "status": "last_reported"}
        since = F.lit(NOW.date())
        split = {k: F.col(c) >= since for k, c in late.items()}
        whole = {"trips": feeds.trips, "weather": feeds.weather, "status": feeds.status}
        early = Feeds(**{k: t.where(~split.get(k, F.lit(False))) for k, t in whole.items()})
        arrived = Feeds(**{k: t.where(split.get(k, F.lit(False))) for k, t in whole.items()})
        roots = [stage_path(spark, "bench") for _ in range(2)]
        for root in roots:
            Models(spark, early, NOW, root).build()
        refresh(spark, feeds, arrived, NOW, roots[0])
        seconds["refresh_one_day"] = timed(lambda: refresh(spark, feeds, arrived, NOW, roots[1]))

    rows = {"land_trips_csv": "rows_per_s_csv", "status_json_to_rows": "rows_per_s_status_json", "weather_json_to_rows": "rows_per_s_weather_json"}
    n = events(spark, sf_dir).count()
    rates = {rate: round(n / seconds[name]) for name, rate in rows.items() if seconds.get(name)}
    cold = {k: seconds.pop(k) for k in list(seconds) if k.startswith("cold_")}
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": cold,
                "rates": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
            }
        )
    )


if __name__ == "__main__":
    main()
