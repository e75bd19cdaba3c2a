"""Station status as a stream of polls.

Each file (or broker message) is one poll. Sinks write under the folder and the
checkpoint folder the caller names, so a restart continues where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridelake.operators.layout import compact, manifest, read_table, write_table
from ridelake.operators.ranking import latest_per_key
from ridelake.session import staged
from ridelake.sources.status import accepted, parse_stations, rejected, rejected_polls


def read_polls(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Polls from a folder of text files, one JSON document per line; files are read line by
    line, whatever their size. A message is known by the ``message_id`` written with it, or
    else by its file and a hash of its line, which equal lines of one file share."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.to_json(F.struct("_metadata.file_name", "_metadata.file_size")).alias("attributes"),
    )
    own = F.get_json_object("value", "$.message_id")
    message = F.coalesce(own, F.concat_ws("#", "file", F.sha2("value", 256)))
    return lines.where("value <> ''").select("value", message.alias("message_id"), "attributes")


def stations(polls: DataFrame, keep: list[str] = ()) -> DataFrame:
    return parse_stations(polls, "value", F.current_timestamp(), keep)


def write_status(
    polls: DataFrame,
    table: str,
    rejects: str,
    checkpoint: str,
    trigger: dict | None = None,
    subscription: str = "station-status",
) -> StreamingQuery:
    """Parse each micro-batch once, and write reports, with the delivery they came in, and
    rejects to their tables. Delivery is at least once, the tables hold each batch once.

    Rejects are stations without a usable report time, with the time they gave, and messages
    that hold no stations, with their text; both with a reason.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged(batch, "messages") as messages, staged(stations(messages, ["message_id", "attributes"]), "polls") as parsed:
            good = accepted(parsed).withColumns(
                {
                    "subscription_name": F.lit(subscription),
                    "publish_time": F.col("api_last_updated"),
                    "reported_on": F.to_date("last_reported"),
                }
            )
            late = rejected(parsed, ["message_id"]).withColumn("reason", F.lit("no report time"))
            broken = rejected_polls(messages, "value", ["message_id"])
            write_table(good, table, "reported_on", mode="append", batch=(checkpoint, batch_id))
            bad = late.unionByName(broken, allowMissingColumns=True)
            write_table(bad, rejects, mode="append", batch=(checkpoint, batch_id))

    return _each_batch(polls, write, checkpoint, trigger)


def compact_days(spark: SparkSession, table: str, days: list[str]) -> None:
    """Bring the files of all batches of the given, finished days together."""
    compact(spark, table, days)


def _each_batch(polls: DataFrame, write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        polls.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def archive_raw(polls: DataFrame, table: str, checkpoint: str, subscription: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep every message as it came, with its delivery metadata, by day of publishing."""
    rows = polls.select(
        F.col("value").alias("data"),
        F.lit(subscription).alias("subscription_name"),
        "message_id",
        "attributes",
        F.timestamp_seconds(F.get_json_object("value", "$.last_updated").cast("long")).alias("publish_time"),
        F.current_timestamp().alias("ingestion_timestamp"),
    ).withColumn("published_on", F.to_date("publish_time"))
    return (
        rows.writeStream.format("parquet")
        .partitionBy("published_on")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


REPORT = ["station_id", "last_reported"]


def _preference(reports: DataFrame) -> Column:
    """Which of several reports of a station and second stays: the one polled last, then the
    one with the highest values. Equal for equal reports, whenever they were ingested."""
    rest = [c for c in reports.columns if c not in (*REPORT, "api_last_updated", "ingestion_timestamp", "reported_on")]
    first = ["api_last_updated", "num_bikes_available", "num_docks_available"]
    return F.struct(*first, *sorted(set(rest).difference(first)))


def write_distinct(polls: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Accepted reports, each (station, report time) once, however late or often it comes;
    ``read_distinct`` gives them.

    A batch adds the reports that are preferred to those written so far for the days it
    touches. So nothing is held as state, no row is too late, and neither the order of files
    nor their batches decide which of two reports stays.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        reports = accepted(stations(batch))
        fresh = latest_per_key(reports, REPORT, [_preference(reports).desc()])
        with staged(fresh.withColumn("reported_on", F.to_date("last_reported")), "reports") as reports:
            if manifest(spark, table):
                days = [r[0] for r in reports.select("reported_on").distinct().collect()]  # one per day
                written = read_table(spark, table).where(F.col("reported_on").isin(days))
                kept = written.select(*[F.col(c).alias(f"_{c}") for c in ("reported_on", *REPORT)], _preference(written).alias("_best"))
                same = [F.col(c) == F.col(f"_{c}") for c in ("reported_on", *REPORT)]
                reports = reports.join(kept, [*same, F.col("_best") >= _preference(reports)], "left_anti")
            write_table(reports, table, "reported_on", mode="append", batch=(checkpoint, batch_id))

    return _each_batch(polls, write, checkpoint, trigger)


def read_distinct(spark: SparkSession, table: str) -> DataFrame:
    """The preferred report of each (station, report time); a report that a better one
    followed is still in the files of its batch."""
    reports = read_table(spark, table)
    return latest_per_key(reports, ["reported_on", *REPORT], [_preference(reports).desc()]).drop("reported_on")


def _published_on(polls: DataFrame) -> DataFrame:
    at = F.timestamp_seconds(F.try_to_number(F.get_json_object("value", "$.last_updated"), F.lit("9999999999")).cast("long"))
    return polls.withColumn("day", F.coalesce(F.to_date(at), F.lit("1970-01-01").cast("date")))


def write_windows(
    polls: DataFrame, table: str, checkpoint: str, late: str = "1 day", trigger: dict | None = None, ledger: str | None = None
) -> StreamingQuery:
    """Sums of each batch per station and five-minute window; ``read_windows`` adds them up.

    Sums do not depend on the order of batches, so late reports count in their windows and
    windows of the last day are there. Reports later than ``late`` are counted beside.

    A message counts once, however often it is delivered: the ids of those counted are kept
    in a ledger by day of publishing, which a batch is checked against for its own days. The
    ledger is written after the sums, and either skips a batch it already has, so a batch
    that is interrupted and repeated counts once as well. Days beyond the time in which a
    message may come again can be expired from the ledger.
    """
    ledger = ledger or f"{table}_messages"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, this = batch.sparkSession, (checkpoint, batch_id)
        once = latest_per_key(_published_on(batch).select("day", "message_id", "value"), ["message_id"], [F.desc("value")])
        with staged(once, "messages") as messages:
            if manifest(spark, ledger):
                days = [r[0] for r in messages.select("day").distinct().collect()]  # one per day
                counted = read_table(spark, ledger).where(F.col("day").isin(days))
                messages = messages.join(counted, ["day", "message_id"], "left_anti")
            reports = accepted(stations(messages))
            is_late = F.col("api_last_updated") - F.expr(f"interval {late}") > F.col("last_reported")
            sums = reports.groupBy("station_id", F.window("last_reported", "5 minutes").alias("w")).agg(
                F.count("*").alias("reports"),
                F.sum("num_bikes_available").alias("bikes"),
                F.count_if(is_late).alias("late_reports"),
            )
            sums = sums.select("station_id", F.col("w.start").alias("bucket_start"), "reports", "bikes", "late_reports")
            write_table(sums.withColumn("day", F.to_date("bucket_start")), table, "day", mode="append", batch=this)
            write_table(messages.select("message_id", "day"), ledger, "day", mode="append", batch=this)

    return _each_batch(polls, write, checkpoint, trigger)


def read_windows(spark: SparkSession, table: str) -> DataFrame:
    """Reports per station and five-minute window over all batches so far."""
    sums = read_table(spark, table).groupBy("station_id", "bucket_start")
    return sums.agg(
        F.sum("reports").alias("reports"),
        (F.sum("bikes") / F.sum("reports")).alias("avg_bikes"),
        F.sum("late_reports").alias("late_reports"),
    )


STATE_BUCKETS = 64


def keep_latest(
    polls: DataFrame, state: str, checkpoint: str, trigger: dict | None = None, buckets: int = STATE_BUCKETS
) -> StreamingQuery:
    """The latest report of every station, in buckets by a hash of the station.

    A batch reads and replaces the buckets of its own stations alone. Late reports lose to
    newer ones, and a repeated batch changes nothing. ``buckets`` is fixed by the first batch.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        order = [F.desc("last_reported"), F.desc("api_last_updated")]
        bucket = F.pmod(F.xxhash64("station_id"), F.lit(buckets)).cast("int")
        with staged(latest_per_key(accepted(stations(batch)), ["station_id"], order).withColumn("bucket", bucket), "latest") as fresh:
            newest = fresh
            if manifest(spark, state):
                touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
                before = read_table(spark, state).where(F.col("bucket").isin(touched))
                newest = latest_per_key(fresh.unionByName(before), ["station_id"], order)
            write_table(newest, state, "bucket", batch=(checkpoint, batch_id))

    return _each_batch(polls, update, checkpoint, trigger)


def read_latest(spark: SparkSession, state: str) -> DataFrame:
    """The table that ``keep_latest`` maintains."""
    return read_table(spark, state).drop("bucket")
