"""Structured Streaming jobs run to the end of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators import layout
from ridelake.queries.ingest import broken_polls, polls
from ridelake.session import stage_path
from ridelake.sources.feeds import AS_OF
from ridelake.streaming import status_stream as stream


POLLS_A_FILE = 20_000


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls with the number of each written as its message id."""
    numbered = F.concat(F.lit('{"message_id":"'), F.col("poll").cast("string"), F.lit('",'), F.expr("substring(value, 2)"))
    return polls(spark, sf_dir).withColumn("value", numbered)


def _poll_files(spark: SparkSession, sf_dir: str, copies: int = 1) -> str:
    """Polls as JSON lines, in one folder per day and bucket, of which there are more the more
    polls there are; ``copies`` repeats every message."""
    path = stage_path(spark, "polls")
    rows = _messages(spark, sf_dir)
    buckets = 1 + rows.count() * copies // POLLS_A_FILE
    if copies > 1:
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    cut = rows.select("day", F.pmod(F.xxhash64("poll"), F.lit(buckets)).alias("bucket"), "value")
    cut.repartition("day", "bucket").write.partitionBy("day", "bucket").text(path)
    return path


def _shuffled_files(spark: SparkSession, sf_dir: str, copies: int = 1) -> str:
    """Polls as files that each hold messages of all days, and come in several batches."""
    path = stage_path(spark, "polls")
    rows = _messages(spark, sf_dir).select("value", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    files = 24 * (1 + rows.count() // (24 * POLLS_A_FILE))
    rows.repartition(files, F.xxhash64("value", "copy")).select("value").write.text(path)
    return path


METADATA = ["message_id", "attributes", "subscription_name", "publish_time"]


def stream_status_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted reports written by the stream, without the time of ingestion."""
    table, rejects = stage_path(spark, "status"), stage_path(spark, "rejects")
    source = stream.read_polls(spark, _poll_files(spark, sf_dir), files_per_batch=16)
    stream.write_status(source, table, rejects, stage_path(spark, "ckpt")).awaitTermination()
    return layout.read_table(spark, table).drop("ingestion_timestamp", "reported_on", *METADATA)


def stream_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and reports per publish time, from the delivery columns of the sink, after
    its finished days were brought together."""
    table, rejects = stage_path(spark, "status"), stage_path(spark, "rejects")
    source = stream.read_polls(spark, _poll_files(spark, sf_dir), files_per_batch=16)
    stream.write_status(source, table, rejects, stage_path(spark, "ckpt")).awaitTermination()
    days = layout.partition_values(spark, table, "reported_on")
    stream.compact_days(spark, table, days[:-1])
    kept = layout.read_table(spark, table)
    named = kept.where("message_id IS NOT NULL AND attributes IS NOT NULL AND ingestion_timestamp IS NOT NULL")
    return named.groupBy("publish_time", "subscription_name").agg(
        F.count_distinct("message_id").alias("messages"), F.count("*").alias("reports")
    )


def stream_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports per day of the sink after days older than ten were dropped by folder."""
    table, rejects = stage_path(spark, "status"), stage_path(spark, "rejects")
    source = stream.read_polls(spark, _poll_files(spark, sf_dir), files_per_batch=16)
    stream.write_status(source, table, rejects, stage_path(spark, "ckpt")).awaitTermination()
    layout.expire_partitions(spark, table, "reported_on", AS_OF, 10)
    return layout.read_table(spark, table).groupBy("reported_on").agg(F.count("*").alias("reports"))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, rejects = stage_path(spark, "status"), stage_path(spark, "rejects")
    source = stream.read_polls(spark, _poll_files(spark, sf_dir), files_per_batch=16)
    stream.write_status(source, table, rejects, stage_path(spark, "ckpt")).awaitTermination()
    kept = layout.read_table(spark, rejects).where("document IS NULL")
    return kept.groupBy("station_id", "timestamp").agg(F.count("*").alias("rejects"))


def stream_raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages archived per publish time, with the stations they hold."""
    table = stage_path(spark, "archive")
    source = stream.read_polls(spark, _poll_files(spark, sf_dir))
    stream.archive_raw(source, table, stage_path(spark, "ckpt"), "station-status").awaitTermination()
    archive = spark.read.parquet(table)
    return archive.select(
        "publish_time",
        "subscription_name",
        F.size(F.from_json("data", "data STRUCT<stations: ARRAY<STRUCT<station_id: STRING>>>")["data"]["stations"])
        .cast("long")
        .alias("stations"),
    )


def stream_poll_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that came to the status table or its rejects, and messages that hold no
    stations, by reason. Every tenth message is cut off, every eleventh has no stations."""
    table, rejects, path = (stage_path(spark, n) for n in ("status", "rejects", "polls"))
    broken_polls(_messages(spark, sf_dir)).select("day", "value").write.partitionBy("day").text(path)
    stream.write_status(stream.read_polls(spark, path, 16), table, rejects, stage_path(spark, "ckpt")).awaitTermination()
    bad = layout.read_table(spark, rejects)
    read = layout.read_table(spark, table).select("message_id").unionByName(bad.where("document IS NULL").select("message_id"))
    outcomes = read.distinct().select(F.lit("read").alias("outcome")).unionByName(
        bad.where("document IS NOT NULL").select(F.col("reason").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n_polls"))


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice, over many batches in any order of time: one report
    for each station and second, the one polled last, then the one with the highest values."""
    table = stage_path(spark, "distinct")
    source = stream.read_polls(spark, _shuffled_files(spark, sf_dir, copies=2), files_per_batch=4)
    stream.write_distinct(source, table, stage_path(spark, "ckpt")).awaitTermination()
    return stream.read_distinct(spark, table).drop("ingestion_timestamp")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute windows of all reports, whose messages come twice, in several batches out
    of time order."""
    table = stage_path(spark, "windows")
    source = stream.read_polls(spark, _shuffled_files(spark, sf_dir, copies=2), files_per_batch=4)
    stream.write_windows(source, table, stage_path(spark, "ckpt")).awaitTermination()
    return stream.read_windows(spark, table)


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest report per station, maintained over several micro-batches."""
    state = stage_path(spark, "latest")
    source = stream.read_polls(spark, _poll_files(spark, sf_dir), files_per_batch=16)
    stream.keep_latest(source, state, stage_path(spark, "ckpt")).awaitTermination()
    return stream.read_latest(spark, state).drop("ingestion_timestamp")


QUERIES = {
    "stream_status_sink": stream_status_sink,
    "stream_rejects": stream_rejects,
    "stream_poll_rejects": stream_poll_rejects,
    "stream_metadata": stream_metadata,
    "stream_expiry": stream_expiry,
    "stream_raw_archive": stream_raw_archive,
    "stream_dedupe": stream_dedupe,
    "stream_windows": stream_windows,
    "stream_latest": stream_latest,
}
