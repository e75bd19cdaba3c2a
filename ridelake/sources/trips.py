"""Monthly trip files: CSV landing, month loads, backfill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.layout import partition_values
from ridelake.schemas import TRIPS

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# Times come with or without milliseconds.
READ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSS]"
LANDING = ["year", "month", "source"]


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the CSV files, with the text of those that do not parse. All fields
    are parsed whichever are selected, so a line is broken or not for all readers."""
    schema = T.StructType([*TRIPS.fields, T.StructField("broken_line", T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampFormat", READ_FORMAT)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", "broken_line")
        .option("columnPruning", False)
        .csv(path)
    )


def read_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files under ``path`` in one scan, with the declared columns. Lines that do
    not parse, or lack an id or a start, are left to ``trip_csv_rejects``."""
    return _parsed(spark, path).where(f"NOT coalesce({_FAULTY}, false)").drop("broken_line")


def trip_csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(document, reason) of the lines that ``read_trip_csv`` leaves out."""
    rejected = _parsed(spark, path).where(f"coalesce({_FAULTY}, false)")
    reason = F.when(F.col("broken_line").isNotNull(), "broken line").otherwise("no id or start")
    fields = F.to_json(F.struct(*[f.name for f in TRIPS]))
    return rejected.select(F.coalesce("broken_line", fields).alias("document"), reason.alias("reason"))


_FAULTY = "broken_line IS NOT NULL OR ride_id IS NULL OR started_at IS NULL"


def land_trips(csv: DataFrame, path: str, source: str | None = None) -> None:
    """Write to the Parquet landing zone, ``year=yyyy/month=MM/source=<file>``.

    What a source brought to a month lies in a folder of its own, so landing it again
    replaces it. A source is known by the name given, or else by the file's name and a hash
    of its whole path, which tells files of one name in two folders apart. Rows that come
    from no file need a name; without one they all count as the source ``rows``.
    """
    start, file = F.col("started_at"), F.input_file_name()
    known = F.concat_ws("-", F.element_at(F.split(file, "/"), -1), F.substring(F.md5(file), 1, 8))
    months = csv.withColumns(
        {
            "year": F.date_format(start, "yyyy"),
            "month": F.date_format(start, "MM"),
            "source": F.lit(source) if source else F.when(file == "", "rows").otherwise(known),
        }
    )
    # One shuffle by month; adaptive execution splits a month as its size asks for.
    spread = months.hint("rebalance", *[F.col(c) for c in LANDING])
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LANDING).parquet(path)


def last_months(as_of: dt.date, count: int = 3) -> list[str]:
    """The months before the one of ``as_of``, as ``yyyy-MM``: what a backfill loads."""
    month = as_of.year * 12 + as_of.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(month - count, month)]


def months_between(first: str, last: str) -> list[str]:
    """The months from ``first`` to ``last`` (``yyyy-MM``), both included."""
    number = [int(m[:4]) * 12 + int(m[5:7]) - 1 for m in (first, last)]
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(number[0], number[1] + 1)]


def read_months(
    spark: SparkSession, path: str, months: list[str], optional: T.StructType | None = None
) -> DataFrame:
    """The listed months (``yyyy-MM``) of the landing zone in one scan.

    Older files may lack later columns and older columns may be required: the
    declared schema is read with every field nullable, plus any ``optional`` ones.
    Only the listed month folders are opened (partition pruning).
    """
    fields = [T.StructField(f.name, f.dataType, True) for f in TRIPS]
    fields += [T.StructField(f.name, f.dataType, True) for f in optional or []]
    fields += [T.StructField(c, T.StringType()) for c in ("year", "month")]
    landed = spark.read.schema(T.StructType(fields)).parquet(path)
    wanted = [
        (F.col("year") == month[:4]) & (F.col("month") == month[5:7]) for month in sorted(set(months))
    ]
    condition = F.lit(False)
    for month in wanted:
        condition = condition | month
    return landed.where(condition)


def added_fields(spark: SparkSession, path: str, months: list[str]) -> T.StructType:
    """Fields that files of the listed months have beyond the declared ones."""
    folders = [f"{path}/year={m[:4]}/month={m[5:7]}" for m in months if m[5:7] in partition_values(spark, f"{path}/year={m[:4]}", "month")]
    if not folders:
        return T.StructType([])
    found = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*folders).schema
    declared = {f.name for f in TRIPS} | set(LANDING)
    return T.StructType([f for f in found if f.name not in declared])


def load_months(spark: SparkSession, landing: str, raw: str, months: list[str]) -> None:
    """Load the listed months into the raw trips table, partitioned by month of start.

    A month that is loaded again replaces its rows. Fields that a later month adds are
    loaded as well; they are null in the months before.
    """
    trips = read_months(spark, landing, months, added_fields(spark, landing, months)).drop(*LANDING)
    monthly = trips.withColumn("started_month", F.date_format("started_at", "yyyy-MM"))
    writer = monthly.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("started_month").parquet(raw)


def read_raw(spark: SparkSession, raw: str) -> DataFrame:
    """The raw trips table with the columns of every load."""
    return spark.read.option("mergeSchema", True).parquet(raw)
