"""Latest row per key, top-k, and row numbers over a whole table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.session import stage


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in ``order``.

    Spark limits each task's rows to one per key before the shuffle
    (WindowGroupLimit), so a hot key does not move all its rows to one task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def number_within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Row number inside each key, for keys whose groups are small by construction
    (the hours, user types and bike types of one day). Otherwise use ``number_all``."""
    return df.withColumn(
        name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    )


def number_all(
    df: DataFrame, order: list[Column], name: str, keys: list[str] | None = None
) -> DataFrame:
    """Row number over the whole table, or over each key, without a task that sorts
    a whole table or a whole key.

    A plain window moves each group to one task. Here rows are range-partitioned by
    key and order, each slice is numbered on its own, and the rows of the same group
    in the slices before it are added: a table of one row per slice and per key.
    The slices are written first: their bounds are sampled, so they must not be
    worked out twice.
    """
    keys = keys or []
    spread = [F.col(k) for k in keys] + list(order)
    sliced = df.repartitionByRange(*spread).withColumn("_slice", F.spark_partition_id())
    sliced = stage(sliced, "slices")
    by_group = ["_slice", *keys]
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy(*by_group).agg(F.count("*").alias("_rows"))
    offsets = sizes.select(
        *[F.col(c).alias(f"_of{c}") for c in by_group],
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in by_group])
    if not keys:
        offsets = F.broadcast(offsets)  # one row per shuffle partition
    local = F.row_number().over(Window.partitionBy(*by_group).orderBy(*order))
    numbered = sliced.withColumn("_local", local).join(offsets, same)
    return numbered.withColumn(name, F.col("_before") + F.col("_local")).select(*df.columns, name)


def number_by_leading_key(
    df: DataFrame, lead: str, within: str, name: str, descending: bool = True
) -> DataFrame:
    """Row number over the whole table ordered by ``lead`` and then by ``within``.

    ``within`` already numbers the rows of each ``lead`` value, so only the group
    sizes (one row per lead value, a calendar day here) need a running total. The
    summary rows are staged, or both uses would work out the summary again.
    """
    df = stage(df, "ranked")
    sizes = df.groupBy(lead).agg(F.count("*").alias("_rows"))
    order = F.col(lead).desc() if descending else F.col(lead).asc()
    before = F.sum("_rows").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col(lead), F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = df.join(offsets, lead)
    return numbered.withColumn(name, F.col("_before") + F.col(within)).drop("_before")


def number_by_levels(df: DataFrame, first: str, second: str, rest: list[str], name: str) -> DataFrame:
    """Row number over the whole table by ``first`` descending, then ``second`` and ``rest``,
    as a lazy plan: defining it starts no job and stores nothing.

    For a summary in which ``first`` is a count, so that its values are few beside the rows
    they count, and ``first`` and ``second`` together are shared by few rows. Rows are
    numbered within both; a table of the sizes of those groups, and one of those of
    ``first``, give the rows before them. No window sees more than one of these.
    """
    before = lambda of, by: F.coalesce(F.sum("_rows").over(of.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = df.groupBy(F.col(first).alias("_first"), F.col(second).alias("_second")).agg(F.count("*").alias("_rows"))
    starts = sizes.groupBy(F.col("_first").alias("_of")).agg(F.sum("_rows").alias("_rows"))
    starts = starts.select("_of", before(Window.partitionBy(), F.desc("_of")).alias("_earlier"))
    inner = sizes.select("_first", "_second", before(Window.partitionBy("_first"), F.asc("_second")).alias("_inner"))
    offsets = inner.join(starts, F.col("_first") == F.col("_of")).select("_first", "_second", (F.col("_earlier") + F.col("_inner")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(first, second).orderBy(*[F.asc(c) for c in rest]))
    same = (F.col(first) == F.col("_first")) & F.col(second).eqNullSafe(F.col("_second"))
    numbered = df.withColumn("_local", local).join(offsets, same)
    return numbered.withColumn(name, F.col("_before") + F.col("_local")).select(*df.columns, name)


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The first ``k`` rows; each task keeps k rows, no full sort."""
    return df.orderBy(*order).limit(k)
