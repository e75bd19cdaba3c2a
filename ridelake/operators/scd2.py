"""Slowly changing dimension, type 2: one row per version of a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.keys import instant_text, surrogate_key

VALIDITY = ["version_id", "version_updated_at", "valid_from", "valid_to"]


def first_snapshot(current: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """History that holds one open version per row of ``current``."""
    start = F.col(updated_at)
    return current.select(
        "*",
        surrogate_key(F.col(key), instant_text(start)).alias("version_id"),
        start.alias("version_updated_at"),
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def _same(old: Column, new: Column, tolerance: float | None) -> Column:
    equal = old.eqNullSafe(new)
    return equal if tolerance is None else equal | F.coalesce(F.abs(old - new) <= tolerance, F.lit(False))


def apply_snapshot(
    history: DataFrame,
    current: DataFrame,
    key: str,
    tracked: list[str],
    run_at: Column,
    updated_at: str = "updated_at",
    strategy: str = "check",
    close_missing: bool = True,
    tolerance: dict[str, float] | None = None,
) -> DataFrame:
    """History after one more run over ``current``.

    strategy 'check' opens a new version when a tracked attribute differs, by more than
    its ``tolerance`` if it has one; an attribute within it keeps the stored value;
    'timestamp' when ``updated_at`` is newer, so a source stamped on every run gets
    a new version every run. A version closes at the moment the next one opens,
    or at ``run_at`` when its key has disappeared and ``close_missing`` is set.

    Open versions and current rows meet in one full outer join on the key; each
    pair yields the rows that survive it. Closed versions pass through untouched.
    """
    columns = history.columns
    closed = history.where(F.col("valid_to").isNotNull())
    open_rows = history.where(F.col("valid_to").isNull()).select(
        F.col(key).alias("_key"), F.struct(*columns).alias("old")
    )
    fresh = first_snapshot(current, key, updated_at)
    new_rows = fresh.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    pairs = open_rows.join(new_rows, "_key", "full_outer")

    if strategy == "timestamp":
        changed = F.col(f"new.{updated_at}") > F.col("old.version_updated_at")
    elif strategy == "check":
        same = [_same(F.col(f"old.{c}"), F.col(f"new.{c}"), (tolerance or {}).get(c)) for c in tracked]
        changed = ~reduce(lambda a, b: a & b, same)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    replaced = had & has & F.coalesce(changed, F.lit(False))
    gone = had & ~has & F.lit(close_missing)
    closing = F.when(replaced, F.col("new.valid_from")).when(gone, run_at)
    old_after = F.when(had, F.col("old").withField("valid_to", closing.cast("timestamp")))
    new_after = F.when(replaced | ~had, F.col("new"))
    survivors = pairs.select(F.explode(F.array(old_after, new_after)).alias("row"))
    survivors = survivors.where(F.col("row").isNotNull()).select("row.*")
    return closed.select(*columns).unionByName(survivors.select(*columns))
