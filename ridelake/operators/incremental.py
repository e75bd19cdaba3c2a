"""Slices of new rows and keyed upserts into partitioned Parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.operators.layout import write_table
from ridelake.operators.ranking import latest_per_key
from ridelake.session import stage


def watermark(target: DataFrame, column: str):
    """Highest loaded value. One number goes to the driver, so that the slice below
    is a literal comparison the scan can prune partitions with."""
    return target.agg(F.max(column)).first()[0]


def newer_than(source: DataFrame, column: str, mark, look_back: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """Rows after the watermark, less the look-back kept for late rows.

    No watermark (an empty target) means everything.
    """
    if mark is None:
        return source
    return source.where(F.col(column) > F.lit(mark - look_back))


def merged(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``changes`` replacing those of the same key."""
    kept = target.join(changes.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(changes.select(*target.columns))


def upsert(
    target: DataFrame,
    path: str,
    changes: DataFrame,
    keys: list[str],
    partition_by: str,
    order: list[Column] = (),
    cluster_by: list[str] = (),
    search_all: bool = True,
) -> list[str]:
    """Merge ``changes`` into the table at ``path`` and return the partitions written.

    Only partitions that hold a changed key, before or after, are rewritten. A key
    that moves to another partition leaves the old one, for which the keys of the whole
    target are read; where keys never move, ``search_all=False`` looks in the partitions
    of the changes alone. Of several changes to a key one wins: the first by ``order``,
    or without it the one with the highest values.
    """
    order = list(order) or [F.desc_nulls_last(c) for c in target.columns if c not in keys]
    changes = stage(latest_per_key(changes.select(*target.columns), keys, order), "changes")
    days = changes.select(partition_by)
    if search_all:
        days = target.join(changes.select(*keys), keys, "left_semi").select(partition_by).unionByName(days)
    touched = [row[0] for row in days.distinct().collect()]  # partition values only: one per day
    result = merged(target.where(F.col(partition_by).isin(touched)), changes, keys)
    write_table(result, path, partition_by, cluster_by, drop=[str(v) for v in touched])
    return sorted(str(v) for v in touched)
