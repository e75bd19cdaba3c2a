"""Lookups against dimensions and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    natural_key: str,
    key: Column | str,
    take: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Add dimension columns to a fact under the names of one role.

    ``take`` maps a dimension column to the name it gets on the fact, so one
    dimension can serve several roles (start station, end station). No hint:
    a staged or stored dimension is broadcast while its files are below the
    threshold; beyond it the join is sort-merge, and adaptive execution splits
    hot and null keys.
    """
    side = dimension.select(
        F.col(natural_key).alias("_lookup"), *[F.col(c).alias(n) for c, n in take.items()]
    )
    value = F.col(key) if isinstance(key, str) else key
    return fact.join(side, value == F.col("_lookup"), how).drop("_lookup")


def lookup_version(
    fact: DataFrame, versions: DataFrame, natural_key: str, key: str, at: Column, take: dict[str, str]
) -> DataFrame:
    """``lookup`` among versions of a dimension: the one valid at ``at``.

    ``versions`` has ``effective_date`` and ``end_date``. The first version of a key is
    open to the left, since facts may be older than the first snapshot.
    """
    of_key = Window.partitionBy(natural_key).orderBy("effective_date")
    begin = F.when(F.row_number().over(of_key) > 1, F.col("effective_date"))
    side = versions.select(
        F.col(natural_key).alias("_lookup"),
        begin.alias("_begin"),
        F.col("end_date").alias("_end"),
        *[F.col(c).alias(n) for c, n in take.items()],
    )
    moment = at.cast("timestamp_ntz")
    valid = (F.col("_begin").isNull() | (moment >= F.col("_begin"))) & (
        F.col("_end").isNull() | (moment < F.col("_end"))
    )
    return fact.join(side, (F.col(key) == F.col("_lookup")) & valid, "left").drop("_lookup", "_begin", "_end")


def salted_join(
    large: DataFrame, small: DataFrame, keys: list[str], spread_by: Column, salts: int, how: str = "left"
) -> DataFrame:
    """Equi-join that spreads every key of ``large`` over ``salts`` tasks.

    For a right side too big to broadcast and keys known to be hot. The salt is a
    hash of the row's own columns, so a repeated task gives the same rows. The
    small side is repeated ``salts`` times; ``how`` is 'left' or 'inner'.
    """
    if how not in ("left", "inner"):
        raise ValueError("only the large side may keep unmatched rows")
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def point_in_time(
    events: DataFrame, history: DataFrame, key: str, at: str, valid_from: str, valid_to: str
) -> DataFrame:
    """Join each event to the version of ``key`` that was valid at ``at``.

    An equi-join on the key with the interval as a further condition: versions of
    other keys are never paired. Intervals are closed at the start, open at the end.
    """
    versions = history.withColumnRenamed(key, "_key")
    current = (F.col(at) >= F.col(valid_from)) & (
        F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to))
    )
    return events.join(versions, (F.col(key) == F.col("_key")) & current, "left").drop("_key")
