"""Trailing averages and lags over the rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trailing(
    df: DataFrame,
    key: str,
    day: str,
    averages: dict[str, tuple[str, int]] | None = None,
    lags: dict[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """Add averages over the last n rows and values n rows back, per key in day order.

    ``averages`` and ``lags`` map a new column to (source column, rows). Frames count
    rows, not days: a key without a row on some day reaches further back. All columns
    share one partitioning and ordering, so Spark shuffles and sorts once.
    """
    by_day = Window.partitionBy(key).orderBy(day)
    columns = {
        name: F.avg(source).over(by_day.rowsBetween(1 - rows, 0))
        for name, (source, rows) in (averages or {}).items()
    }
    for name, (source, rows) in (lags or {}).items():
        columns[name] = F.lag(source, rows).over(by_day)
    return df.withColumns(columns)


def last_rows(df: DataFrame, key: str, day: str, rows: int) -> DataFrame:
    """The last ``rows`` rows of each key."""
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(day)))
    return df.withColumn("_back", back).where(F.col("_back") <= rows).drop("_back")
