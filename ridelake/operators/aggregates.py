"""Aggregates that stay mergeable, so a hot group is reduced before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def modal_values(df: DataFrame, keys: list[str], texts: list[str], numbers: list[str]) -> DataFrame:
    """Most frequent value per key of each listed column, lowest on ties, in one pass.

    Values are counted per (key, column, value) first, so no task ever holds the
    values of a whole key. Nulls count as a value and lose ties.
    """
    none_text, none_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).alias("text"), none_number.alias("number")) for c in texts]
    entries += [F.struct(F.lit(c).alias("name"), none_text.alias("text"), F.col(c).alias("number")) for c in numbers]
    counted = (
        df.select(*keys, F.inline(F.array(*entries)))
        .groupBy(*keys, "name", "text", "number")
        .agg(F.count("*").alias("n"))
    )
    missing = F.col("text").isNull() & F.col("number").isNull()
    preference = F.struct(-F.col("n"), missing, "text", "number")

    def winner(column: str, value: str) -> Column:
        return F.min_by(value, F.when(F.col("name") == column, preference)).alias(column)

    return counted.groupBy(*keys).agg(
        *[winner(c, "text") for c in texts], *[winner(c, "number") for c in numbers]
    )


def slot_masks(slot: str, slots: int) -> dict[str, str]:
    """Bit masks of the slots seen, 64 to a column, as SQL aggregates: an exact distinct
    count for a small domain that merges like a sum and needs no extra shuffle."""
    return {
        f"_slots{word}": f"bit_or(if({slot} div 64 = {word}, "
        f"shiftleft(1L, cast({slot} % 64 AS int)), 0L))"
        for word in range(-(-slots // 64))
    }


def count_slots(masks: list[str]) -> str:
    """Number of slots in masks built by ``slot_masks``, while merging groups."""
    return "cast(" + " + ".join(f"bit_count(bit_or({m}))" for m in masks) + " AS bigint)"


def merged_mean(n: str, mean: str) -> str:
    """Mean of a group from the counts and means of its parts."""
    return f"try_divide(sum({mean} * {n}), sum({n}))"


def merged_stddev(n: str, mean: str, variance: str) -> str:
    """Sample standard deviation of a group from the count, mean and population
    variance of its parts; null for fewer than two values.

    Parts are merged one by one: the sum of squared deviations grows by the new part's own
    and by the squared difference of the means, so large values lose no digits. A group
    has one part for each value of a small domain, which is all its list holds.
    """
    part = f"struct({n} AS n, {mean} AS m, {n} * {variance} AS s)"
    merged = (
        "struct(a.n + b.n AS n, a.m + (b.m - a.m) * b.n / (a.n + b.n) AS m, "
        "a.s + b.s + (b.m - a.m) * (b.m - a.m) * a.n * b.n / (a.n + b.n) AS s)"
    )
    parts = f"filter(collect_list({part}), x -> x.n > 0)"
    whole = f"reduce({parts}, struct(0L AS n, 0D AS m, 0D AS s), (a, b) -> {merged}, t -> if(t.n > 1, sqrt(t.s / (t.n - 1)), NULL))"
    return f"cast({whole} AS double)"


def sql_columns(expressions: dict[str, str]) -> list[Column]:
    """Columns from SQL texts by name. One call each, where a wide aggregate built from
    column functions makes thousands."""
    return [F.expr(f"{text} AS {name}") for name, text in expressions.items()]
