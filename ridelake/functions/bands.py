"""Ladders of thresholds as CASE columns."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def choose(cases: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """First value whose condition is true; an unknown condition counts as false."""
    column = F
    for condition, value in cases:
        column = column.when(condition, value)
    return column.otherwise(otherwise)


def ladder(value: Column, sign: str, rule: tuple[Sequence[tuple[float, object]], object]) -> Column:
    """First label whose bound satisfies ``value <sign> bound``, else the rest label."""
    steps, rest = rule
    return choose([(_COMPARE[sign](value, bound), label) for bound, label in steps], rest)


def in_lists(value: Column, lists: Mapping[str, Sequence], otherwise: object = None) -> Column:
    return choose([(value.isin(members), label) for label, members in lists.items()], otherwise)


def in_ranges(value: Column, ranges: Mapping[str, tuple], otherwise: object = None) -> Column:
    return choose([(value.between(*bounds), label) for label, bounds in ranges.items()], otherwise)
