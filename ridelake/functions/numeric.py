"""Arithmetic with the null and zero rules the models rely on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.rules import EARTH_RADIUS_KM, PI


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero or null denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def total(columns: list[Column]) -> Column:
    """Sum that is null as soon as one term is null."""
    return reduce(lambda left, right: left + right, columns)


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` limited to [low, high]; a null stays null.

    ``least`` and ``greatest`` skip nulls, so a bare pair would turn a null into a bound.
    """
    limited = F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value))
    return F.when(value.isNotNull(), limited)


def null_strict(function, *columns: Column) -> Column:
    """``F.least`` or ``F.greatest`` that is null when any argument is null."""
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(known, function(*columns))


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole MINUTEs, SECONDs or HOURs from start to end, cut towards zero."""
    return F.timestamp_diff(unit, start, end)


def great_circle_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine distance in km, two decimals."""

    def radians(degrees: Column, parts: int) -> Column:
        return degrees * F.lit(PI) / F.lit(parts)

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(radians(b - a, 360)), F.lit(2))

    parallel = F.cos(radians(lat1, 180)) * F.cos(radians(lat2, 180))
    chord = half_chord(lat1, lat2) + parallel * half_chord(lng1, lng2)
    return F.round(F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord)), 2)
