"""Rounding, unit conversion and speed expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KNOTS_PER_KMH = 0.539957


# The double just below one half: adding it and taking the floor rounds halves up
# without lifting 0.49999999999999994 to 1.
_BELOW_HALF = 0.49999999999999994


def _rounded(value: Column, digits: int, whole) -> Column:
    if digits == 0:
        return whole(value)
    scale = F.lit(float(10**digits))
    return whole(value * scale) / scale


def parity_round(value: Column, digits: int = 0) -> Column:
    """Round half away from zero on the scaled double.

    Spark's own ``round(x, n)`` rounds the printed decimal (1.005 -> 1.01) and
    builds a decimal per row; the results to match round the scaled binary value
    (1.005 -> 1.0). For magnitudes below 2^63 after scaling.
    """
    return _rounded(value, digits, lambda x: F.signum(x) * F.floor(F.abs(x) + F.lit(_BELOW_HALF)))


def round_positive(value: Column, digits: int = 0) -> Column:
    """``parity_round`` for values that are never negative.

    It mentions its argument once. That matters for long expressions: Spark
    repeats them in pushed-down filters, and generated methods past 8000 bytes
    of bytecode are not compiled by the JVM.
    """
    return _rounded(value, digits, lambda x: F.floor(x + F.lit(_BELOW_HALF)).cast("double"))


def to_int(value: Column) -> Column:
    """Number or numeric text to int, rounding to the nearest; null where that is no int.

    A plain Spark cast truncates doubles and refuses text such as '70.0'.
    """
    return F.rint(value.try_cast("double")).try_cast("int")


def kmh_to_kts(kmh: Column) -> Column:
    return round_positive(kmh * F.lit(KNOTS_PER_KMH), 1)


def implied_speed(distance_nm: Column, gap_min: Column) -> Column:
    """Knots needed to cover the leg in the gap; null when the gap is not positive."""
    return F.when(gap_min > 0, round_positive(distance_nm / (gap_min / F.lit(60.0)), 1))
