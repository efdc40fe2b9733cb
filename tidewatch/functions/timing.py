"""Time differences and the hour key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.numeric import round_positive


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds with their fraction."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def gap_minutes(ts: Column, previous: Column) -> Column:
    return round_positive(seconds_between(ts, previous) / F.lit(60.0), 1)


def hours_between(later: Column, earlier: Column) -> Column:
    return round_positive(seconds_between(later, earlier) / F.lit(3600.0), 2)


def time_key(ts: Column) -> Column:
    """Start of the hour: the calendar key."""
    return F.date_trunc("hour", ts)
