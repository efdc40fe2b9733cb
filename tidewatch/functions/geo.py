"""Distances on the sphere and in plain degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.numeric import round_positive

EARTH_RADIUS_NM = 3440.065


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in nautical miles, two decimals.

    Rounding can lift the chord of opposite points past 1, hence the cap.
    """
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    chord = F.pow(half_lat, 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(half_lon, 2)
    angle = F.lit(2.0) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, round_positive(F.lit(EARTH_RADIUS_NM) * angle, 2))


def planar_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in degrees on the flat grid (no cosine correction)."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lon1 - lon2, 2))
