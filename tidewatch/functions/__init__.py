"""Column expressions shared by the operators (all JVM-side built-ins)."""

from tidewatch.functions.geo import haversine_nm, planar_degrees
from tidewatch.functions.labels import (
    anomaly_type,
    beaufort,
    capacity_tier,
    harbor_size_rank,
    is_extended_stay,
    risk_score,
    season,
    stay_category,
    vessel_type_desc,
    watch_period,
)
from tidewatch.functions.numeric import implied_speed, kmh_to_kts, parity_round, round_positive, to_int
from tidewatch.functions.text import blank_to_null
from tidewatch.functions.timing import gap_minutes, hours_between, seconds_between, time_key

__all__ = [
    "anomaly_type",
    "beaufort",
    "blank_to_null",
    "capacity_tier",
    "gap_minutes",
    "harbor_size_rank",
    "haversine_nm",
    "hours_between",
    "implied_speed",
    "is_extended_stay",
    "kmh_to_kts",
    "parity_round",
    "planar_degrees",
    "risk_score",
    "round_positive",
    "season",
    "seconds_between",
    "stay_category",
    "time_key",
    "to_int",
    "vessel_type_desc",
    "watch_period",
]
