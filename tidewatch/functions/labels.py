"""Classifications: each is one chain of conditions, first match wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.numeric import round_positive

# Upper km/h bounds of Beaufort classes 0 to 11.
BEAUFORT_KMH = [2, 6, 12, 20, 29, 39, 50, 62, 75, 89, 103, 117]

# Vessel type code -> description.
VESSEL_TYPES = {
    30: "Fishing",
    36: "Sailing",
    37: "Pleasure Craft",
    40: "High Speed Craft",
    52: "Tug",
    60: "Passenger",
    70: "Cargo",
    80: "Tanker",
}

# Harbour sizes in rank order.
HARBOR_SIZES = ["Large", "Medium", "Small", "Very Small"]

# Upper hour bounds of the stay categories.
STAY_BOUNDS = [(6, "brief_stop"), (24, "day_call"), (72, "standard_call")]
EXTENDED_STAY_HOURS = 48

# Season of each month, watch of each four-hour block.
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]
WATCHES = [
    "Middle Watch",
    "Morning Watch",
    "Forenoon Watch",
    "Afternoon Watch",
    "First Dog/Second Dog",
    "First Watch",
]

BLACKOUT_MIN = 120
EXTENDED_BLACKOUT_MIN = 360
IMPOSSIBLE_KTS = 40
MOVEMENT_NM = 50


def _first_match(cases: list[tuple[Column, object]], default: object = None) -> Column:
    (condition, value), *rest = cases
    chain = reduce(lambda acc, case: acc.when(case[0], F.lit(case[1])), rest, F.when(condition, F.lit(value)))
    return chain if default is None else chain.otherwise(default)


def beaufort(kmh: Column) -> Column:
    """Class 0 to 12; a null speed falls through to 12."""
    return _first_match([(kmh < bound, force) for force, bound in enumerate(BEAUFORT_KMH)], F.lit(12))


def vessel_type_desc(code: Column) -> Column:
    other = F.concat(F.lit("Other ("), code.cast("string"), F.lit(")"))
    return _first_match([(code == known, name) for known, name in VESSEL_TYPES.items()], other)


def harbor_size_rank(size: Column) -> Column:
    return _first_match([(size == name, rank) for rank, name in enumerate(HARBOR_SIZES, start=1)], F.lit(5))


def capacity_tier(size: Column, channel_depth_m: Column) -> Column:
    return _first_match(
        [
            ((size == "Large") & (channel_depth_m >= 14), "Tier 1 - Deep Water"),
            (size.isin("Large", "Medium"), "Tier 2 - Major"),
            (size == "Small", "Tier 3 - Regional"),
        ],
        F.lit("Tier 4 - Minor"),
    )


def is_extended_stay(hours: Column) -> Column:
    return F.when(hours > EXTENDED_STAY_HOURS, 1).otherwise(0)


def stay_category(hours: Column) -> Column:
    cases = [(hours.isNull(), "in_port")] + [(hours < bound, name) for bound, name in STAY_BOUNDS]
    return _first_match(cases, F.lit("extended_stay"))


def season(month: Column) -> Column:
    """December to February is winter, and so on in threes."""
    return F.element_at(F.array(*map(F.lit, SEASONS)), (F.floor((month % 12) / 3) + 1).cast("int"))


def watch_period(hour: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WATCHES)), (F.floor(hour / 4) + 1).cast("int"))


def anomaly_type(gap_min: Column, distance_nm: Column, speed_kts: Column) -> Column:
    silent = gap_min > BLACKOUT_MIN
    return _first_match(
        [
            (silent & (distance_nm > MOVEMENT_NM), "blackout_with_movement"),
            (silent & (distance_nm <= MOVEMENT_NM), "blackout_stationary"),
            (speed_kts > IMPOSSIBLE_KTS, "impossible_speed"),
            (gap_min > EXTENDED_BLACKOUT_MIN, "extended_blackout"),
        ]
    )


def risk_score(gap_min: Column, distance_nm: Column, speed_kts: Column) -> Column:
    """0 to 100: gap (40 %), distance (30 %) and implied speed (30 %)."""
    gap_part = F.least(gap_min, F.lit(1440.0)) / F.lit(14.4) * F.lit(0.4)
    distance_part = F.least(distance_nm, F.lit(500.0)) / F.lit(5.0) * F.lit(0.3)
    speed_part = F.when(speed_kts > 25, F.lit(100.0)).when(speed_kts > 15, F.lit(50.0)).otherwise(F.lit(0.0))
    return F.least(F.lit(100.0), round_positive(gap_part + distance_part + speed_part * F.lit(0.3)))
