"""Port cleaning and dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import capacity_tier, harbor_size_rank

# What a missing attribute is filled with.
PORT_DEFAULTS = {
    "harbor_size": "Unknown",
    "harbor_type": "Unknown",
    "shelter_quality": "Unknown",
    "has_dry_dock": "No",
    "has_railway": "No",
    "has_provisions": "No",
    "has_fuel_oil": "No",
}


def clean_ports(raw: DataFrame) -> DataFrame:
    """Typed ports with a name; missing text attributes get their default."""
    doubles = ["latitude", "longitude", "channel_depth_m", "anchorage_depth_m", "cargo_pier_depth_m", "tide_range_m"]

    def column(name: str):
        if name == "port_index":
            return F.col(name).cast("int").alias("port_key")
        if name == "max_vessel_length_m":
            return F.col(name).cast("int").alias(name)
        if name in doubles:
            return F.col(name).cast("double").alias(name)
        if name in PORT_DEFAULTS:
            return F.coalesce(name, F.lit(PORT_DEFAULTS[name])).alias(name)
        return F.col(name)

    return raw.filter(F.col("port_name").isNotNull()).select(*[column(c) for c in raw.columns])


def dim_ports(staged: DataFrame) -> DataFrame:
    return staged.withColumns(
        {
            "harbor_size_rank": harbor_size_rank(F.col("harbor_size")),
            "capacity_tier": capacity_tier(F.col("harbor_size"), F.col("channel_depth_m")),
        }
    )
