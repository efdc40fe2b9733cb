"""Type-2 history of vessels: a version per change of name or type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import parity_round
from tidewatch.operators.dimensions import latest_known, sightings

CHECKED = ["vessel_name", "vessel_type_code"]


def scd2_source(raw: DataFrame) -> DataFrame:
    """Current attributes per vessel from the raw pings.

    Only the coordinate ranges are checked, and text stays as landed. The latest
    known value counts, so an unchanged vessel never looks changed.
    """

    kept = raw.filter(
        F.col("MMSI").isNotNull() & F.col("LAT").between(-90, 90) & F.col("LON").between(-180, 180)
    )
    attributes = ["IMO", "VesselName", "VesselType", "CallSign", "Length", "Width", "Draft"]
    return (
        sightings(kept, "MMSI", attributes, "BaseDateTime")
        .groupBy(F.col("MMSI").alias("mmsi"))
        .agg(
            latest_known("IMO").alias("imo"),
            latest_known("VesselName").alias("vessel_name"),
            latest_known("VesselType").alias("vessel_type_code"),
            latest_known("CallSign").alias("call_sign"),
            parity_round(latest_known("Length"), 1).alias("length_m"),
            parity_round(latest_known("Width"), 1).alias("width_m"),
            parity_round(latest_known("Draft"), 1).alias("draft_m"),
        )
    )


def _version(columns: list[str], key: str, as_of: Column, prefix: str = "") -> Column:
    """A new open version of the incoming row."""
    return F.struct(
        *[F.col(prefix + c).alias(c) for c in columns],
        F.md5(F.concat_ws("|", F.col(prefix + key).cast("string"), as_of.cast("string"))).alias("version_id"),
        as_of.alias("updated_at"),
        as_of.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def first_snapshot(source: DataFrame, key: str = "mmsi", as_of: Column | None = None) -> DataFrame:
    """Every source row as an open version."""
    when = F.current_timestamp() if as_of is None else as_of
    return source.select(_version(source.columns, key, when).alias("v")).select("v.*")


def scd2_merge(
    history: DataFrame,
    incoming: DataFrame,
    key: str = "mmsi",
    check_cols: list[str] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """History after one more snapshot.

    A new key opens a version; a change in ``check_cols`` closes the open version
    and opens another; a key that is gone closes its version; anything else stays
    as it is. The result is a new frame: write it to a new path, then switch.
    """
    when = F.current_timestamp() if as_of is None else as_of
    checked = CHECKED if check_cols is None else check_cols
    columns = incoming.columns
    is_open = F.col("valid_to").isNull()

    old = history.filter(is_open).select([F.col(c).alias(f"old_{c}") for c in history.columns])
    new = incoming.select([F.col(c).alias(f"new_{c}") for c in columns])
    matched = old.join(new, F.col(f"old_{key}") == F.col(f"new_{key}"), "full_outer")

    had, has = F.col(f"old_{key}").isNotNull(), F.col(f"new_{key}").isNotNull()
    same = F.lit(True)
    for c in checked:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    replaced = had & has & ~same

    kept = F.struct(
        *[
            (F.when(replaced | ~has, when).otherwise(F.col("old_valid_to")) if c == "valid_to" else F.col(f"old_{c}"))
            .alias(c)
            for c in history.columns
        ]
    )
    opened = _version(columns, key, when, "new_")
    versions = F.filter(
        F.array(F.when(had, kept), F.when(replaced | ~had, opened)), lambda version: version.isNotNull()
    )
    current = matched.select(F.explode(versions).alias("v")).select("v.*")
    return history.filter(~is_open).unionByName(current)
