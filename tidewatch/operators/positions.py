"""Position cleaning, deduplication and the position fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import blank_to_null, gap_minutes, haversine_nm, time_key
from tidewatch.operators.neighbours import with_neighbour


def valid_positions(raw: DataFrame) -> DataFrame:
    """Drop rows without a usable place or time.

    Any point with latitude 0 or longitude 0 goes, not only (0, 0).
    """
    lat, lon = F.col("LAT"), F.col("LON")
    return raw.filter(
        lat.between(-90, 90) & lon.between(-180, 180) & (lat != 0) & (lon != 0) & F.col("BaseDateTime").isNotNull()
    )


def clean_positions(raw: DataFrame) -> DataFrame:
    """Snake-case names, types, blank text to null, heading falling back to course."""

    def number(source: str, kind: str = "double"):
        return F.col(source).cast(kind)

    return raw.select(
        F.col("MMSI").cast("string").alias("mmsi"),
        F.col("BaseDateTime").cast("timestamp").alias("position_ts"),
        number("LAT").alias("latitude"),
        number("LON").alias("longitude"),
        number("SOG").alias("sog"),
        number("COG").alias("cog"),
        F.coalesce(number("Heading"), number("COG")).alias("heading"),
        blank_to_null(F.col("VesselName")).alias("vessel_name"),
        blank_to_null(F.col("IMO")).alias("imo"),
        blank_to_null(F.col("CallSign")).alias("call_sign"),
        number("VesselType", "int").alias("vessel_type_code"),
        number("Status", "int").alias("nav_status"),
        number("Length").alias("length_m"),
        number("Width").alias("width_m"),
        number("Draft").alias("draft_m"),
        blank_to_null(F.col("Cargo")).alias("cargo_code"),
        blank_to_null(F.col("TransceiverClass")).alias("transceiver_class"),
    )


def dedup_positions(clean: DataFrame) -> DataFrame:
    """One ping per (vessel, time): the longest known length wins.

    All other columns break ties, so the result does not depend on the file
    order. Spark turns the ``== 1`` filter into a group limit on both sides of
    the exchange, so a ping copied many times leaves each map task only once.
    """
    ties = [c for c in clean.columns if c not in ("mmsi", "position_ts")]
    ping = Window.partitionBy("mmsi", "position_ts").orderBy(
        F.coalesce("length_m", F.lit(0.0)).desc(), *[F.col(c).asc_nulls_last() for c in ties]
    )
    return clean.withColumn("_rn", F.row_number().over(ping)).filter(F.col("_rn") == 1).drop("_rn")


def stage_positions(raw: DataFrame) -> DataFrame:
    return dedup_positions(clean_positions(valid_positions(raw)))


def with_previous(staged: DataFrame, bucket: str = "hour") -> DataFrame:
    """Previous ping of the same vessel as prev_lat, prev_lon, prev_ts."""
    return with_neighbour(
        staged, ["mmsi"], "position_ts", ["latitude", "longitude"], prefix="prev_", bucket=bucket
    ).withColumnsRenamed(
        {"prev_position_ts": "prev_ts", "prev_latitude": "prev_lat", "prev_longitude": "prev_lon"}
    )


FACT_COLUMNS = ["mmsi", "position_ts", "latitude", "longitude", "sog", "cog", "heading", "nav_status", "vessel_type_code"]


def position_legs(pings: DataFrame) -> DataFrame:
    """The position fact of pings that know their previous one (prev_ts, prev_lat, prev_lon)."""
    here = (F.col("latitude"), F.col("longitude"))
    there = (F.col("prev_lat"), F.col("prev_lon"))
    return pings.select(
        F.col("mmsi").alias("vessel_key"),
        *FACT_COLUMNS[1:],
        time_key(F.col("position_ts")).alias("time_key"),
        haversine_nm(*there, *here).alias("distance_nm"),
        gap_minutes(F.col("position_ts"), F.col("prev_ts")).alias("time_gap_minutes"),
    )


def fct_vessel_positions(staged: DataFrame, bucket: str = "hour") -> DataFrame:
    """Position fact: leg distance and signal gap since the previous ping."""
    return position_legs(with_previous(staged.select(*FACT_COLUMNS), bucket))
