"""Vessel, calendar and zone dimensions, and the wide tracking table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import parity_round, season, vessel_type_desc, watch_period

CALENDAR_START = "2024-01-01"
CALENDAR_HOURS = 17_520

# zone_key, zone_code, zone_name, center_lat, center_lon, radius_nm.
WEATHER_ZONES = [
    (1, "strait_of_gibraltar", "Strait of Gibraltar", 35.96, -5.60, 30),
    (2, "english_channel", "English Channel", 50.50, -1.00, 40),
    (3, "suez_canal_north", "Suez Canal (North)", 31.27, 32.31, 20),
    (4, "strait_of_hormuz", "Strait of Hormuz", 26.60, 56.25, 25),
    (5, "malacca_strait", "Malacca Strait", 2.50, 101.50, 30),
    (6, "cape_good_hope", "Cape of Good Hope", -34.35, 18.50, 50),
    (7, "panama_canal_atlantic", "Panama Canal (Atlantic)", 9.38, -79.92, 15),
    (8, "gulf_of_mexico_central", "Gulf of Mexico (Central)", 27.00, -90.00, 80),
    (9, "houston_ship_channel", "Houston Ship Channel", 29.50, -94.80, 20),
    (10, "new_orleans_approach", "New Orleans Approach", 29.00, -89.50, 25),
    (11, "tampa_bay_approach", "Tampa Bay Approach", 27.60, -82.80, 20),
    (12, "corpus_christi_approach", "Corpus Christi Approach", 27.70, -97.10, 20),
]


def sightings(df: DataFrame, key: str, attributes: list[str], ts: str) -> DataFrame:
    """One row per key and combination of attributes: when seen first and last, and how often.

    A hash aggregate that shrinks a vessel's pings to its few combinations on the
    map side, so the order-dependent choice of values works on little data.
    """
    return df.groupBy(key, *attributes).agg(
        F.min(ts).alias("seen_first"), F.max(ts).alias("seen_last"), F.count(F.lit(1)).alias("n_seen")
    )


def latest_known(value: str) -> Column:
    """The value seen last; the larger one of two seen last together."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct("seen_last", value)))


def dim_vessels(staged: DataFrame) -> DataFrame:
    """One row per vessel with its latest known attributes and its activity."""
    plain = ["imo", "vessel_name", "vessel_type_code", "call_sign", "cargo_code", "transceiver_class"]
    sizes = ["length_m", "width_m", "draft_m"]
    seen = sightings(staged, "mmsi", plain + sizes, "position_ts")
    per_vessel = seen.groupBy(F.col("mmsi").alias("vessel_key")).agg(
        *[latest_known(c).alias(c) for c in plain],
        *[parity_round(latest_known(c), 1).alias(c) for c in sizes],
        F.sum("n_seen").alias("total_pings"),
        F.min("seen_first").alias("first_seen"),
        F.max("seen_last").alias("last_seen"),
    )
    return per_vessel.withColumn("vessel_type_desc", vessel_type_desc(F.col("vessel_type_code"))).select(
        "vessel_key",
        "imo",
        "vessel_name",
        "vessel_type_code",
        "vessel_type_desc",
        "call_sign",
        *sizes,
        "cargo_code",
        "transceiver_class",
        "total_pings",
        "first_seen",
        "last_seen",
    )


def hour_range(spark: SparkSession, start: str = CALENDAR_START, hours: int = CALENDAR_HOURS) -> DataFrame:
    """Consecutive hours from ``start``."""
    first = F.unix_timestamp(F.lit(start).cast("timestamp"))
    return spark.range(hours).select(F.timestamp_seconds(first + F.col("id") * 3600).alias("time_key"))


def dim_time(spark: SparkSession, start: str = CALENDAR_START, hours: int = CALENDAR_HOURS) -> DataFrame:
    """Hourly calendar; Sunday is day 0 of the week."""
    ts = F.col("time_key")
    weekday = (F.dayofweek(ts) - 1).cast("long")
    return hour_range(spark, start, hours).select(
        "time_key",
        F.to_date(ts).alias("date_key"),
        F.hour(ts).cast("long").alias("hour"),
        weekday.alias("day_of_week"),
        F.dayofmonth(ts).cast("long").alias("day_of_month"),
        F.month(ts).cast("long").alias("month"),
        F.quarter(ts).cast("long").alias("quarter"),
        F.year(ts).cast("long").alias("year"),
        F.when(weekday.isin(0, 6), 1).otherwise(0).alias("is_weekend"),
        season(F.month(ts)).alias("season"),
        F.when(F.month(ts).isin(9, 10, 11, 12, 1, 2), 1).otherwise(0).alias("is_peak_trade_season"),
        watch_period(F.hour(ts)).alias("watch_period"),
    )


def dim_weather_zones(spark: SparkSession) -> DataFrame:
    schema = "zone_key int, zone_code string, zone_name string, center_lat double, center_lon double, radius_nm int"
    return spark.createDataFrame(WEATHER_ZONES, schema)


def obt_vessel_tracking(fact: DataFrame, vessels: DataFrame, calendar: DataFrame) -> DataFrame:
    """Position fact widened with vessel and calendar attributes.

    The calendar has a fixed size, so it is broadcast; vessels grow with the
    data and carry no hint. The join on vessels may be skewed by one busy
    vessel, which the adaptive skew join splits.
    """
    vessel_part = vessels.select(
        "vessel_key", "vessel_name", "imo", "vessel_type_desc", "length_m", "width_m", "draft_m", "call_sign"
    )
    hour_part = calendar.select(
        "time_key",
        "date_key",
        "hour",
        "day_of_week",
        "month",
        "quarter",
        "year",
        "season",
        "is_peak_trade_season",
        "watch_period",
    )
    return (
        fact.drop("vessel_type_code")
        .join(F.broadcast(hour_part), "time_key", "left")
        .join(vessel_part, "vessel_key", "left")
        .select(
            "vessel_key",
            "position_ts",
            "latitude",
            "longitude",
            "sog",
            "cog",
            "heading",
            "nav_status",
            "distance_nm",
            "time_gap_minutes",
            *vessel_part.columns[1:],
            *hour_part.columns[1:],
        )
    )
