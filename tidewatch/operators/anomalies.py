"""Signal gaps and impossible jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import anomaly_type, implied_speed, risk_score
from tidewatch.functions.labels import BLACKOUT_MIN, IMPOSSIBLE_KTS


def with_implied_speed(fact: DataFrame) -> DataFrame:
    return fact.withColumn("implied_speed_kts", implied_speed(F.col("distance_nm"), F.col("time_gap_minutes")))


def anomaly_filter(fact: DataFrame) -> DataFrame:
    """Legs after a long silence or faster than any vessel."""
    return fact.filter(
        F.col("time_gap_minutes").isNotNull()
        & ((F.col("time_gap_minutes") > BLACKOUT_MIN) | (F.col("implied_speed_kts") > IMPOSSIBLE_KTS))
    )


def fct_ais_anomalies(fact: DataFrame) -> DataFrame:
    evidence = (F.col("time_gap_minutes"), F.col("distance_nm"), F.col("implied_speed_kts"))
    return anomaly_filter(with_implied_speed(fact)).select(
        "vessel_key",
        F.col("position_ts").alias("anomaly_ts"),
        F.col("latitude").alias("last_known_lat"),
        F.col("longitude").alias("last_known_lon"),
        F.col("sog").alias("last_known_sog"),
        "time_key",
        "time_gap_minutes",
        F.col("distance_nm").alias("distance_gap_nm"),
        "implied_speed_kts",
        anomaly_type(*evidence).alias("anomaly_type"),
        risk_score(*evidence).alias("risk_score"),
    )
