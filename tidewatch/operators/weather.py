"""Marine weather cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import beaufort, kmh_to_kts

# Bronze column -> silver column.
WEATHER_COLUMNS = {
    "latitude": "latitude",
    "longitude": "longitude",
    "wave_height_m": "wave_height_m",
    "wave_direction_deg": "wave_direction_deg",
    "wave_period_s": "wave_period_s",
    "wind_wave_height_m": "wind_wave_height_m",
    "swell_wave_height_m": "swell_wave_height_m",
    "wind_speed_10m_kmh": "wind_speed_kmh",
    "wind_direction_10m_deg": "wind_direction_deg_10m",
    "wind_gusts_10m_kmh": "wind_gusts_kmh",
}


def clean_weather(raw: DataFrame) -> DataFrame:
    """Typed readings with a time."""
    return raw.filter(F.col("timestamp_utc").isNotNull()).select(
        "zone_name",
        F.col("timestamp_utc").cast("timestamp").alias("weather_ts"),
        *[F.col(old).cast("double").alias(new) for old, new in WEATHER_COLUMNS.items()],
    )


def with_wind_scales(weather: DataFrame) -> DataFrame:
    """Wind in knots and on the Beaufort scale."""
    kmh = F.col("wind_speed_kmh")
    return weather.withColumn("wind_speed_kts", kmh_to_kts(kmh)).withColumn("beaufort_scale", beaufort(kmh))


def stage_weather(raw: DataFrame) -> DataFrame:
    return with_wind_scales(clean_weather(raw))
