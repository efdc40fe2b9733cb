"""Explicit schemas of the landed files; nothing is inferred on the main path."""

from __future__ import annotations

from pyspark.sql import types as T


# Column names and types of the three bronze tables.
AIS = T.StructType(
    [
        T.StructField("MMSI", T.StringType()),
        T.StructField("BaseDateTime", T.TimestampType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("LON", T.DoubleType()),
        T.StructField("SOG", T.DoubleType()),
        T.StructField("COG", T.DoubleType()),
        T.StructField("Heading", T.DoubleType()),
        T.StructField("VesselName", T.StringType()),
        T.StructField("IMO", T.StringType()),
        T.StructField("CallSign", T.StringType()),
        T.StructField("VesselType", T.IntegerType()),
        T.StructField("Status", T.IntegerType()),
        T.StructField("Length", T.DoubleType()),
        T.StructField("Width", T.DoubleType()),
        T.StructField("Draft", T.DoubleType()),
        T.StructField("Cargo", T.StringType()),
        T.StructField("TransceiverClass", T.StringType()),
    ]
)
PORTS = T.StructType(
    [
        T.StructField("port_index", T.IntegerType()),
        T.StructField("port_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("harbor_size", T.StringType()),
        T.StructField("harbor_type", T.StringType()),
        T.StructField("shelter_quality", T.StringType()),
        T.StructField("channel_depth_m", T.DoubleType()),
        T.StructField("anchorage_depth_m", T.DoubleType()),
        T.StructField("cargo_pier_depth_m", T.DoubleType()),
        T.StructField("has_dry_dock", T.StringType()),
        T.StructField("has_railway", T.StringType()),
        T.StructField("has_provisions", T.StringType()),
        T.StructField("has_fuel_oil", T.StringType()),
        T.StructField("max_vessel_length_m", T.IntegerType()),
        T.StructField("tide_range_m", T.DoubleType()),
    ]
)
WEATHER = T.StructType(
    [
        T.StructField("zone_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timestamp_utc", T.TimestampType()),
        T.StructField("wave_height_m", T.DoubleType()),
        T.StructField("wave_direction_deg", T.DoubleType()),
        T.StructField("wave_period_s", T.DoubleType()),
        T.StructField("wind_wave_height_m", T.DoubleType()),
        T.StructField("swell_wave_height_m", T.DoubleType()),
        T.StructField("wind_speed_10m_kmh", T.DoubleType()),
        T.StructField("wind_direction_10m_deg", T.DoubleType()),
        T.StructField("wind_gusts_10m_kmh", T.DoubleType()),
    ]
)

#: Column that holds a landed document's text where it does not parse.
CORRUPT = "_corrupt"

# Landed position document (GeoJSON FeatureCollection).
POSITION_DOCUMENT = T.StructType().add(
    "features",
    T.ArrayType(
        T.StructType()
        .add("geometry", T.StructType().add("coordinates", T.ArrayType(T.DoubleType())))
        .add(
            "properties",
            T.StructType()
            .add("mmsi", "long")
            .add("timestampExternal", "long")
            .add("timestamp", "long")
            .add("sog", "double")
            .add("cog", "double")
            .add("heading", "double")
            .add("shipType", "integer")
            .add("navStat", "integer")
            .add("draught", "double"),
        )
    ),
)


def hourly_document(variables: list[str]) -> T.StructType:
    """Landed weather document: one time array and one array per variable."""
    hourly = T.StructType().add("time", T.ArrayType(T.StringType()))
    for name in variables:
        hourly = hourly.add(name, T.ArrayType(T.DoubleType()))
    return (
        T.StructType()
        .add("zone_name", "string")
        .add("latitude", "double")
        .add("longitude", "double")
        .add("hourly", hourly)
    )


# Payload variable -> bronze column.
WAVE_VARIABLES = {
    "wave_height": "wave_height_m",
    "wave_direction": "wave_direction_deg",
    "wave_period": "wave_period_s",
    "wind_wave_height": "wind_wave_height_m",
    "swell_wave_height": "swell_wave_height_m",
}
WIND_VARIABLES = {
    "wind_speed_10m": "wind_speed_10m_kmh",
    "wind_direction_10m": "wind_direction_10m_deg",
    "wind_gusts_10m": "wind_gusts_10m_kmh",
}
