"""Hourly weather documents: parallel arrays per zone, in two payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas

_KEYS = ["zone_name", "timestamp_utc"]


def read_hourly(spark: SparkSession, path: str, variables: dict[str, str]) -> DataFrame:
    """Landed documents, one per line; ``_corrupt`` holds the text of a broken one, ``polled`` when and where it landed."""
    schema = schemas.hourly_document(list(variables)).add(schemas.CORRUPT, "string")
    documents = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )
    return documents.withColumn("polled", F.struct("_metadata.file_modification_time", "_metadata.file_path"))


def _rows(documents: DataFrame, variables: dict[str, str]) -> DataFrame:
    """One row per zone and hour: that of the newest document, if polls overlap."""
    if "polled" not in documents.columns:
        documents = documents.withColumn("polled", F.lit(0))
    arrays = F.arrays_zip("hourly.time", *[f"hourly.{v}" for v in variables])
    hour = documents.select("zone_name", "latitude", "longitude", "polled", F.explode(arrays).alias("h"))
    values = F.struct("latitude", "longitude", *[F.col("h")[v].alias(column) for v, column in variables.items()])
    newest = (
        hour.select("zone_name", F.to_timestamp(F.col("h")["time"]).alias("timestamp_utc"), "polled", values.alias("values"))
        .groupBy(*_KEYS)
        .agg(F.max(F.struct("polled", "values")).alias("newest"))
    )
    return newest.select(*_KEYS, "newest.values.*")


def flatten_weather(waves: DataFrame, winds: DataFrame) -> DataFrame:
    """One row per zone and hour of the wave payload, with the wind of the same hour.

    The payloads are matched by zone and time; on well-formed documents that
    equals matching by position. Polls that overlap give their newest value. A
    zone without any wind document is left out, as a failed fetch is.
    """
    wind_rows = _rows(winds, schemas.WIND_VARIABLES).drop("latitude", "longitude")
    with_wind = winds.filter(F.col("hourly").isNotNull()).select("zone_name").distinct()
    wave_rows = _rows(waves, schemas.WAVE_VARIABLES).join(with_wind, "zone_name", "left_semi")
    return wave_rows.join(wind_rows, _KEYS, "left").select(*schemas.WEATHER.names)


def load_weather(spark: SparkSession, wave_path: str, wind_path: str) -> DataFrame:
    """All zones from the landed files; broken documents are left out (see ``broken_documents``)."""
    waves = read_hourly(spark, wave_path, schemas.WAVE_VARIABLES).filter(F.col(schemas.CORRUPT).isNull())
    winds = read_hourly(spark, wind_path, schemas.WIND_VARIABLES).filter(F.col(schemas.CORRUPT).isNull())
    return flatten_weather(waves, winds)


def broken_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text of the documents that do not parse."""
    text = spark.read.text(path)
    parsed = F.from_json("value", "zone_name string, hourly struct<time: array<string>>", {"mode": "PERMISSIVE"})
    return text.filter(parsed["hourly"].isNull())
