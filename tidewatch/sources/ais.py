"""Vessel positions: bulk Parquet files, frames and landed GeoJSON documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas
from tidewatch.functions import to_int
from tidewatch.sources.files import named_files, parquet_by_schema


def _typed(field: T.StructField) -> Column:
    return to_int(F.col(field.name)) if field.dataType == T.IntegerType() else F.col(field.name).try_cast(field.dataType)


def cast_ais(df: DataFrame) -> DataFrame:
    """The 17 bronze columns with their types.

    Text that does not parse becomes null instead of failing the whole load;
    ``bad_casts`` returns those rows.
    """
    return df.select(*[_typed(f).alias(f.name) for f in schemas.AIS])


def bad_casts(df: DataFrame) -> DataFrame:
    """Rows in which some value is lost by ``cast_ais``."""
    lost = [F.col(f.name).isNotNull() & _typed(f).isNull() for f in schemas.AIS]
    return df.filter(F.array_contains(F.array(*lost), True))


def read_ais(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files, or directories of which ``*.parquet`` and ``*.geoparquet`` are read.

    A file that is named itself is read whatever its ending. Exports differ in
    column types: files of equal types are one scan, each scan is cast on its
    own. Only the 17 known columns are read, so a geometry column is never loaded.
    """
    groups = parquet_by_schema(spark, named_files(spark, list(paths), ["*.parquet", "*.geoparquet"]))
    scans = [cast_ais(spark.read.schema(schema).parquet(*files)) for schema, files in groups]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], schemas.AIS)


def read_position_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed documents; ``_corrupt`` holds the text of one that does not parse."""
    schema = T.StructType([*schemas.POSITION_DOCUMENT.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def broken_positions(documents: DataFrame) -> DataFrame:
    """(path, text) of the landed documents that do not parse, set apart before the append."""
    # Spark parses a document only if a column of it is asked for besides its text.
    parsed = F.coalesce(F.size("features"), F.lit(-1)) >= -1
    return documents.filter(F.col(schemas.CORRUPT).isNotNull() & parsed).select(
        F.col("_metadata.file_path").alias("path"), F.col(schemas.CORRUPT).alias("text")
    )


def _event_time(properties: Column) -> Column:
    return F.timestamp_millis(F.coalesce(properties["timestampExternal"], properties["timestamp"]))


def flatten_positions(documents: DataFrame) -> DataFrame:
    """One bronze row per feature; what the feed does not carry is null.

    Documents that do not parse give no rows (see ``broken_positions``).
    """
    if schemas.CORRUPT in documents.columns:
        documents = documents.filter(F.col(schemas.CORRUPT).isNull())
    properties = F.col("feature.properties")
    coordinates = F.col("feature.geometry.coordinates")
    # Bronze column -> where the document carries it.
    carried = {
        "MMSI": properties["mmsi"].cast("string"),
        "BaseDateTime": _event_time(properties),
        "LAT": F.get(coordinates, F.lit(1)),
        "LON": F.get(coordinates, F.lit(0)),
        "SOG": properties["sog"],
        "COG": properties["cog"],
        "Heading": properties["heading"],
        "VesselType": properties["shipType"],
        "Status": properties["navStat"],
        "Draft": properties["draught"],
    }
    return documents.select(F.explode("features").alias("feature")).select(
        *[carried.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.AIS]
    )


def incomplete_positions(flat: DataFrame) -> DataFrame:
    """Flattened rows without a vessel or a time, set apart before the append."""
    return flat.filter(F.col("MMSI").isNull() | F.col("BaseDateTime").isNull())
