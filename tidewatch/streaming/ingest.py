"""Landed position documents appended to bronze, continuously or once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch import schemas
from tidewatch.sources.ais import broken_positions, flatten_positions


def ingest_stream(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    *,
    once: bool = False,
    seconds: int = 30,
    files_per_batch: int | None = None,
    multi_line: bool = True,
    incomplete: bool = False,
    broken: bool = False,
) -> StreamingQuery:
    """Start appending new documents from ``landing`` to the table at ``target``.

    The file sink and the checkpoint make every document count once, also after
    a restart. Rows without a vessel or a time are left out; a second stream with
    ``incomplete=True`` collects those, and one with ``broken=True`` collects
    (path, text) of the documents that do not parse.
    Repeated polls of one ping stay in bronze and go when silver is built.
    """
    schema = T.StructType([*schemas.POSITION_DOCUMENT.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    documents = reader.json(landing)
    usable = F.col("MMSI").isNotNull() & F.col("BaseDateTime").isNotNull()
    rows = broken_positions(documents) if broken else flatten_positions(documents).filter(~usable if incomplete else usable)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()
