"""Deduplicated pings and voyages as streams: aggregates that a watermark closes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _nulls_last(name: str) -> list[Column]:
    return [F.col(name).isNull().alias(f"no_{name}"), F.col(name)]


def dedup_stream(clean: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One ping per (vessel, time) of a stream of cleaned pings, the same one that ``dedup_positions`` keeps.

    A ping is decided once the watermark, ``delay`` behind the newest ping, has
    passed its time; then its state goes. The state is one row for every
    (vessel, time) within the delay, however often the ping is repeated, and
    repeats are merged before the exchange. Later repeats are dropped and
    counted by Spark (``late_rows``). Works on a batch as well.
    """
    ties = [c for c in clean.columns if c not in ("mmsi", "position_ts")]
    order = [(-F.coalesce("length_m", F.lit(0.0))).alias("shortness")]
    for name in ties:
        order += _nulls_last(name)
    best = clean.withWatermark("position_ts", delay).groupBy("mmsi", "position_ts").agg(F.min(F.struct(*order)).alias("best"))
    return best.select(*[F.col(c) if c in ("mmsi", "position_ts") else F.col(f"best.{c}") for c in clean.columns])


def voyages(pings: DataFrame, gap: str = "2 hours", delay: str = "1 hour") -> DataFrame:
    """One row per voyage: pings of a vessel without a silence of ``gap`` or more between them.

    Sessions of different micro-batches that touch are merged while they are in
    the state; one is complete once the watermark has passed its end, ``gap``
    after its last ping. A ping that is too late joins no voyage. Works on a
    batch and on a stream, with the same rows. Rows are merged before the
    exchange, so a vessel with very many pings sends its sessions only.
    """
    session = F.session_window("position_ts", gap)
    found = pings.withWatermark("position_ts", delay).groupBy("mmsi", session).agg(
        F.count(F.lit(1)).alias("n_pings"),
        F.min("position_ts").alias("start_ts"),
        F.max("position_ts").alias("end_ts"),
        F.min(F.struct("position_ts", "latitude", "longitude")).alias("first"),
        F.max(F.struct("position_ts", "latitude", "longitude")).alias("last"),
        F.max("sog").alias("top_sog"),
    )
    return found.select(
        "mmsi",
        "start_ts",
        "end_ts",
        "n_pings",
        F.col("first.latitude").alias("start_lat"),
        F.col("first.longitude").alias("start_lon"),
        F.col("last.latitude").alias("end_lat"),
        F.col("last.longitude").alias("end_lon"),
        "top_sog",
    )


def append_stream(rows: DataFrame, target: str, checkpoint: str, *, once: bool = False, seconds: int = 30) -> StreamingQuery:
    """Start appending a stream's rows to the table at ``target``; each row counts once, also after a restart."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def late_rows(stream: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, over the progress that Spark still keeps."""
    return sum(state["numRowsDroppedByWatermark"] for progress in stream.recentProgress for state in progress["stateOperators"])


def state_rows(stream: StreamingQuery) -> list[int]:
    """Rows in the state after each batch."""
    return [sum(state["numRowsTotal"] for state in progress["stateOperators"]) for progress in stream.recentProgress]
