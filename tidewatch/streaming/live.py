"""Latest position per vessel, refreshed on every tick."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.serving import latest_per_vessel, top


def tick(latest: DataFrame, vessels: DataFrame, anomalies: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` most recent vessels, named, with both totals and the time of the tick."""
    order = [F.col("position_ts").desc_nulls_last(), F.col("vessel_key").asc_nulls_last()]
    names = vessels.select("vessel_key", "vessel_name", "vessel_type_desc")

    def size(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    return (
        top(latest, n, *order)
        .join(names, "vessel_key", "left")
        .withColumns(
            {"total_vessels": size(vessels), "anomaly_count": size(anomalies), "emitted_at": F.current_timestamp()}
        )
    )


def live_tick_stream(
    positions: DataFrame,
    vessels: Callable[[], DataFrame],
    anomalies: Callable[[], DataFrame],
    target: str,
    checkpoint: str,
    *,
    once: bool = False,
    seconds: int = 5,
    n: int = 100,
) -> StreamingQuery:
    """Start writing ticks below ``target`` as ``tick=<batch>`` folders.

    ``positions`` is a stream of cleaned pings. The state is one row per vessel.
    ``vessels`` and ``anomalies`` are called at every tick and read their tables
    anew, so names and totals follow tables that grow; the totals are counts of
    stored rows, which Parquet keeps in its footers.
    A batch that is run again replaces its own folder, so a tick is never doubled.
    """
    latest = latest_per_vessel(positions.withColumnRenamed("mmsi", "vessel_key"))

    def emit(batch: DataFrame, batch_id: int) -> None:
        tick(batch, vessels(), anomalies(), n).write.mode("overwrite").parquet(f"{target}/tick={batch_id}")

    writer = latest.writeStream.outputMode("complete").foreachBatch(emit).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()
