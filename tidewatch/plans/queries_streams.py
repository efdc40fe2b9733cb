"""Registered queries: streams with state (STR-3 to STR-5, voyages), over three parts with a restart between them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import positions
from tidewatch.plans import adapters
from tidewatch.plans.oracles import check_sql
from tidewatch.plans.registry import query, warehouse
from tidewatch.session import fresh_path
from tidewatch.streaming import ordered, silver

PARTS = 3


def in_parts(spark: SparkSession, pings: DataFrame, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream appends when the pings land in three parts, each out of order by up to half an hour.

    The stream ends after each part and starts again from its checkpoint. A
    last row moves the clock on, so that nothing waits for the watermark.
    """
    source, target, checkpoint = (fresh_path(spark, n) for n in ("landed", "appended", "progress"))
    landed = F.unix_seconds("position_ts") + F.pmod(F.xxhash64("mmsi", "position_ts"), F.lit(1800))
    low, high, last = pings.agg(F.min(landed), F.max(landed), F.max("position_ts")).first()
    part = F.floor((landed - F.lit(low)) * PARTS / F.lit((high or 0) - (low or 0) + 1))
    ends = [ordered.clock_row(spark, pings.schema, last + timedelta(days=30))] if last else []
    for rows in [*(pings.filter(part == n) for n in range(PARTS)), *ends]:
        rows.write.mode("append").parquet(source)
        silver.append_stream(job(_landed(spark, pings, source)), target, checkpoint, once=True).awaitTermination()
    return spark.read.schema(job(_landed(spark, pings, source)).schema).parquet(target)


def _landed(spark: SparkSession, pings: DataFrame, source: str) -> DataFrame:
    return spark.readStream.schema(pings.schema).parquet(source)


@query("str3_dedup_stream", check_sql("select * from stg"))
def _(spark, sf_dir):
    clean = positions.clean_positions(positions.valid_positions(adapters.ais_raw(spark, sf_dir)))
    return in_parts(spark, clean, silver.dedup_stream)


@query("str4_anomaly_stream", check_sql("select * from anom"))
def _(spark, sf_dir):
    return in_parts(spark, warehouse(spark, sf_dir).table("stg_vessel_positions"), ordered.anomaly_stream)


@query("str5_port_call_stream", check_sql("select * from calls"))
def _(spark, sf_dir):
    fences = adapters.raw_ports(spark, sf_dir)
    appended = in_parts(spark, warehouse(spark, sf_dir).table("stg_vessel_positions"), lambda pings: ordered.port_call_stream(pings, fences))
    return ordered.settled_calls(appended)


_VOYAGES = """
select mmsi, min(position_ts) as start_ts, max(position_ts) as end_ts, count(*) as n_pings,
 arg_min(latitude, position_ts) as start_lat, arg_min(longitude, position_ts) as start_lon,
 arg_max(latitude, position_ts) as end_lat, arg_max(longitude, position_ts) as end_lon, max(sog) as top_sog
from (select *, sum(starts) over (partition by mmsi order by position_ts) as voyage
 from (select *, case when position_ts - lag(position_ts) over (partition by mmsi order by position_ts) < interval 12 hour then 0 else 1 end as starts from stg))
group by mmsi, voyage"""


@query("str6_voyages", check_sql(_VOYAGES))
def _(spark, sf_dir):
    return silver.voyages(warehouse(spark, sf_dir).table("stg_vessel_positions"), "12 hours")


@query("str6_voyages_stream", check_sql(_VOYAGES))
def _(spark, sf_dir):
    return in_parts(spark, warehouse(spark, sf_dir).table("stg_vessel_positions"), lambda pings: silver.voyages(pings, "12 hours"))
