"""Registered queries: cleansing, events, facts and dimensions (SIL-*, GLD-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import functions as fn
from tidewatch.operators import anomalies, dimensions, port_calls, ports, positions, weather
from tidewatch.plans import adapters, oracles
from tidewatch.plans.oracles import check_sql
from tidewatch.plans.registry import query


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.ais_raw(spark, sf_dir)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.stage_positions(_raw(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.fct_vessel_positions(_staged(spark, sf_dir))


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port_calls.near_ports(_staged(spark, sf_dir), adapters.raw_ports(spark, sf_dir))


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port_calls.stage_port_calls(_staged(spark, sf_dir), adapters.raw_ports(spark, sf_dir))


@query("sil1_valid_positions", check_sql("select * from valid"))
def _(spark, sf_dir):
    return positions.valid_positions(_raw(spark, sf_dir))


@query("sil2_clean_positions", check_sql("select * from clean", clean_from="ais"))
def _(spark, sf_dir):
    return positions.clean_positions(_raw(spark, sf_dir))


@query(
    "sil3_blank_to_null",
    check_sql(
        """select MMSI as mmsi, BaseDateTime as position_ts, nullif(trim(VesselName), '') as vessel_name,
 nullif(trim(IMO), '') as imo, nullif(trim(CallSign), '') as call_sign, nullif(trim(Cargo), '') as cargo_code,
 nullif(trim(TransceiverClass), '') as transceiver_class from ais"""
    ),
)
def _(spark, sf_dir):
    columns = {
        "VesselName": "vessel_name",
        "IMO": "imo",
        "CallSign": "call_sign",
        "Cargo": "cargo_code",
        "TransceiverClass": "transceiver_class",
    }
    return _raw(spark, sf_dir).select(
        F.col("MMSI").alias("mmsi"),
        F.col("BaseDateTime").alias("position_ts"),
        *[fn.blank_to_null(F.col(old)).alias(new) for old, new in columns.items()],
    )


@query(
    "sil4_heading_fallback",
    check_sql(
        """select MMSI as mmsi, BaseDateTime as position_ts, Heading as reported, COG as cog,
 coalesce(Heading, COG) as heading from ais"""
    ),
)
def _(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(
        F.col("MMSI").alias("mmsi"),
        F.col("BaseDateTime").alias("position_ts"),
        F.col("Heading").alias("reported"),
        F.col("COG").alias("cog"),
        F.coalesce("Heading", "COG").alias("heading"),
    )


@query("sil5_dedup_positions", check_sql("select * from stg"))
def _(spark, sf_dir):
    return _staged(spark, sf_dir)


_NEAR = "select mmsi, position_ts, latitude, longitude, sog, port_id, port_name, round(dist_deg, 6) as dist_deg from near"


@query("sil6_near_ports", check_sql(_NEAR))
def _(spark, sf_dir):
    return _near(spark, sf_dir).withColumn("dist_deg", fn.parity_round(F.col("dist_deg"), 6))


@query("sil6_near_ports_salted", check_sql(_NEAR))
def _(spark, sf_dir):
    pairs = port_calls.near_ports(_staged(spark, sf_dir), adapters.raw_ports(spark, sf_dir), salts=4)
    return pairs.withColumn("dist_deg", fn.parity_round(F.col("dist_deg"), 6))


@query(
    "sil7_port_events",
    check_sql(
        "select mmsi, position_ts, port_id, port_name, sog, latitude, longitude, event_type from port_evt"
    ),
)
def _(spark, sf_dir):
    return port_calls.port_events(_near(spark, sf_dir)).drop("dist_deg")


@query("sil8_port_calls", check_sql("select * from calls"))
def _(spark, sf_dir):
    return _calls(spark, sf_dir)


@query(
    "sil8_port_calls_next_departure",
    check_sql(
        """select a.mmsi, a.port_id, a.port_name, a.position_ts as arrival_ts, a.departure_ts,
 a.latitude as arrival_lat, a.longitude as arrival_lon,
 round(epoch(a.departure_ts - a.position_ts) / 3600e0, 2) as duration_hours from (
 select *, min(case when event_type = 'departure' then position_ts end) over (partition by mmsi, port_id
 order by position_ts rows between 1 following and unbounded following) as departure_ts
 from port_evt where event_type is not null) a where a.event_type = 'arrival'"""
    ),
)
def _(spark, sf_dir):
    return port_calls.stage_port_calls(
        _staged(spark, sf_dir), adapters.raw_ports(spark, sf_dir), departure="next_departure"
    )


@query("sil9_clean_ports", check_sql("select * from ports_stg"))
def _(spark, sf_dir):
    return ports.clean_ports(adapters.raw_ports(spark, sf_dir))


@query("sil10_clean_weather", check_sql("select * from wx"))
def _(spark, sf_dir):
    return weather.clean_weather(adapters.raw_weather(spark, sf_dir))


@query(
    "sil11_kmh_to_kts",
    check_sql("select zone_name, weather_ts, wind_speed_kmh, wind_speed_kts from wx_scaled"),
)
def _(spark, sf_dir):
    clean = weather.clean_weather(adapters.raw_weather(spark, sf_dir))
    return clean.select(
        "zone_name", "weather_ts", "wind_speed_kmh", fn.kmh_to_kts(F.col("wind_speed_kmh")).alias("wind_speed_kts")
    )


@query("sil12_beaufort", check_sql("select * from wx_scaled"))
def _(spark, sf_dir):
    return weather.stage_weather(adapters.raw_weather(spark, sf_dir))


@query(
    "gld1_with_previous",
    check_sql("select mmsi, position_ts, latitude, longitude, prev_lat, prev_lon, prev_ts from prev"),
)
def _(spark, sf_dir):
    staged = _staged(spark, sf_dir).select("mmsi", "position_ts", "latitude", "longitude")
    return positions.with_previous(staged)


@query("gld2_haversine", check_sql("select vessel_key, position_ts, distance_nm from fct"))
def _(spark, sf_dir):
    legs = positions.with_previous(_staged(spark, sf_dir))
    ends = [F.col(c) for c in ("prev_lat", "prev_lon", "latitude", "longitude")]
    return legs.select(F.col("mmsi").alias("vessel_key"), "position_ts", fn.haversine_nm(*ends).alias("distance_nm"))


@query("gld3_gap_minutes", check_sql("select vessel_key, position_ts, time_gap_minutes from fct"))
def _(spark, sf_dir):
    legs = positions.with_previous(_staged(spark, sf_dir))
    gap = fn.gap_minutes(F.col("position_ts"), F.col("prev_ts"))
    return legs.select(F.col("mmsi").alias("vessel_key"), "position_ts", gap.alias("time_gap_minutes"))


@query(
    "gld4_time_key",
    check_sql(
        """select cast(date_trunc('hour', position_ts) as timestamp) as time_key, count(*) as n_pings
 from stg group by 1"""
    ),
)
def _(spark, sf_dir):
    hours = _staged(spark, sf_dir).select(fn.time_key(F.col("position_ts")).alias("time_key"))
    return hours.groupBy("time_key").agg(F.count(F.lit(1)).alias("n_pings"))


@query("gld5_fct_vessel_positions", check_sql("select * from fct"))
def _(spark, sf_dir):
    return _fact(spark, sf_dir)


@query(
    "gld6_implied_speed",
    check_sql("select vessel_key, position_ts, distance_nm, time_gap_minutes, implied_speed_kts from speeds"),
)
def _(spark, sf_dir):
    return anomalies.with_implied_speed(_fact(spark, sf_dir)).select(
        "vessel_key", "position_ts", "distance_nm", "time_gap_minutes", "implied_speed_kts"
    )


@query("gld7_anomaly_filter", check_sql("select * from flagged"))
def _(spark, sf_dir):
    return anomalies.anomaly_filter(anomalies.with_implied_speed(_fact(spark, sf_dir)))


@query(
    "gld8_anomaly_type",
    check_sql(f"select vessel_key, position_ts, {oracles.KIND_OF_ANOMALY} as anomaly_type from speeds"),
)
def _(spark, sf_dir):
    evidence = [F.col(c) for c in ("time_gap_minutes", "distance_nm", "implied_speed_kts")]
    return anomalies.with_implied_speed(_fact(spark, sf_dir)).select(
        "vessel_key", "position_ts", fn.anomaly_type(*evidence).alias("anomaly_type")
    )


@query("gld9_risk_score", check_sql(f"select vessel_key, position_ts, {oracles.RISK} as risk_score from speeds"))
def _(spark, sf_dir):
    evidence = [F.col(c) for c in ("time_gap_minutes", "distance_nm", "implied_speed_kts")]
    return anomalies.with_implied_speed(_fact(spark, sf_dir)).select(
        "vessel_key", "position_ts", fn.risk_score(*evidence).alias("risk_score")
    )


@query("gld10_ais_anomalies", check_sql("select * from anom"))
def ais_anomalies(spark, sf_dir):
    return anomalies.fct_ais_anomalies(_fact(spark, sf_dir))


@query(
    "gld11_extended_stay",
    check_sql(
        """select case when duration_hours > 48 then 1 else 0 end as is_extended_stay, count(*) as n_calls,
 min(duration_hours) as shortest, max(duration_hours) as longest from calls group by 1"""
    ),
)
def _(spark, sf_dir):
    return (
        _calls(spark, sf_dir)
        .groupBy(fn.is_extended_stay(F.col("duration_hours")).alias("is_extended_stay"))
        .agg(
            F.count(F.lit(1)).alias("n_calls"),
            F.min("duration_hours").alias("shortest"),
            F.max("duration_hours").alias("longest"),
        )
    )


@query(
    "gld12_stay_category",
    check_sql(
        f"""select {oracles.STAY} as stay_category, count(*) as n_calls, min(duration_hours) as shortest,
 max(duration_hours) as longest from calls group by 1"""
    ),
)
def _(spark, sf_dir):
    return (
        _calls(spark, sf_dir)
        .groupBy(fn.stay_category(F.col("duration_hours")).alias("stay_category"))
        .agg(
            F.count(F.lit(1)).alias("n_calls"),
            F.min("duration_hours").alias("shortest"),
            F.max("duration_hours").alias("longest"),
        )
    )


@query("gld13_fct_port_calls", check_sql("select * from fpc"))
def _(spark, sf_dir):
    return port_calls.fct_port_calls(_calls(spark, sf_dir))


@query("gld14_dim_vessels", check_sql("select * from dv"))
def _(spark, sf_dir):
    return dimensions.dim_vessels(_staged(spark, sf_dir))


@query(
    "gld15_vessel_type_desc",
    check_sql(
        f"""select vessel_type_code, {oracles.VESSEL_TYPE.format(c="vessel_type_code")} as vessel_type_desc,
 count(*) as n_pings from stg group by 1, 2"""
    ),
)
def _(spark, sf_dir):
    code = F.col("vessel_type_code")
    return (
        _staged(spark, sf_dir)
        .groupBy(code, fn.vessel_type_desc(code).alias("vessel_type_desc"))
        .agg(F.count(F.lit(1)).alias("n_pings"))
    )


@query("gld16_dim_ports", check_sql("select * from dp"))
def _(spark, sf_dir):
    return ports.dim_ports(ports.clean_ports(adapters.raw_ports(spark, sf_dir)))


def _pings_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = positions.valid_positions(_raw(spark, sf_dir)).select(fn.time_key(F.col("BaseDateTime")).alias("time_key"))
    return hours.groupBy("time_key").agg(F.count(F.lit(1)).alias("n_pings"))


_PER_HOUR = {"per_hour": "select date_trunc('hour', BaseDateTime) as h, count(*) as n from valid group by 1"}


@query(
    "gld17_dim_time",
    check_sql(
        """select c.*, coalesce(n, 0) as n_pings from cal c left join per_hour on h = c.time_key""", **_PER_HOUR
    ),
)
def _(spark, sf_dir):
    return (
        dimensions.dim_time(spark)
        .join(_pings_per_hour(spark, sf_dir), "time_key", "left")
        .withColumn("n_pings", F.coalesce("n_pings", F.lit(0)))
    )


@query("gld18_obt_vessel_tracking", check_sql("select * from obt"))
def _(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return dimensions.obt_vessel_tracking(
        positions.fct_vessel_positions(staged), dimensions.dim_vessels(staged), dimensions.dim_time(spark)
    )


def _readings_per_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = adapters.raw_weather(spark, sf_dir)
    zone_key = (F.regexp_extract("zone_name", r"(\d+)$", 1).cast("int") + 1).alias("zone_key")
    return readings.groupBy(zone_key).agg(
        F.count(F.lit(1)).alias("n_readings"), F.max("wave_height_m").alias("highest_wave_m")
    )


@query(
    "gld19_dim_weather_zones",
    check_sql(
        """select z.*, coalesce(n, 0) as n_readings, highest_wave_m from zones z left join (
 select cast(regexp_extract(zone_name, '(\\d+)$', 1) as integer) + 1 as k, count(*) as n, max(wave_height_m) as highest_wave_m
 from wx_raw group by 1) on k = z.zone_key"""
    ),
)
def _(spark, sf_dir):
    return (
        dimensions.dim_weather_zones(spark)
        .join(_readings_per_zone(spark, sf_dir), "zone_key", "left")
        .withColumn("n_readings", F.coalesce("n_readings", F.lit(0)))
    )
