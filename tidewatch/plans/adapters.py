"""Driver tables shaped as vessel positions, ports and weather.

The SQL means the same in Spark and in the engine of the checks, so both sides
start from one text. Doubles are written with an exponent because a plain
decimal literal is a decimal in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AIS_SQL = """
with pings as (
  select event_id, user_id, event_type, value, cast(ts as timestamp) as ts, 0 as dup from {events}
  union all
  select event_id, user_id, event_type, value, cast(ts as timestamp) as ts, 1 as dup from {events} where event_id % 10 = 0)
select cast(user_id as string) as MMSI, ts as BaseDateTime,
  case when event_id % 97 = 0 then 0e0 when event_id % 89 = 0 then 95e0
       else 18e0 + (user_id * 7919 % 1300) / 100e0
            + case when event_type = 'error' then (event_id % 200) / 100e0 else (event_id % 10) / 1000e0 end end as LAT,
  -98e0 + (user_id * 104729 % 1800) / 100e0
    + case when event_type = 'error' then (event_id % 300) / 100e0 else (event_id % 7) / 1000e0 end as LON,
  least(greatest(value - 20e0, 0e0) / 10e0, 102.3e0) as SOG,
  (event_id * 31 % 100) * 3.6e0 as COG,
  case when event_id % 4 = 0 then null else (event_id * 37 % 100) * 3.6e0 end as Heading,
  case when user_id % 7 = 0 then '  ' else concat(' Vessel_', cast(user_id as string), ' ') end as VesselName,
  case when user_id % 5 = 0 then '' else concat('IMO', cast(user_id as string)) end as IMO,
  concat('WD', cast(user_id as string)) as CallSign,
  case when user_id % 11 = 0 then null when user_id % 9 = 0 then 30 when user_id % 9 = 1 then 36
       when user_id % 9 = 2 then 37 when user_id % 9 = 3 then 40 when user_id % 9 = 4 then 52
       when user_id % 9 = 5 then 60 when user_id % 9 = 6 then 70 when user_id % 9 = 7 then 80 else 99 end as VesselType,
  case when value < 25e0 then 1 else 0 end as Status,
  20e0 + user_id % 200 + dup * 5 as Length, 5e0 + user_id % 30 as Width, 1e0 + user_id % 12 as Draft,
  cast(user_id % 99 as string) as Cargo, case when user_id % 6 = 0 then 'B' else 'A' end as TransceiverClass
from pings
"""

PORTS_SQL = """
select cast(s_suppkey as int) as port_index,
  case when s_suppkey % 50 = 49 then null else s_name end as port_name, n_name as country,
  18e0 + (s_suppkey * 7919 % 1300) / 100e0 as latitude, -98e0 + (s_suppkey * 104729 % 1800) / 100e0 as longitude,
  case s_suppkey % 6 when 0 then 'Large' when 1 then 'Medium' when 2 then 'Small' when 3 then 'Very Small'
       when 4 then 'Large' else null end as harbor_size,
  case when s_suppkey % 4 = 0 then null else 'Coastal Natural' end as harbor_type,
  case when s_suppkey % 5 = 0 then null else 'Good' end as shelter_quality,
  5e0 + s_suppkey % 15 as channel_depth_m, 4e0 + s_suppkey % 13 as anchorage_depth_m,
  3e0 + s_suppkey % 11 as cargo_pier_depth_m,
  case when s_suppkey % 3 = 0 then null else 'Yes' end as has_dry_dock,
  case when s_suppkey % 2 = 0 then 'Yes' else 'No' end as has_railway,
  'Yes' as has_provisions, 'Yes' as has_fuel_oil,
  cast(100 + s_suppkey % 4 * 100 as int) as max_vessel_length_m, (s_suppkey % 60) / 10e0 as tide_range_m
from {supplier} join {nation} on s_nationkey = n_nationkey
"""

WEATHER_SQL = """
select concat('zone_', cast(o_orderkey % 12 as string)) as zone_name, cast(o_orderkey % 12 as double) as latitude,
  -1e0 * (o_orderkey % 12) as longitude, cast(o_orderdate as timestamp) as timestamp_utc,
  (o_orderkey % 50) / 10e0 as wave_height_m, (o_orderkey * 7 % 360) * 1e0 as wave_direction_deg,
  2e0 + o_orderkey % 12 as wave_period_s, (o_orderkey % 30) / 10e0 as wind_wave_height_m,
  (o_orderkey % 20) / 10e0 as swell_wave_height_m,
  case when o_orderkey % 41 = 0 then null else (o_custkey * 13 + o_orderkey) % 1300 / 10e0 end as wind_speed_10m_kmh,
  (o_orderkey * 11 % 360) * 1e0 as wind_direction_10m_deg, (o_orderkey % 1500) / 10e0 as wind_gusts_10m_kmh
from {orders}
"""

_TABLES = {AIS_SQL: ["events"], PORTS_SQL: ["supplier", "nation"], WEATHER_SQL: ["orders"]}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _adapt(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, **{name: driver_table(spark, sf_dir, name) for name in _TABLES[text]})


def ais_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adapt(spark, sf_dir, AIS_SQL)


def ais_from_events(events: DataFrame) -> DataFrame:
    """The position adapter over any frame of events, a stream included."""
    return events.sparkSession.sql(AIS_SQL, events=events)


def raw_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adapt(spark, sf_dir, PORTS_SQL)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adapt(spark, sf_dir, WEATHER_SQL)
