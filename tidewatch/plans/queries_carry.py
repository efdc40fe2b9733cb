"""Registered queries: weather as of a ping, and weather gaps filled forward (DQ-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import carry
from tidewatch.plans.oracles import check_sql
from tidewatch.plans.registry import query, warehouse

# The driver's zones and dates lie apart from its pings: both are moved among them, the same way in Spark and in the check.
_MOVED = {
    "zone_name": "zone_name",
    "weather_ts": "timestamp '2024-01-01 00:00:00' + {seconds}",
    "latitude": "18e0 + latitude * 1.2e0",
    "longitude": "-98e0 + latitude * 1.6e0",
    "wave_height_m": "case when wave_height_m > 4e0 then null else wave_height_m end",
    "wind_speed_kmh": "wind_speed_kmh",
}
_SECONDS = "((cast(wave_height_m * 10 as bigint) * 86400 + cast(wind_direction_deg_10m as bigint) * 977) % 2600000)"
_COLUMNS = ["wave_height_m", "wind_speed_kmh"]


def _moved(spark, sf_dir) -> DataFrame:
    weather = warehouse(spark, sf_dir).table("stg_marine_weather")
    seconds = f"make_interval(0, 0, 0, 0, 0, 0, {_SECONDS})"
    return weather.selectExpr(*[f"{text.format(seconds=seconds)} AS {name}" for name, text in _MOVED.items()])


_READINGS = "select distinct " + ", ".join(f"{t.format(seconds=f'to_seconds({_SECONDS})')} as {n}" for n, t in _MOVED.items()) + " from wx"
_AS_OF = {
    "moved": _READINGS,
    "reading": """select zone_name, weather_ts, wave_height_m, wind_speed_kmh from moved qualify row_number() over
 (partition by zone_name, weather_ts order by wave_height_m desc nulls last, wind_speed_kmh desc nulls last) = 1""",
    "placed": """select s.mmsi, s.position_ts, arg_min(z.zone_name, (sqrt(power(s.latitude - z.latitude, 2) + power(s.longitude - z.longitude, 2)), z.zone_name)) filter
 (where sqrt(power(s.latitude - z.latitude, 2) + power(s.longitude - z.longitude, 2)) < 3e0) as zone_name
 from stg s cross join (select distinct zone_name, latitude, longitude from moved) z group by all""",
    "latest": """select p.mmsi, p.position_ts, p.zone_name, r.weather_ts, r.wave_height_m, r.wind_speed_kmh
 from placed p asof left join reading r on p.zone_name = r.zone_name and p.position_ts >= r.weather_ts""",
}


@query(
    "gld20_weather_at_pings",
    check_sql(
        """select mmsi, position_ts, zone_name, case when fresh then weather_ts end as weather_ts, case when fresh then wave_height_m end as wave_height_m,
 case when fresh then wind_speed_kmh end as wind_speed_kmh from (select *, position_ts - weather_ts <= interval 72 hour as fresh from latest)""",
        **_AS_OF,
    ),
)
def _(spark, sf_dir):
    pings = warehouse(spark, sf_dir).table("stg_vessel_positions").select("mmsi", "position_ts", "latitude", "longitude")
    return carry.weather_at_pings(pings, _moved(spark, sf_dir), _COLUMNS).drop("latitude", "longitude")


_FILLED = """select zone_name, hour, case when hour - h1 <= interval 6 hour then v1 end as wave_height_m, case when hour - h2 <= interval 6 hour then v2 end as wind_speed_kmh from (
 select zone_name, hour, last_value(v1 ignore nulls) over w as v1, last_value(case when v1 is not null then hour end ignore nulls) over w as h1,
 last_value(v2 ignore nulls) over w as v2, last_value(case when v2 is not null then hour end ignore nulls) over w as h2
 from (select zone_name, unnest(generate_series(min(date_trunc('hour', weather_ts)), max(date_trunc('hour', weather_ts)), interval 1 hour)) as hour from moved group by 1)
 left join (select zone_name, date_trunc('hour', weather_ts) as hour,
  arg_max(wave_height_m, (weather_ts, wave_height_m)) filter (where wave_height_m is not null) as v1,
  arg_max(wind_speed_kmh, (weather_ts, wind_speed_kmh)) filter (where wind_speed_kmh is not null) as v2 from moved group by all) using (zone_name, hour)
 window w as (partition by zone_name order by hour))"""


@query("dq9_fill_forward", check_sql(_FILLED, moved=_READINGS))
def _(spark, sf_dir):
    return carry.fill_forward(_moved(spark, sf_dir), "zone_name", "weather_ts", _COLUMNS, 6).withColumn("hour", F.col("hour").cast("timestamp"))
