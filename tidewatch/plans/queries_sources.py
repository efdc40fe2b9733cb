"""Registered queries: landing, tables and streams (SRC-*, SNK-*, STR-*).

Each writes the adapted driver tables in the landed format to a fresh path of the
shared folder, then reads them through the source under test.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import positions
from tidewatch.plans import adapters
from tidewatch.plans.oracles import check_sql
from tidewatch.plans.queries_serving import _LATEST, _TABLE_STEPS, _scd2_source_sql
from tidewatch.plans.registry import query, warehouse
from tidewatch.session import fresh_path
from tidewatch.sources import ais, ports, tables, weather
from tidewatch.sources.files import named_files
from tidewatch.streaming.ingest import ingest_stream
from tidewatch.streaming.live import live_tick_stream

_ALL_PINGS = check_sql("select * from ais")


@query("src1_read_ais", _ALL_PINGS)
def _(spark, sf_dir):
    path = fresh_path(spark, "ais")
    adapters.ais_raw(spark, sf_dir).withColumn("geometry", F.col("MMSI").cast("binary")).write.parquet(path)
    return ais.read_ais(spark, path)


@query("src2_discover_files", _ALL_PINGS)
def _(spark, sf_dir):
    """A folder of exports that differ in types, beside other files and a sub-folder; one more file named itself."""
    root, apart = fresh_path(spark, "ais-days"), fresh_path(spark, "ais-apart")
    raw = adapters.ais_raw(spark, sf_dir)
    part = F.second("BaseDateTime") % 3
    raw.filter(part == 0).write.parquet(root)
    wide = raw.withColumns({"VesselType": F.col("VesselType").cast("double"), "MMSI": F.col("MMSI").cast("long"), "LAT": F.col("LAT").cast("string")})
    wide.filter(part == 1).write.mode("append").parquet(root)
    raw.select("MMSI").write.mode("append").option("header", True).csv(root)
    raw.filter(part == 2).withColumn("Status", F.col("Status").cast("long")).write.parquet(apart)
    raw.write.parquet(f"{root}/older")
    return ais.read_ais(spark, root, *named_files(spark, [apart], ["*"]))


@query("src3_cast_ais", _ALL_PINGS)
def _(spark, sf_dir):
    raw = adapters.ais_raw(spark, sf_dir)
    return ais.cast_ais(raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]))


_ALL_PORTS = check_sql("select * from ports_raw")
_AWKWARD_PORTS = check_sql(
    """select * replace (case when port_index % 7 = 0 then null else max_vessel_length_m end as max_vessel_length_m,
 'Port "' || port_name || '", ' || chr(10) || 'North' as port_name) from ports_raw"""
)


def _write_awkward_ports(raw: DataFrame, path: str) -> None:
    """Quotes, commas and line breaks in text, a word in a number column, and columns in another order in a second file."""
    text = raw.withColumns(
        {
            "port_name": F.concat(F.lit('Port "'), "port_name", F.lit('", \nNorth')),
            "max_vessel_length_m": F.when(F.col("port_index") % 7 == 0, "unknown").otherwise(F.col("max_vessel_length_m").cast("string")),
        }
    )
    half = F.col("port_index") % 2 == 0
    for part, columns in ((text.filter(half), raw.columns), (text.filter(~half), raw.columns[::-1])):
        part.select(columns).write.mode("append").option("header", True).option("escape", '"').csv(path)


@query("src4_read_ports", _AWKWARD_PORTS)
def _(spark, sf_dir):
    path = fresh_path(spark, "ports-csv")
    _write_awkward_ports(adapters.raw_ports(spark, sf_dir), path)
    return ports.read_ports(spark, path)


@query("src4_bad_ports", check_sql("select cast(port_index as varchar) as port_index, 'unknown' as max_vessel_length_m from ports_raw where port_index % 7 = 0"))
def _(spark, sf_dir):
    path = fresh_path(spark, "ports-csv")
    _write_awkward_ports(adapters.raw_ports(spark, sf_dir), path)
    return ports.bad_ports(spark, path).select("port_index", "max_vessel_length_m")


@query("src5_publish_ports", _ALL_PORTS)
def _(spark, sf_dir):
    path = fresh_path(spark, "ports")
    raw = adapters.raw_ports(spark, sf_dir)
    tables.publish(raw.limit(1), path)
    return tables.publish(raw, path)


def _position_documents(raw: DataFrame) -> DataFrame:
    """Pings as landed documents of one feature; every other one has only the fallback time."""
    millis = F.unix_millis("BaseDateTime")
    even = millis % 2 == 0
    properties = F.struct(
        F.col("MMSI").cast("long").alias("mmsi"),
        F.when(even, millis).alias("timestampExternal"),
        F.when(~even, millis).alias("timestamp"),
        F.col("SOG").alias("sog"),
        F.col("COG").alias("cog"),
        F.col("Heading").alias("heading"),
        F.col("VesselType").alias("shipType"),
        F.col("Status").alias("navStat"),
        F.col("Draft").alias("draught"),
    )
    geometry = F.struct(F.array("LON", "LAT").alias("coordinates"))
    feature = F.struct(geometry.alias("geometry"), properties.alias("properties"))
    return raw.select(F.array(feature).alias("features"))


_FLAT = check_sql(
    """select MMSI, date_trunc('millisecond', BaseDateTime) as BaseDateTime, LAT, LON, SOG, COG, Heading,
 cast(null as varchar) as VesselName, cast(null as varchar) as IMO, cast(null as varchar) as CallSign, VesselType, Status,
 cast(null as double) as Length, cast(null as double) as Width, Draft, cast(null as varchar) as Cargo,
 cast(null as varchar) as TransceiverClass from ais"""
)


def _land_positions(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    """Good documents, and of every seventh vessel's pings a second document that is cut off."""
    path = fresh_path(spark, "position-documents")
    documents = _position_documents(adapters.ais_raw(spark, sf_dir))
    (documents.repartition(files) if files else documents).write.json(path)
    text = documents.select(F.to_json(F.struct("features")).alias("value"), F.col("features")[0]["properties"]["mmsi"].alias("mmsi"))
    cut = text.filter("mmsi % 7 = 0").select(F.expr("left(value, length(value) - 10)").alias("value"))
    cut.write.mode("append").text(path)
    return path


_CUT_OFF = check_sql("select count(*) as n_broken from ais where cast(MMSI as bigint) % 7 = 0")


@query("src6_flatten_positions", _FLAT)
def _(spark, sf_dir):
    return ais.flatten_positions(ais.read_position_documents(spark, _land_positions(spark, sf_dir), multi_line=False))


@query("src6_broken_positions", _CUT_OFF)
def _(spark, sf_dir):
    documents = ais.read_position_documents(spark, _land_positions(spark, sf_dir), multi_line=False)
    return ais.broken_positions(documents).agg(F.count("text").alias("n_broken"))


@query("src7_append_bronze", _ALL_PINGS)
def _(spark, sf_dir):
    path = fresh_path(spark, "bronze")
    raw = adapters.ais_raw(spark, sf_dir)
    first = F.day("BaseDateTime") < 11
    tables.append(raw.filter(first), path)
    tables.append(raw.filter(F.lit(False)), path)
    tables.append(raw.filter(~first), path)
    return spark.read.schema(schemas.AIS).parquet(path)


_HOURLY = {
    "hourly": """select zone_name, timestamp_utc, min(latitude) as latitude, min(longitude) as longitude, """
    + ", ".join(f"max({c}) as {c}" for c in [*schemas.WAVE_VARIABLES.values(), *schemas.WIND_VARIABLES.values()])
    + " from wx_raw group by 1, 2"
}


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*schemas.WAVE_VARIABLES.values(), *schemas.WIND_VARIABLES.values()]
    return adapters.raw_weather(spark, sf_dir).groupBy("zone_name", "timestamp_utc").agg(
        F.min("latitude").alias("latitude"),
        F.min("longitude").alias("longitude"),
        *[F.max(c).alias(c) for c in columns],
    )


def _write_hourly(rows: DataFrame, variables: dict[str, str], path: str) -> None:
    """One document per zone and month: at most 31 days of readings."""
    reading = F.struct(
        F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm").alias("time"),
        *[F.col(column).alias(name) for name, column in variables.items()],
    )
    month = rows.groupBy("zone_name", "latitude", "longitude", F.trunc("timestamp_utc", "month").alias("m")).agg(
        F.array_sort(F.collect_list(reading)).alias("r")
    )
    arrays = F.struct(*[F.col("r")[name].alias(name) for name in ["time", *variables]])
    month.select("zone_name", "latitude", "longitude", arrays.alias("hourly")).write.mode("append").option(
        "ignoreNullFields", "false"
    ).json(path)


def _land_polls(rows: DataFrame, variables: dict[str, str], path: str) -> None:
    """An older poll of half of the hours with other values, then a poll of all hours."""
    older = rows.filter(F.month("timestamp_utc") % 2 == 0)
    _write_hourly(older.withColumns({c: F.col(c) + 1000 for c in variables.values()}), variables, path)
    time.sleep(1.1)  # file times have whole seconds on some stores
    _write_hourly(rows, variables, path)


@query("src8_flatten_weather", check_sql("select * from hourly", **_HOURLY))
def _(spark, sf_dir):
    waves, winds = fresh_path(spark, "waves"), fresh_path(spark, "winds")
    rows = _hourly(spark, sf_dir)
    _land_polls(rows, schemas.WAVE_VARIABLES, waves)
    _land_polls(rows, schemas.WIND_VARIABLES, winds)
    return weather.flatten_weather(
        weather.read_hourly(spark, waves, schemas.WAVE_VARIABLES),
        weather.read_hourly(spark, winds, schemas.WIND_VARIABLES),
    )


@query("src9_load_weather", check_sql("select * from hourly where zone_name not in ('zone_3', 'zone_4', 'zone_5')", **_HOURLY))
def _(spark, sf_dir):
    """Zone 3 has a broken wave document, zone 4 a broken wind document, zone 5 none for wind."""
    waves, winds, target = (fresh_path(spark, n) for n in ("waves", "winds", "weather"))
    rows = _hourly(spark, sf_dir)
    cut = lambda zone: rows.filter(F.col("zone_name") == zone).select(F.concat(F.lit('{"zone_name": "'), "zone_name").alias("value"))
    _write_hourly(rows.filter("zone_name not in ('zone_4', 'zone_5')"), schemas.WIND_VARIABLES, winds)
    _write_hourly(rows.filter("zone_name <> 'zone_3'"), schemas.WAVE_VARIABLES, waves)
    cut("zone_3").write.mode("append").text(waves)
    cut("zone_4").write.mode("append").text(winds)
    return tables.publish(weather.load_weather(spark, waves, winds), target)


@query(
    "src10_weather_zones",
    check_sql(
        """select z.zone_code, z.zone_name, count(*) as n_readings, max(wind_speed_10m_kmh) as strongest_wind_kmh
 from wx_raw w join zones z on z.zone_key = cast(regexp_extract(w.zone_name, '(\\d+)$', 1) as integer) + 1 group by all"""
    ),
)
def _(spark, sf_dir):
    from tidewatch.operators.dimensions import dim_weather_zones

    zone_key = F.regexp_extract("zone_name", r"(\d+)$", 1).cast("int") + 1
    readings = adapters.raw_weather(spark, sf_dir).groupBy(zone_key.alias("zone_key")).agg(
        F.count(F.lit(1)).alias("n_readings"), F.max("wind_speed_10m_kmh").alias("strongest_wind_kmh")
    )
    zones = dim_weather_zones(spark).select("zone_key", "zone_code", "zone_name")
    return readings.join(F.broadcast(zones), "zone_key").drop("zone_key")


@query(
    "src11_hour_range",
    check_sql(
        """select time_key, count(BaseDateTime) as n_pings from hours left join valid
 on date_trunc('hour', BaseDateTime) = time_key group by 1 having count(BaseDateTime) > 0"""
    ),
)
def _(spark, sf_dir):
    from tidewatch.operators.dimensions import hour_range

    hours = positions.valid_positions(adapters.ais_raw(spark, sf_dir)).select(
        F.date_trunc("hour", "BaseDateTime").alias("time_key")
    )
    counted = hours.groupBy("time_key").agg(F.count(F.lit(1)).alias("n_pings"))
    return counted.join(F.broadcast(hour_range(spark)), "time_key")


# The gold tables as they are published, columns in order.
_GOLD_COLUMNS = {
    "dim_ports": "port_key (int), port_name (string), country (string), latitude (double), longitude (double),"
    " harbor_size (string), harbor_type (string), shelter_quality (string), channel_depth_m (double),"
    " anchorage_depth_m (double), cargo_pier_depth_m (double), has_dry_dock (string), has_railway (string),"
    " has_provisions (string), has_fuel_oil (string), max_vessel_length_m (int), tide_range_m (double),"
    " harbor_size_rank (int), capacity_tier (string)",
    "dim_time": "time_key (timestamp), date_key (date), hour (bigint), day_of_week (bigint), day_of_month (bigint),"
    " month (bigint), quarter (bigint), year (bigint), is_weekend (int), season (string),"
    " is_peak_trade_season (int), watch_period (string)",
    "dim_vessels": "vessel_key (string), imo (string), vessel_name (string), vessel_type_code (int),"
    " vessel_type_desc (string), call_sign (string), length_m (double), width_m (double), draft_m (double),"
    " cargo_code (string), transceiver_class (string), total_pings (bigint), first_seen (timestamp), last_seen (timestamp)",
    "dim_vessels_scd2": "mmsi (string), imo (string), vessel_name (string), vessel_type_code (int), call_sign (string),"
    " length_m (double), width_m (double), draft_m (double), version_id (string), updated_at (timestamp),"
    " valid_from (timestamp), valid_to (timestamp)",
    "dim_weather_zones": "zone_key (int), zone_code (string), zone_name (string), center_lat (double),"
    " center_lon (double), radius_nm (int)",
    "fct_ais_anomalies": "vessel_key (string), anomaly_ts (timestamp), last_known_lat (double), last_known_lon (double),"
    " last_known_sog (double), time_key (timestamp), time_gap_minutes (double), distance_gap_nm (double),"
    " implied_speed_kts (double), anomaly_type (string), risk_score (double)",
    "fct_port_calls": "vessel_key (string), port_key (int), arrival_ts (timestamp), departure_ts (timestamp),"
    " duration_hours (double), time_key (timestamp), arrival_lat (double), arrival_lon (double),"
    " is_extended_stay (int), stay_category (string)",
    "fct_vessel_positions": "vessel_key (string), position_ts (timestamp), latitude (double), longitude (double),"
    " sog (double), cog (double), heading (double), nav_status (int), vessel_type_code (int), time_key (timestamp),"
    " distance_nm (double), time_gap_minutes (double), position_ts_day (date)",
    "obt_vessel_tracking": "vessel_key (string), position_ts (timestamp), latitude (double), longitude (double),"
    " sog (double), cog (double), heading (double), nav_status (int), distance_nm (double), time_gap_minutes (double),"
    " vessel_name (string), imo (string), vessel_type_desc (string), length_m (double), width_m (double),"
    " draft_m (double), call_sign (string), date_key (date), hour (bigint), day_of_week (bigint), month (bigint),"
    " quarter (bigint), year (bigint), season (string), is_peak_trade_season (int), watch_period (string),"
    " position_ts_day (date)",
}


@query(
    "src12_schema_catalog",
    check_sql(
        " union all ".join(
            f"select '{name}' as table_name, cast({columns.count('(')} as bigint) as n_columns, '- gold.{name}: {columns}' as line,"
            f" (select count(*) from {_TABLE_STEPS[name]}) as n_rows"
            for name, columns in _GOLD_COLUMNS.items()
        ),
        scd2_src=_scd2_source_sql(),
    ),
)
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    w.register_gold("gold")
    catalog = tables.schema_catalog(spark, "gold")
    lines = tables.schema_text(catalog, "gold")
    return lines.join(_rows_per_table(w.gold()), "table_name")


def _rows_per_table(gold: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, df in gold.items()]
    return reduce(DataFrame.unionByName, counts)


@query("src13_table_or_empty", check_sql("select vessel_key, total_pings from dv"))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    w.register_gold("gold")
    vessels = w.table("dim_vessels")
    found = tables.table_or_empty(spark, "gold.dim_vessels", vessels.schema)
    missing = tables.table_or_empty(spark, "gold.not_a_table", vessels.schema)
    return found.unionByName(missing).select("vessel_key", "total_pings")


@query("snk1_publish_by_day", check_sql("select *, cast(position_ts as date) as position_ts_day from fct"))
def _(spark, sf_dir):
    fact = warehouse(spark, sf_dir).table("fct_vessel_positions")
    return tables.publish(fact, fresh_path(spark, "fact"), date_of="position_ts")


@query("snk2_replace_result", check_sql("select * from anom where risk_score > 50"))
def _(spark, sf_dir):
    anomalies = warehouse(spark, sf_dir).table("fct_ais_anomalies")
    path = fresh_path(spark, "result")
    tables.publish(anomalies.filter("risk_score <= 50"), path)
    return tables.publish(anomalies.filter("risk_score > 50"), path)


@query("str1_ingest_stream", _FLAT)
def _(spark, sf_dir):
    landing = _land_positions(spark, sf_dir, files=4)
    target, checkpoint = (fresh_path(spark, n) for n in ("bronze", "ingest"))
    stream = ingest_stream(spark, landing, target, checkpoint, once=True, files_per_batch=1, multi_line=False)
    stream.awaitTermination()
    return spark.read.schema(schemas.AIS).parquet(target)


@query("str1_broken_documents", _CUT_OFF)
def _(spark, sf_dir):
    landing = _land_positions(spark, sf_dir, files=4)
    target, checkpoint = (fresh_path(spark, n) for n in ("broken", "ingest"))
    ingest_stream(spark, landing, target, checkpoint, once=True, multi_line=False, broken=True).awaitTermination()
    return spark.read.parquet(target).agg(F.count("text").alias("n_broken"))


@query(
    "str2_live_tick",
    check_sql(
        f"""select *, (select count(*) from dv) as total_vessels, (select count(*) from anom) as anomaly_count from ({_LATEST})"""
    ),
)
def _(spark, sf_dir):
    source, target, checkpoint = (fresh_path(spark, n) for n in ("events", "ticks", "live"))
    events = adapters.driver_table(spark, sf_dir, "events")
    events.repartition(3).write.parquet(source)
    pings = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    cleaned = positions.clean_positions(positions.valid_positions(adapters.ais_from_events(pings)))
    w = warehouse(spark, sf_dir)
    w.gold()
    again = lambda name: lambda: spark.read.parquet(w.path(name))
    stream = live_tick_stream(cleaned, again("dim_vessels"), again("fct_ais_anomalies"), target, checkpoint, once=True)
    stream.awaitTermination()
    ticks = spark.read.parquet(target)
    last = ticks.agg(F.max("tick")).scalar()
    return ticks.filter(F.col("tick") == last).drop("tick", "emitted_at")
