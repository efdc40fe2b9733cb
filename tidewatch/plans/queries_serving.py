"""Registered queries over the published warehouse: serving, statements and checks (SRV-*, DQ-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import history, quality, serving, statements
from tidewatch.plans import adapters
from tidewatch.plans.oracles import check_sql
from tidewatch.plans.registry import query, warehouse
from tidewatch.plans.warehouse import Warehouse
from tidewatch.session import fresh_path
from tidewatch.sources.tables import table_or_empty, to_records


def _counts(*pairs: tuple[str, str]) -> str:
    return ", ".join(f"(select count(*) from {table}) as {name}" for name, table in pairs)


@query(
    "srv1_kpis",
    check_sql(
        "select "
        + _counts(
            ("total_positions", "fct"),
            ("unique_vessels", "dv"),
            ("ports_tracked", "dp"),
            ("port_calls", "fpc"),
            ("ais_anomalies", "anom"),
        )
        + ", (select round(avg(sog), 1) from fct where sog > 0) as avg_speed_kts"
    ),
)
def _(spark, sf_dir):
    return serving.kpis(warehouse(spark, sf_dir).gold())


@query(
    "srv2_build_report",
    check_sql(
        " union all ".join(
            f"select '{label}' as label, count(*) as n, 'built' as status from {table}"
            for label, table in [
                ("Vessel positions", "fct"),
                ("Unique vessels", "dv"),
                ("Ports loaded", "dp"),
                ("Port calls", "fpc"),
                ("AIS anomalies", "anom"),
                ("Time dimension", "cal"),
                ("Weather zones", "zones"),
                ("OBT rows", "obt"),
            ]
        )
    ),
)
def _(spark, sf_dir):
    return serving.build_report(warehouse(spark, sf_dir).gold())


@query(
    "srv3_active_vessels",
    check_sql(
        """select vessel_key, vessel_name, vessel_type_desc, imo, length_m, total_pings, first_seen, last_seen
 from dv order by last_seen desc nulls last, vessel_key asc nulls last limit 50"""
    ),
)
def _(spark, sf_dir):
    return serving.active_vessels(warehouse(spark, sf_dir).table("dim_vessels"))


_PROFILE = """select vessel_key, vessel_name, vessel_type_desc, imo, length_m, width_m, draft_m, call_sign, total_pings,
 first_seen, last_seen, p.position_ts as latest_position_ts, p.latitude as latest_latitude, p.longitude as latest_longitude,
 p.sog as latest_sog, p.cog as latest_cog, p.heading as latest_heading, coalesce(n, 0) as anomaly_count, avg_risk_score
 from dv left join (select * from fct qualify row_number() over (partition by vessel_key order by position_ts desc) = 1) p
 using (vessel_key) left join (select vessel_key, count(*) as n, round(avg(risk_score), 1) as avg_risk_score
 from anom group by vessel_key) a using (vessel_key)"""


def _profile_tables(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return w.table("dim_vessels"), w.table("fct_vessel_positions"), w.table("fct_ais_anomalies")


@query("srv4_vessel_profiles", check_sql(_PROFILE))
def _(spark, sf_dir):
    return serving.vessel_profiles(*_profile_tables(spark, sf_dir))


@query("srv4_vessel_profile", check_sql(_PROFILE + " where vessel_key = '7'"))
def _(spark, sf_dir):
    return serving.vessel_profile(*_profile_tables(spark, sf_dir), "7")


# Stand-in for model output: a probability computed from the call itself.
PREDICTED = {
    "pred": """select vessel_key, port_key, duration_hours, is_extended_stay as y,
 (cast(vessel_key as bigint) * 31 + port_key * 17 + extract(hour from arrival_ts) * 13
 + extract(minute from arrival_ts) * 7) % 100 / 100e0 as delay_proba from fpc"""
}


def predicted(spark, sf_dir):
    spread = (
        F.col("vessel_key").cast("long") * 31
        + F.col("port_key") * 17
        + F.hour("arrival_ts") * 13
        + F.minute("arrival_ts") * 7
    ) % 100
    return warehouse(spark, sf_dir).table("fct_port_calls").select(
        "vessel_key",
        "port_key",
        "duration_hours",
        F.col("is_extended_stay").alias("y"),
        (spread / F.lit(100.0)).alias("delay_proba"),
    )


@query(
    "srv5_delayed_vessels",
    check_sql(
        """select vessel_key, port_key, round(duration_hours, 1) as duration_hours, round(delay_proba, 4) as delay_probability
 from (select * from pred where delay_proba > 0.5 order by delay_proba desc nulls last, vessel_key asc nulls last,
 port_key asc nulls last, duration_hours asc nulls last limit 20)""",
        **PREDICTED,
    ),
)
def _(spark, sf_dir):
    return serving.delayed_vessels(predicted(spark, sf_dir))


@query(
    "srv5_before_predictions",
    check_sql("select vessel_key, port_key, duration_hours, delay_proba as delay_probability from pred where false", **PREDICTED),
)
def _(spark, sf_dir):
    """No predictions are published yet: no vessels, and no error."""
    predictions = table_or_empty(spark, "gold.never_published_predictions", predicted(spark, sf_dir).schema)
    return serving.delayed_vessels(predictions)


def _ports_and_calls(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return w.table("fct_port_calls"), w.table("dim_ports")


@query(
    "srv6_top_ports",
    check_sql(
        """select port_name, country, harbor_size, capacity_tier, count(*) as calls from fpc join dp using (port_key)
 group by all order by calls desc, port_name nulls last, country nulls last, harbor_size, capacity_tier limit 10"""
    ),
)
def _(spark, sf_dir):
    return serving.top_ports(*_ports_and_calls(spark, sf_dir))


_CONGESTION = """select port_key, port_name, country, harbor_size, channel_depth_m, capacity_tier,
 count(arrival_ts) as total_calls, round(sum(cast(round(duration_hours * 100) as bigint)) / count(duration_hours) / 100e0, 1) as avg_stay_hours,
 cast(sum(is_extended_stay) as bigint) as extended_stays from dp left join fpc using (port_key) {where} group by all"""


@query("srv7_port_congestion", check_sql(_CONGESTION.format(where="")))
def _(spark, sf_dir):
    return serving.port_congestion(*_ports_and_calls(spark, sf_dir))


@query("srv7_port_congestion_one", check_sql(_CONGESTION.format(where="where port_key = 1")))
def _(spark, sf_dir):
    return serving.port_congestion(*_ports_and_calls(spark, sf_dir), port_key=1)


@query(
    "srv8_recent_anomalies",
    check_sql(
        """select vessel_key, anomaly_ts, anomaly_type, risk_score, time_gap_minutes, distance_gap_nm, last_known_lat,
 last_known_lon from anom order by anomaly_ts desc nulls last, vessel_key asc nulls last limit 20"""
    ),
)
def _(spark, sf_dir):
    return serving.recent_anomalies(warehouse(spark, sf_dir).table("fct_ais_anomalies"))


@query(
    "srv9_vessels_by_type",
    check_sql(
        """select vessel_type_desc, count(*) as n from dv group by 1
 order by n desc, vessel_type_desc asc nulls last limit 5"""
    ),
)
def _(spark, sf_dir):
    return serving.vessels_by_type(warehouse(spark, sf_dir).table("dim_vessels"))


_BY_TYPE = "select anomaly_type, count(*) as n, round(avg(risk_score), 1) as avg_risk from anom group by 1"


@query("srv10_anomalies_by_type", check_sql(_BY_TYPE))
def _(spark, sf_dir):
    return serving.anomalies_by_type(warehouse(spark, sf_dir).table("fct_ais_anomalies"))


_BRIEFING_PORTS = """select port_name, country, count(*) as calls from fpc join dp using (port_key) group by all
 order by calls desc, port_name nulls last, country nulls last limit 5"""


@query("srv11_briefing_ports", check_sql(_BRIEFING_PORTS))
def _(spark, sf_dir):
    return serving.briefing_ports(*_ports_and_calls(spark, sf_dir))


@query(
    "srv12_briefing_facts",
    check_sql(
        " union all ".join(
            f"select 'totals' as section, '{label}' as label, count(*) as n, cast(null as double) as value from {table}"
            for label, table in [
                ("Vessels tracked", "dv"),
                ("Total AIS positions", "fct"),
                ("Port calls recorded", "fpc"),
                ("AIS anomalies flagged", "anom"),
            ]
        )
        + """ union all select 'anomaly types', anomaly_type, n, avg_risk from kinds
 union all select 'ports', port_name || ' (' || country || ')', calls, null from busy""",
        kinds=_BY_TYPE + " order by n desc, anomaly_type nulls last limit 5",
        busy=_BRIEFING_PORTS,
    ),
)
def _(spark, sf_dir):
    return serving.briefing_facts(warehouse(spark, sf_dir).gold())


_LATEST = """select vessel_key, latitude, longitude, sog, cog, heading, position_ts, vessel_name, vessel_type_desc
 from (select * from fct qualify row_number() over (partition by vessel_key order by position_ts desc) = 1) l
 left join dv using (vessel_key) order by position_ts desc nulls last, vessel_key asc nulls last limit 100"""


@query("srv13_latest_positions", check_sql(_LATEST))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return serving.latest_positions(w.table("fct_vessel_positions"), w.table("dim_vessels"))


# Statements and replies made from the events, one kind per remainder.
_STATEMENT = """case user_id % 16
 when 0 then concat('SELECT vessel_key, count(*) FROM gold.fct_vessel_positions WHERE vessel_key = ''', user_id, ''' GROUP BY 1')
 when 1 then concat('WITH a AS (SELECT * FROM gold.fct_ais_anomalies WHERE risk_score > ', event_id % 100, ') SELECT * FROM a')
 when 2 then concat('select port_name from gold.dim_ports limit ', event_id % 50, ';')
 when 3 then concat('SELECT ', event_id, '; DROP TABLE gold.dim_vessels')
 when 4 then concat('UPDATE gold.dim_vessels SET vessel_name = ''', user_id, '''')
 when 5 then concat('SELECT * FROM read_csv(''/data/', event_id, '.csv'')')
 when 6 then concat('SELECT * FROM bronze.raw_vessel_positions WHERE MMSI = ', user_id)
 when 7 then concat('SELECT * FROM gold.dim_ports p JOIN main.other.secrets s ON p.port_key = ', event_id)
 when 8 then concat('SELECT extract(hour from position_ts) FROM gold.fct_vessel_positions LIMIT ', event_id)
 when 9 then concat('  select * from dim_vessels, hidden_', user_id, '  ')
 when 10 then concat('SELECT ''drop ', user_id, ''' AS note FROM gold.dim_time')
 when 11 then concat('SELECT * FROM\u00a0hidden_', user_id)
 when 12 then concat('SELECT * FROM gold.dim_ports JOIN\u2003hidden_', user_id, ' ON true')
 when 13 then concat('SELECT\u00a0', event_id, ' FROM gold.dim_ports')
 when 14 then concat('\u2003SELECT ', event_id, ' FROM gold.dim_ports\u2003')
 else '' end"""

_ALLOWED = [
    prefix + name
    for name in (
        "fct_vessel_positions",
        "fct_port_calls",
        "fct_ais_anomalies",
        "dim_vessels",
        "dim_ports",
        "dim_time",
        "dim_weather_zones",
        "dim_vessels_scd2",
        "obt_vessel_tracking",
    )
    for prefix in ("", "gold.")
]

_LIST = "[" + ", ".join(f"'{a}'" for a in _ALLOWED) + "]"
_BANNED = "|".join(statements.FORBIDDEN)


_BLANK_CHARACTERS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BLANK = f"[{_BLANK_CHARACTERS}]"
_TRIM = f"'^{_BLANK}+|{_BLANK}+$', '', 'g'"


@query(
    "srv14_audit_sql",
    check_sql(
        f"""select event_id, statement, case when reason is null then 'allowed' else 'rejected' end as verdict, reason,
 case when reason is null then s || case when contains(' ' || upper(s) || ' ', ' LIMIT ') then '' else chr(10) || 'LIMIT 200' end end
 as safe_sql from (
 select *, case when contains(s, ';') then 'multiple statements are not allowed'
 when regexp_extract(upper(s), '^([^{_BLANK_CHARACTERS}]*)', 1) not in ('SELECT', 'WITH') then 'only SELECT / WITH queries are allowed'
 when banned <> '' then 'forbidden keyword or function: ' || banned
 when len(foreign_tables) > 0 then 'query references a table outside the allowed schema: ' || foreign_tables[1] end as reason from (
 select *, regexp_extract(upper(s), '\\b({_BANNED})\\b', 1) as banned,
 list_filter(regexp_extract_all(lower(s), '\\b(?:from|join){_BLANK}+([a-z_][a-z0-9_\\.]*)', 1),
 lambda t: not list_contains({_LIST}, t)
 and not list_contains(regexp_extract_all(lower(s), '\\b(\\w+){_BLANK}+as{_BLANK}*\\(', 1), t)) as foreign_tables from (
 select event_id, statement, regexp_replace(rtrim(regexp_replace(statement, {_TRIM}), ';'), {_TRIM}) as s from (
 select event_id, {_STATEMENT} as statement from events))))"""
    ),
)
def _(spark, sf_dir):
    events = adapters.driver_table(spark, sf_dir, "events")
    return statements.audit_sql(events.select("event_id", F.expr(_STATEMENT).alias("statement")), "statement", _ALLOWED)


_REPLY = """case event_id % 10
 when 0 then concat('{"sql": "select ', event_id, '", "explanation": "number ', user_id, '"}')
 when 1 then concat('Here it is: ```sql select ', event_id, ' from dim_time ``` done')
 when 2 then concat('{"sql": "select ', user_id, '"}')
 when 3 then concat('{"sql": "select ', user_id, '"} and more words')
 when 4 then concat('{''sql'': ''select ', user_id, '''}')
 when 5 then concat('{"sql": "drop table x"} ```select ', event_id, '```')
 when 6 then concat('{"sql": ', event_id, '}')
 when 7 then concat('{"sql": {"text": "select ', event_id, '"}} ```SQL select 7```')
 when 8 then concat('{"sql": "select 1"}, {"sql": "select ', event_id, '"}')
 else concat('sorry, nothing for ', user_id) end"""


@query(
    "srv15_extract_sql",
    check_sql(
        """select event_id, sql, case when event_id % 10 = 0 then 'number ' || user_id when sql is not null then '' end as explanation,
 sql is not null as parsed from (select event_id, user_id, case event_id % 10 when 0 then 'select ' || event_id
 when 1 then 'select ' || event_id || ' from dim_time' when 2 then 'select ' || user_id when 5 then 'select ' || event_id
 when 7 then 'select 7' end as sql from events)"""
    ),
)
def _(spark, sf_dir):
    events = adapters.driver_table(spark, sf_dir, "events")
    return statements.extract_sql(events.select("event_id", F.expr(_REPLY).alias("reply")), "reply").drop("reply")


@query(
    "srv16_capped",
    check_sql(
        """select vessel_key, anomaly_ts, risk_score, (select count(*) from anom) as row_count from anom
 order by vessel_key nulls last, anomaly_ts nulls last limit 200"""
    ),
)
def _(spark, sf_dir):
    anomalies = warehouse(spark, sf_dir).table("fct_ais_anomalies").select("vessel_key", "anomaly_ts", "risk_score")
    return serving.capped(anomalies)


def _python_time(column: str) -> str:
    """A time as Python writes it."""
    return (
        f"case when epoch_us({column}) % 1000000 = 0 then strftime({column}, '%Y-%m-%d %H:%M:%S')"
        f" else strftime({column}, '%Y-%m-%d %H:%M:%S.%f') end"
    )


_VESSEL_RECORD = {"vessel_key": "mmsi", "vessel_name": "name", "total_pings": "pings", "first_seen": "first_seen"}


@query(
    "snk3_to_records",
    check_sql(
        f"""select '{{"mmsi":"' || vessel_key || '","name":' || coalesce('"' || vessel_name || '"', 'null') || ',"pings":'
 || total_pings || ',"first_seen":"' || {_python_time("first_seen")} || '"}}' as value from dv"""
    ),
)
def _(spark, sf_dir):
    return to_records(warehouse(spark, sf_dir).table("dim_vessels"), _VESSEL_RECORD)


@query(
    "snk3_nested_profiles",
    check_sql(
        f"""select '{{"mmsi":"' || dv.vessel_key || '","latest_position":' || coalesce('{{"status":' || p.nav_status || ',"ts":"'
 || {_python_time("p.position_ts")} || '"}}', 'null') || ',"pings":' || total_pings || '}}' as value from dv left join (
 select vessel_key, nav_status, position_ts from fct where cast(vessel_key as bigint) % 5 <> 0
 qualify row_number() over (partition by vessel_key order by position_ts desc) = 1) p using (vessel_key)"""
    ),
)
def _(spark, sf_dir):
    """Vessels whose number is divisible by five are given no position here."""
    vessels, fact, _anomalies = _profile_tables(spark, sf_dir)
    shown = serving.latest_per_vessel(fact.filter(F.col("vessel_key").cast("long") % 5 != 0))
    status = fact.select("vessel_key", "position_ts", "nav_status")
    latest = shown.select("vessel_key", "position_ts").join(status, ["vessel_key", "position_ts"])
    position = {"nav_status": "status", "position_ts": "ts"}
    names = {"vessel_key": "mmsi", "latest_position": position, "total_pings": "pings"}
    return to_records(vessels.join(latest, "vessel_key", "left"), names)


@query("dq1_not_null", check_sql("select * from dv where vessel_type_desc is null"))
def _(spark, sf_dir):
    return quality.check_not_null(warehouse(spark, sf_dir).table("dim_vessels"), "vessel_type_desc")


@query(
    "dq2_unique",
    check_sql("select MMSI, count(*) as n_rows from ais where MMSI is not null group by MMSI having count(*) > 1"),
)
def _(spark, sf_dir):
    return quality.check_unique(adapters.ais_raw(spark, sf_dir), "MMSI")


@query(
    "dq3_relationships",
    check_sql("select * from fpc where port_key is not null and not exists (from dp where dp.port_key = fpc.port_key)"),
)
def _(spark, sf_dir):
    calls, ports = _ports_and_calls(spark, sf_dir)
    return quality.check_fk(calls, "port_key", ports, "port_key")


@query("dq4_accepted_range", check_sql("select * from ais where LAT < -90 or LAT > 90"))
def _(spark, sf_dir):
    return quality.check_range(adapters.ais_raw(spark, sf_dir), "LAT", -90, 90)


_TABLE_STEPS = {
    "fct_vessel_positions": "fct",
    "fct_port_calls": "fpc",
    "fct_ais_anomalies": "anom",
    "dim_vessels": "dv",
    "dim_ports": "dp",
    "dim_time": "cal",
    "dim_weather_zones": "zones",
    "obt_vessel_tracking": "obt",
    "dim_vessels_scd2": "scd2_src",
}


def _suite_sql() -> str:
    lines = []
    for c in quality.GOLD_SUITE:
        step, col = _TABLE_STEPS[c.table], c.column
        if c.kind == "unique":
            count = f"(select count(*) from (select {col} from {step} where {col} is not null group by 1 having count(*) > 1))"
        elif c.kind == "relationships":
            parent = _TABLE_STEPS[c.parent]
            count = (
                f"(select count(*) from {step} where {col} is not null"
                f" and {col} not in (select {c.parent_column} from {parent} where {c.parent_column} is not null))"
            )
        elif c.kind == "not_null":
            count = f"(select count(*) from {step} where {col} is null)"
        else:
            tests = [f"{col} < {c.lo}"] * (c.lo is not None) + [f"{col} > {c.hi}"] * (c.hi is not None)
            count = f"(select count(*) from {step} where {' or '.join(tests)})"
        lines.append(f"select '{c.table}' as table_name, '{col}' as column_name, '{c.kind}' as check_name, {count} as failures")
    return "select *, case when failures = 0 then 'pass' else 'fail' end as status from (" + " union all ".join(lines) + ")"


def _first_known(column: str) -> str:
    return f"first({column} order by BaseDateTime desc, {column} desc) filter (where {column} is not null)"


def _scd2_source_sql(where: str = "true") -> str:
    return f"""select MMSI as mmsi, {_first_known("IMO")} as imo, {_first_known("VesselName")} as vessel_name,
 {_first_known("VesselType")} as vessel_type_code, {_first_known("CallSign")} as call_sign,
 round({_first_known("Length")}, 1) as length_m, round({_first_known("Width")}, 1) as width_m,
 round({_first_known("Draft")}, 1) as draft_m from ais where MMSI is not null and LAT between -90 and 90
 and LON between -180 and 180 and {where} group by MMSI"""


@query("dq5_run_checks", check_sql(_suite_sql(), scd2_src=_scd2_source_sql()))
def _(spark, sf_dir):
    return quality.run_checks(warehouse(spark, sf_dir).gold())


@query(
    "dq6_quality_score",
    check_sql(
        """select n as total_rows, n - k as duplicate_rows, z as total_nulls, round(100e0 * z / (n * 3), 2) as null_pct,
 case when n = 0 then 0 when n > k or z > n then 1 when z > 0 then 2 else 3 end as grade from (
 select count(*) as n, count(distinct MMSI) as k, cast(sum(case when Heading is null then 1 else 0 end
 + case when VesselType is null then 1 else 0 end + case when SOG is null then 1 else 0 end) as bigint) as z from ais)"""
    ),
)
def _(spark, sf_dir):
    return quality.quality_score(adapters.ais_raw(spark, sf_dir), "MMSI", ["Heading", "VesselType", "SOG"])


_BEFORE = "2024-01-16 00:00:00"
_AS_OF = "2024-02-01 00:00:00"


_HISTORY = check_sql(
        f"""select mmsi, imo, vessel_name, vessel_type_code, call_sign, length_m, width_m, draft_m,
 md5(mmsi || '|{_BEFORE}') as version_id, timestamp '{_BEFORE}' as updated_at, timestamp '{_BEFORE}' as valid_from,
 case when not exists (from fresh f where f.mmsi = h.mmsi and f.vessel_name is not distinct from h.vessel_name
 and f.vessel_type_code is not distinct from h.vessel_type_code) then timestamp '{_AS_OF}' end as valid_to from held h
 union all
 select f.*, md5(mmsi || '|{_AS_OF}'), timestamp '{_AS_OF}', timestamp '{_AS_OF}', null from fresh f
 where not exists (from held h where f.mmsi = h.mmsi and f.vessel_name is not distinct from h.vessel_name
 and f.vessel_type_code is not distinct from h.vessel_type_code)""",
        held=_scd2_source_sql(f"BaseDateTime < timestamp '{_BEFORE}'"),
        fresh=f"""select * replace (case when cast(mmsi as bigint) % 10 = 3 then vessel_name || 'II' else vessel_name end as vessel_name)
 from ({_scd2_source_sql()}) where cast(mmsi as bigint) % 13 <> 0""",
    )


@query("dq7_scd2_merge", _HISTORY)
def _(spark, sf_dir):
    raw = adapters.ais_raw(spark, sf_dir)
    earlier = history.scd2_source(raw.filter(F.col("BaseDateTime") < F.lit(_BEFORE).cast("timestamp")))
    number = F.col("mmsi").cast("long")
    renamed = F.when(number % 10 == 3, F.concat("vessel_name", F.lit("II"))).otherwise(F.col("vessel_name"))
    incoming = history.scd2_source(raw).filter(number % 13 != 0).withColumn("vessel_name", renamed)
    held = history.first_snapshot(earlier, as_of=F.lit(_BEFORE).cast("timestamp"))
    return history.scd2_merge(held, incoming, as_of=F.lit(_AS_OF).cast("timestamp"))


@query("dq7_warehouse_history", _HISTORY)
def _(spark, sf_dir):
    """Two builds of one warehouse; before the second, vessels are renamed and others vanish."""
    root, raw = fresh_path(spark, "warehouse"), adapters.ais_raw(spark, sf_dir)
    number = F.col("MMSI").cast("long")
    renamed = F.when(number % 10 == 3, F.concat("VesselName", F.lit("II"))).otherwise(F.col("VesselName"))
    earlier = raw.filter(F.col("BaseDateTime") < F.lit(_BEFORE).cast("timestamp"))
    later = raw.filter(number % 13 != 0).withColumn("VesselName", renamed)
    for pings, when in ((earlier, _BEFORE), (later, _AS_OF)):
        house = Warehouse(spark, pings, None, None, root=root, as_of=F.lit(when).cast("timestamp"))
        found = house.table("dim_vessels_scd2")
    return found


@query("dq8_scd2_source", check_sql(_scd2_source_sql()))
def _(spark, sf_dir):
    return history.scd2_source(adapters.ais_raw(spark, sf_dir))
