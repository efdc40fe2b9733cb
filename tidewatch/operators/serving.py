"""Questions the warehouse answers: totals, rankings, profiles and the latest picture.

Rankings order by their measure and then by key columns, so ties are stable, and
end in a limit, which Spark runs as a top-n per task without a global sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import parity_round

LATEST = ["latitude", "longitude", "sog", "cog", "heading"]


def top(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def kpis(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: sizes of five tables and the mean speed of moving vessels."""
    moving = F.when(F.col("sog") > 0, F.col("sog"))
    measures = [
        tables["fct_vessel_positions"].agg(
            F.count(F.lit(1)).alias("total_positions"), parity_round(F.avg(moving), 1).alias("avg_speed_kts")
        ),
        _count(tables["dim_vessels"], "unique_vessels"),
        _count(tables["dim_ports"], "ports_tracked"),
        _count(tables["fct_port_calls"], "port_calls"),
        _count(tables["fct_ais_anomalies"], "ais_anomalies"),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), measures)
    names = ["total_positions", "unique_vessels", "ports_tracked", "port_calls", "ais_anomalies", "avg_speed_kts"]
    return stacked.agg(*[F.max(c).alias(c) for c in names])


# Report label -> table.
REPORT = {
    "Vessel positions": "fct_vessel_positions",
    "Unique vessels": "dim_vessels",
    "Ports loaded": "dim_ports",
    "Port calls": "fct_port_calls",
    "AIS anomalies": "fct_ais_anomalies",
    "Time dimension": "dim_time",
    "Weather zones": "dim_weather_zones",
    "OBT rows": "obt_vessel_tracking",
}


def build_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; a table that is missing has no number and says so."""
    spark = next(iter(tables.values())).sparkSession

    def line(label: str, name: str) -> DataFrame:
        if name in tables:
            return _count(tables[name], "n").select(F.lit(label).alias("label"), "n", F.lit("built").alias("status"))
        return spark.createDataFrame([(label, None, "not built")], "label string, n bigint, status string")

    return reduce(DataFrame.unionByName, [line(label, name) for label, name in REPORT.items()])


def active_vessels(vessels: DataFrame, n: int = 50) -> DataFrame:
    kept = vessels.select(
        "vessel_key",
        "vessel_name",
        "vessel_type_desc",
        "imo",
        "length_m",
        "total_pings",
        "first_seen",
        "last_seen",
    )
    return top(kept, n, F.col("last_seen").desc_nulls_last(), F.col("vessel_key").asc_nulls_last())


def latest_per_vessel(fact: DataFrame) -> DataFrame:
    """The last position of every vessel, reduced on the map side first."""
    return fact.groupBy("vessel_key").agg(
        F.max("position_ts").alias("position_ts"), *[F.max_by(c, "position_ts").alias(c) for c in LATEST]
    )


def vessel_profiles(vessels: DataFrame, fact: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Dimension row, latest position and anomaly record of every vessel."""
    latest = latest_per_vessel(fact).withColumnsRenamed({c: f"latest_{c}" for c in ["position_ts", *LATEST]})
    record = anomalies.groupBy("vessel_key").agg(
        F.count(F.lit(1)).alias("anomaly_count"), parity_round(F.avg("risk_score"), 1).alias("avg_risk_score")
    )
    kept = vessels.select(
        "vessel_key",
        "vessel_name",
        "vessel_type_desc",
        "imo",
        "length_m",
        "width_m",
        "draft_m",
        "call_sign",
        "total_pings",
        "first_seen",
        "last_seen",
    )
    return (
        kept.join(latest, "vessel_key", "left")
        .join(record, "vessel_key", "left")
        .withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(0)))
    )


def vessel_profile(vessels: DataFrame, fact: DataFrame, anomalies: DataFrame, mmsi: str) -> DataFrame:
    """The profile of one vessel; no row for an unknown one. The key reaches all three scans."""
    mine = F.col("vessel_key") == mmsi
    return vessel_profiles(vessels.filter(mine), fact.filter(mine), anomalies.filter(mine))


def delayed_vessels(predictions: DataFrame, threshold: float = 0.5, n: int = 20) -> DataFrame:
    """Calls most likely to be delayed."""
    likely = predictions.filter(F.col("delay_proba") > threshold)
    ranked = top(
        likely,
        n,
        F.col("delay_proba").desc_nulls_last(),
        F.col("vessel_key").asc_nulls_last(),
        F.col("port_key").asc_nulls_last(),
        F.col("duration_hours").asc_nulls_last(),
    )
    return ranked.select(
        "vessel_key",
        "port_key",
        parity_round(F.col("duration_hours"), 1).alias("duration_hours"),
        parity_round(F.col("delay_proba"), 4).alias("delay_probability"),
    )


def _calls_by_port(calls: DataFrame, ports: DataFrame, attributes: list[str], n: int) -> DataFrame:
    """Calls per combination of port attributes.

    Calls are counted per port before the join, so a port with very many calls
    is one row there.
    """
    per_port = calls.groupBy("port_key").agg(F.count(F.lit(1)).alias("n"))
    named = per_port.join(ports.select("port_key", *attributes), "port_key", "inner")
    counted = named.groupBy(*attributes).agg(F.sum("n").alias("calls"))
    return top(counted, n, F.col("calls").desc(), *[F.col(c).asc_nulls_last() for c in attributes])


def top_ports(calls: DataFrame, ports: DataFrame, n: int = 10) -> DataFrame:
    return _calls_by_port(calls, ports, ["port_name", "country", "harbor_size", "capacity_tier"], n)


def briefing_ports(calls: DataFrame, ports: DataFrame, n: int = 5) -> DataFrame:
    return _calls_by_port(calls, ports, ["port_name", "country"], n)


def port_congestion(calls: DataFrame, ports: DataFrame, port_key: int | None = None) -> DataFrame:
    """Calls, mean stay and long stays of every port, or of one."""
    if port_key is not None:
        calls, ports = calls.filter(F.col("port_key") == port_key), ports.filter(F.col("port_key") == port_key)
    record = calls.groupBy("port_key").agg(
        F.count(F.lit(1)).alias("total_calls"),
        # Stays have two decimals: their sum in hundredths does not depend on the order of addition.
        parity_round(F.sum(F.round(F.col("duration_hours") * 100).cast("long")) / F.count("duration_hours") / F.lit(100.0), 1).alias(
            "avg_stay_hours"
        ),
        F.sum("is_extended_stay").alias("extended_stays"),
    )
    kept = ports.select("port_key", "port_name", "country", "harbor_size", "channel_depth_m", "capacity_tier")
    return kept.join(record, "port_key", "left").withColumn("total_calls", F.coalesce("total_calls", F.lit(0)))


def recent_anomalies(anomalies: DataFrame, n: int = 20) -> DataFrame:
    kept = anomalies.select(
        "vessel_key",
        "anomaly_ts",
        "anomaly_type",
        "risk_score",
        "time_gap_minutes",
        "distance_gap_nm",
        "last_known_lat",
        "last_known_lon",
    )
    return top(kept, n, F.col("anomaly_ts").desc_nulls_last(), F.col("vessel_key").asc_nulls_last())


def vessels_by_type(vessels: DataFrame, n: int = 5) -> DataFrame:
    counted = vessels.groupBy("vessel_type_desc").agg(F.count(F.lit(1)).alias("n"))
    return top(counted, n, F.col("n").desc(), F.col("vessel_type_desc").asc_nulls_last())


def anomalies_by_type(anomalies: DataFrame, n: int | None = None) -> DataFrame:
    counted = anomalies.groupBy("anomaly_type").agg(
        F.count(F.lit(1)).alias("n"), parity_round(F.avg("risk_score"), 1).alias("avg_risk")
    )
    return top(counted, n, F.col("n").desc(), F.col("anomaly_type").asc_nulls_last())


def briefing_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """The figures of a risk briefing as labelled rows."""
    # Label -> table counted.
    totals = {
        "Vessels tracked": "dim_vessels",
        "Total AIS positions": "fct_vessel_positions",
        "Port calls recorded": "fct_port_calls",
        "AIS anomalies flagged": "fct_ais_anomalies",
    }
    none = F.lit(None).cast("double").alias("value")
    parts = [
        _count(tables[name], "n").select(F.lit("totals").alias("section"), F.lit(label).alias("label"), "n", none)
        for label, name in totals.items()
    ]
    parts.append(
        anomalies_by_type(tables["fct_ais_anomalies"], 5).select(
            F.lit("anomaly types").alias("section"),
            F.col("anomaly_type").alias("label"),
            "n",
            F.col("avg_risk").alias("value"),
        )
    )
    parts.append(
        briefing_ports(tables["fct_port_calls"], tables["dim_ports"]).select(
            F.lit("ports").alias("section"),
            F.format_string("%s (%s)", "port_name", "country").alias("label"),
            F.col("calls").alias("n"),
            none,
        )
    )
    return reduce(DataFrame.unionByName, parts)


def latest_positions(fact: DataFrame, vessels: DataFrame, n: int = 100) -> DataFrame:
    """The most recent vessels with their last position and name.

    The limit comes before the join, so the join sees ``n`` rows; vessel keys are
    unique in the dimension, hence the result is the same.
    """
    order = [F.col("position_ts").desc_nulls_last(), F.col("vessel_key").asc_nulls_last()]
    newest = top(latest_per_vessel(fact), n, *order)
    names = vessels.select("vessel_key", "vessel_name", "vessel_type_desc")
    return newest.join(names, "vessel_key", "left").orderBy(*order)


def capped(df: DataFrame, n: int = 200, order: list[str] | None = None) -> DataFrame:
    """At most ``n`` rows, each with the number of rows there were."""
    columns = order or df.columns
    total = df.agg(F.count(F.lit(1)).alias("row_count")).scalar()
    return top(df, n, *[F.col(c).asc_nulls_last() for c in columns]).withColumn("row_count", total)
