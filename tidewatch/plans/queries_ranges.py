"""Registered queries: whole-table ranks, rolling sums, daily sketches, cube and build changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import changes, ranks, rolling, sketches
from tidewatch.plans.oracles import check_sql
from tidewatch.plans.registry import query, warehouse


@query(
    "gld21_speed_ranks",
    check_sql(
        """select vessel_key, position_ts, sog, rank() over w as rank, dense_rank() over w as dense_rank, case when sog is null then 'unknown' else 'known' end as speed from fct
 window w as (order by sog desc nulls last)"""
    ),
)
def _(spark, sf_dir):
    fact = warehouse(spark, sf_dir).table("fct_vessel_positions").select("vessel_key", "position_ts", "sog")
    found = ranks.global_ranks(fact, ["sog"], descending=True).drop("tile")
    return found.withColumn("speed", F.when(F.col("sog").isNull(), "unknown").otherwise("known"))


@query(
    "gld22_distance_tiles",
    check_sql(
        """select vessel_key, position_ts, distance_nm, rank() over w as rank, ntile(10) over w as tile from fct
 window w as (order by distance_nm nulls last, vessel_key nulls last, position_ts nulls last)"""
    ),
)
def _(spark, sf_dir):
    fact = warehouse(spark, sf_dir).table("fct_vessel_positions").select("vessel_key", "position_ts", "distance_nm")
    return ranks.global_ranks(fact, ["distance_nm", "vessel_key", "position_ts"], tiles=10).drop("dense_rank")


@query(
    "gld23_rolling_day",
    check_sql(
        """select vessel_key, position_ts, cast(sum(1) over w as bigint) as pings_24h, cast(sum(cast(round(distance_nm * 100) as bigint)) over w as bigint) as distance_24h_hundredths from fct
 window w as (partition by vessel_key order by position_ts range between interval 24 hours preceding and current row)"""
    ),
)
def _(spark, sf_dir):
    fact = warehouse(spark, sf_dir).table("fct_vessel_positions")
    legs = fact.select("vessel_key", "position_ts", F.lit(1).cast("long").alias("one"), F.expr("cast(round(distance_nm * 100) as bigint)").alias("hundredths"))
    return rolling.rolling_sums(legs, ["vessel_key"], "position_ts", {"pings_24h": "one", "distance_24h_hundredths": "hundredths"}).drop("one", "hundredths")


# Quantiles of sketches are checked by their place among the exact ones: 400 items keep the place within two in a hundred.
_WEEK = """select d.day, count(*) as n_rows, count(distinct vessel_key) as n_vessels, true as vessels_within, true as median_within from fct
 join (select distinct cast(position_ts as date) as day from fct) d on cast(position_ts as date) between d.day - 6 and d.day group by 1"""


@query("srv17_sketched_weeks", check_sql(_WEEK))
def _(spark, sf_dir):
    fact = warehouse(spark, sf_dir).table("fct_vessel_positions").select("vessel_key", "position_ts", "sog")
    days = sketches.daily_sketches(fact, "position_ts", "vessel_key", "sog")
    weeks = sketches.estimates(sketches.last_days(days, 7), {"median": 0.5})
    # The exact figures, to hold the estimates against: a vessel's day counts once.
    reach = F.explode(F.sequence("day", F.date_add("day", 6)))
    vessels = fact.select(F.to_date("position_ts").alias("day"), "vessel_key").distinct().select(reach.alias("day"), "vessel_key").distinct()
    exact = vessels.groupBy("day").agg(F.count("vessel_key").alias("n_vessels"))
    speeds = fact.groupBy(F.to_date("position_ts").alias("day"), "sog").agg(F.count(F.lit(1)).alias("n")).filter("sog IS NOT NULL").select(reach.alias("day"), "sog", "n")
    below = speeds.join(weeks.select("day", "median"), "day").groupBy("day").agg(
        *[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(a) for a, c in (("low", F.col("sog") < F.col("median")), ("high", F.col("sog") <= F.col("median")))], F.sum("n").alias("all")
    )
    found = weeks.join(exact, "day").join(below, "day", "left")
    return found.select(
        "day", "n_rows", "n_vessels",
        (F.abs(F.col("n_distinct") - F.col("n_vessels")) <= F.ceil(F.col("n_vessels") * 0.025)).alias("vessels_within"),
        F.coalesce((F.col("low") <= 0.52 * F.col("all")) & (F.col("high") >= 0.48 * F.col("all")), F.col("median").isNull()).alias("median_within"),
    )


@query(
    "gld24_anomaly_cube",
    check_sql(
        """select anomaly_type, day, hour, grouping_id(anomaly_type, day, hour) as level, count(*) as n_anomalies, count(distinct vessel_key) as n_vessels, max(risk_score) as highest
 from (select *, cast(anomaly_ts as date) as day, hour(anomaly_ts) as hour from anom) group by cube (anomaly_type, day, hour)"""
    ),
)
def _(spark, sf_dir):
    anomalies = warehouse(spark, sf_dir).table("fct_ais_anomalies")
    rows = anomalies.select("anomaly_type", F.to_date("anomaly_ts").alias("day"), F.hour("anomaly_ts").alias("hour"), "vessel_key", "risk_score")
    # One row per vessel and cell before the cube copies rows into its eight levels.
    cells = rows.groupBy("anomaly_type", "day", "hour", "vessel_key").agg(F.count(F.lit(1)).alias("n"), F.max("risk_score").alias("highest"))
    return cells.cube("anomaly_type", "day", "hour").agg(
        F.grouping_id().cast("long").alias("level"), F.sum("n").alias("n_anomalies"), F.countDistinct("vessel_key").alias("n_vessels"), F.max("highest").alias("highest")
    )


_OLD = "select vessel_key, position_ts, sog, heading, nav_status from fct"
_NEW = """select vessel_key, position_ts, case when minute(position_ts) = 7 and nav_status = 1 then sog + 1 else sog end as sog,
 case when second(position_ts) = 11 then null else heading end as heading, nav_status from {fact} where not (minute(position_ts) = 31 and second(position_ts) < 20)"""
_AGAIN = " union all select vessel_key, position_ts, sog, heading, nav_status from {fact} where minute(position_ts) = 43 and second(position_ts) > 50"


@query(
    "dq10_build_changes",
    check_sql(
        """select vessel_key, position_ts, sog, heading, nav_status, cast(-count(*) as bigint) as change from (select * from old except all select * from new) group by all
 union all select vessel_key, position_ts, sog, heading, nav_status, count(*) as change from (select * from new except all select * from old) group by all""",
        old=_OLD,
        new=(_NEW + _AGAIN).format(fact="fct"),
    ),
)
def _(spark, sf_dir):
    fact = warehouse(spark, sf_dir).table("fct_vessel_positions")
    before = fact.select("vessel_key", "position_ts", "sog", "heading", "nav_status")
    after = spark.sql((_NEW + _AGAIN).format(fact="{fact}"), fact=fact)
    return changes.build_changes(before, after, ["vessel_key", "position_ts"])
