"""Data checks and the source quality grade."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import parity_round


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; nulls do not count."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def check_fk(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key the parent lacks; null keys pass."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti").select(child.columns)


def out_of_range(value: Column, lo: float | None, hi: float | None) -> Column:
    if lo is None and hi is None:
        raise ValueError("a range check needs at least one bound")
    tests = ([value < lo] if lo is not None else []) + ([value > hi] if hi is not None else [])
    return reduce(lambda a, b: a | b, tests)


def check_range(df: DataFrame, column: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Rows outside the inclusive range; nulls pass."""
    return df.filter(out_of_range(F.col(column), lo, hi))


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str  # not_null, unique, relationships or accepted_range
    lo: float | None = None
    hi: float | None = None
    parent: str | None = None
    parent_column: str | None = None


# The constraints declared for the gold tables.
GOLD_SUITE = [
    Check("fct_vessel_positions", "vessel_key", "not_null"),
    Check("fct_vessel_positions", "vessel_key", "relationships", parent="dim_vessels", parent_column="vessel_key"),
    Check("fct_vessel_positions", "position_ts", "not_null"),
    Check("fct_vessel_positions", "latitude", "not_null"),
    Check("fct_vessel_positions", "latitude", "accepted_range", lo=-90.0, hi=90.0),
    Check("fct_vessel_positions", "longitude", "not_null"),
    Check("fct_vessel_positions", "longitude", "accepted_range", lo=-180.0, hi=180.0),
    Check("fct_vessel_positions", "sog", "accepted_range", lo=0.0, hi=102.3),
    Check("fct_vessel_positions", "cog", "accepted_range", lo=0.0, hi=360.0),
    Check("fct_vessel_positions", "distance_nm", "accepted_range", lo=0.0),
    Check("fct_port_calls", "vessel_key", "not_null"),
    Check("fct_port_calls", "vessel_key", "relationships", parent="dim_vessels", parent_column="vessel_key"),
    Check("fct_port_calls", "port_key", "not_null"),
    Check("fct_port_calls", "port_key", "relationships", parent="dim_ports", parent_column="port_key"),
    Check("fct_port_calls", "arrival_ts", "not_null"),
    Check("fct_port_calls", "duration_hours", "accepted_range", lo=0.0),
    Check("fct_ais_anomalies", "vessel_key", "not_null"),
    Check("fct_ais_anomalies", "vessel_key", "relationships", parent="dim_vessels", parent_column="vessel_key"),
    Check("fct_ais_anomalies", "anomaly_ts", "not_null"),
    Check("fct_ais_anomalies", "anomaly_type", "not_null"),
    Check("fct_ais_anomalies", "risk_score", "not_null"),
    Check("fct_ais_anomalies", "risk_score", "accepted_range", lo=0.0, hi=100.0),
    Check("fct_ais_anomalies", "time_gap_minutes", "accepted_range", lo=0.0),
    Check("fct_ais_anomalies", "distance_gap_nm", "accepted_range", lo=0.0),
    Check("dim_vessels", "vessel_key", "unique"),
    Check("dim_vessels", "vessel_key", "not_null"),
    Check("dim_vessels", "vessel_type_desc", "not_null"),
    Check("dim_ports", "port_key", "unique"),
    Check("dim_ports", "port_key", "not_null"),
    Check("dim_ports", "port_name", "not_null"),
    Check("dim_ports", "country", "not_null"),
    Check("dim_ports", "latitude", "not_null"),
    Check("dim_ports", "latitude", "accepted_range", lo=-90.0, hi=90.0),
    Check("dim_ports", "longitude", "not_null"),
    Check("dim_ports", "longitude", "accepted_range", lo=-180.0, hi=180.0),
    Check("dim_ports", "channel_depth_m", "accepted_range", lo=0.0),
    Check("dim_time", "time_key", "unique"),
    Check("dim_time", "time_key", "not_null"),
    Check("dim_time", "hour", "accepted_range", lo=0.0, hi=23.0),
    Check("dim_time", "month", "accepted_range", lo=1.0, hi=12.0),
    Check("dim_weather_zones", "zone_key", "unique"),
    Check("dim_weather_zones", "zone_key", "not_null"),
    Check("dim_weather_zones", "zone_name", "unique"),
    Check("dim_weather_zones", "zone_name", "not_null"),
    Check("obt_vessel_tracking", "vessel_key", "not_null"),
    Check("obt_vessel_tracking", "position_ts", "not_null"),
    Check("dim_vessels_scd2", "mmsi", "not_null"),
]


def _row_checks(table: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    """All null and range checks of a table in one pass."""
    failing = [
        F.count_if(
            F.col(c.column).isNull() if c.kind == "not_null" else out_of_range(F.col(c.column), c.lo, c.hi)
        )
        for c in checks
    ]
    results = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.kind).alias("check_name"),
                n.alias("failures"),
            )
            for c, n in zip(checks, failing)
        ]
    )
    return df.agg(results.alias("r")).select(F.explode("r").alias("r")).select("r.*")


def _key_check(check: Check, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Unique and relationship checks work on rows per key, so a hot key is one row after the map side."""
    per_key = (
        df.filter(F.col(check.column).isNotNull())
        .groupBy(F.col(check.column).alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if check.kind == "unique":
        failures = per_key.agg(F.count_if(F.col("n") > 1).alias("failures"))
    else:
        parents = tables[check.parent].select(F.col(check.parent_column).alias("k"))
        orphans = per_key.join(parents, "k", "left_anti")
        failures = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
    return failures.select(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        "failures",
    )


def run_checks(tables: dict[str, DataFrame], suite: list[Check] | None = None) -> DataFrame:
    """Failures per check: one pass per table, plus one small job per key check."""
    suite = GOLD_SUITE if suite is None else suite
    parts = []
    for table in dict.fromkeys(c.table for c in suite):
        mine = [c for c in suite if c.table == table]
        by_row = [c for c in mine if c.kind in ("not_null", "accepted_range")]
        if by_row:
            parts.append(_row_checks(table, tables[table], by_row))
        parts += [_key_check(c, tables[table], tables) for c in mine if c not in by_row]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")
    )


def quality_score(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows, duplicates, nulls and a grade from 0 (empty) to 3 (clean) in one row.

    Null keys count as duplicates. Rows are first counted per key, so the distinct
    count needs no second pass and a hot key shrinks on the map side.
    """
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in columns])
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("nulls"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("k").alias("distinct_keys"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("total_nulls"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))
    cells = F.nullif(F.col("total_rows") * F.lit(len(columns)), F.lit(0))
    grade = (
        F.when(F.col("total_rows") == 0, 0)
        .when((F.col("duplicate_rows") > 0) | (F.col("total_nulls") > F.col("total_rows")), 1)
        .when(F.col("total_nulls") > 0, 2)
        .otherwise(3)
    )
    return totals.select(
        "total_rows",
        "duplicate_rows",
        "total_nulls",
        parity_round(F.lit(100.0) * F.col("total_nulls") / cells, 2).alias("null_pct"),
        grade.alias("grade"),
    )
