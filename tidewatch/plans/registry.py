"""Every query by name, with the SQL it is checked against where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans import adapters
from tidewatch.plans.warehouse import Warehouse
from tidewatch.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    check: str | None


REGISTRY: dict[str, Entry] = {}
_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def edge(df: DataFrame) -> DataFrame:
    """Times leave without a zone, as the driver tables carry them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if f.dataType == T.TimestampType() else f"`{f.name}`"
            for f in df.schema
        ]
    )


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return edge(run(spark, sf_dir))

        REGISTRY[name] = Entry(prepared, check)
        return run

    return add


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The published warehouse over a folder of driver tables, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(
            spark,
            adapters.ais_raw(spark, sf_dir),
            adapters.raw_ports(spark, sf_dir),
            adapters.raw_weather(spark, sf_dir),
            root=fresh_path(spark, "warehouse"),
        )
    return _WAREHOUSES[key]
