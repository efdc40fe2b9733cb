"""Writing and finding layer tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import delete_path, shuffles_deleted

#: The folder of each part of a table written in parts.
PART = "vessel_part"


def publish(df: DataFrame, path: str, date_of: str | None = None) -> DataFrame:
    """Replace the table at ``path`` and read it back.

    ``date_of`` partitions the files by the day of that timestamp, so that a
    filter on ``<date_of>_day`` skips the other days. The rebalance hint evens
    out file sizes: a day with very many rows is split over tasks. Shuffle files
    go with the write.
    """
    if date_of is None:
        with shuffles_deleted(df.sparkSession):
            df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    day = f"{date_of}_day"
    with shuffles_deleted(df.sparkSession):
        (
            df.withColumn(day, F.to_date(date_of))
            .hint("rebalance", day)
            .write.mode("overwrite")
            .partitionBy(day)
            .parquet(path)
        )
    schema = T.StructType([*df.schema.fields, T.StructField(day, T.DateType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def publish_in_parts(spark: SparkSession, part: Callable[[int], DataFrame], parts: int, path: str) -> DataFrame:
    """Replace the table at ``path`` with the rows of ``part(0)``, ``part(1)`` and so on, and read it back.

    One part is written after the other and its shuffle files go with it, so the
    disk in between is that of one part. A part has a folder of its own: a
    filter on the added column ``PART`` reads that alone. The success marker
    comes with the last one.
    """
    delete_path(spark, path)
    for k in range(parts):
        rows = part(k)
        with shuffles_deleted(spark):
            rows.write.option("compression", "zstd").parquet(f"{path}/{PART}={k}")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker).close()
    schema = T.StructType([*rows.schema.fields, T.StructField(PART, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to the table at ``path``; loading a file twice keeps both copies."""
    df.write.mode("append").parquet(path)


def register(
    spark: SparkSession, database: str, name: str, path: str, df: DataFrame, date_of: str | None = None
) -> None:
    """Make a published path known to the catalog as ``database.name``."""
    day = [] if date_of is None else [T.StructField(f"{date_of}_day", T.DateType())]
    columns = T.StructType([*df.schema.fields, *day])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    layout = f"partitioned by (`{day[0].name}`)" if day else ""
    spark.sql(f"create database if not exists {database}")
    spark.sql(f"drop table if exists {database}.{name}")
    spark.sql(f"create table {database}.{name} ({ddl}) using parquet {layout} location '{path}'")
    if day:
        spark.sql(f"msck repair table {database}.{name}")


def schema_catalog(spark: SparkSession, database: str) -> DataFrame:
    """Tables, columns, types and column order of a database."""
    rows = [
        (table.name, column.name, column.dataType, position)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
        for position, column in enumerate(spark.catalog.listColumns(f"{database}.{table.name}"), start=1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def schema_text(catalog: DataFrame, database: str) -> DataFrame:
    """One line per table: ``- database.table: column (type), ...``."""
    described = F.concat("column_name", F.lit(" ("), "data_type", F.lit(")"))
    columns = F.array_sort(F.collect_list(F.struct("ordinal", described.alias("text"))))
    return catalog.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.concat(
            F.lit(f"- {database}."),
            F.col("table_name"),
            F.lit(": "),
            F.concat_ws(", ", F.transform(columns, lambda c: c["text"])),
        ).alias("line")
    )


def allowed_names(catalog: DataFrame, database: str) -> DataFrame:
    """Bare and qualified table names, lower case."""
    bare = F.lower("table_name")
    return catalog.select(
        F.explode(F.array(bare, F.concat(F.lit(f"{database.lower()}."), bare))).alias("name")
    ).distinct()


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The named table, or no rows of ``schema`` where it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def time_text(column: Column) -> Column:
    """A time as text with six digits of a second, or none where it is whole."""
    whole = F.date_format(column, "SSSSSS") == "000000"
    return F.when(whole, F.date_format(column, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def to_records(df: DataFrame, names: dict[str, str | dict[str, str]]) -> DataFrame:
    """Rows as JSON text under new keys; times become text.

    ``names`` maps a column to its key. A key that maps to another such table
    holds a record of its own, null where all of its columns are.
    """

    def field(old: str) -> Column:
        timed = isinstance(df.schema[old].dataType, (T.TimestampType, T.TimestampNTZType))
        return time_text(F.col(old)) if timed else F.col(old)

    def record(table: dict) -> Column:
        return F.struct(*[nested(k, v) if isinstance(v, dict) else field(k).alias(v) for k, v in table.items()])

    def nested(key: str, table: dict[str, str]) -> Column:
        some = F.coalesce(*[F.when(F.col(old).isNotNull(), 1) for old in table])
        return F.when(some.isNotNull(), record(table)).alias(key)

    return df.select(F.to_json(record(names), {"ignoreNullFields": "false"}).alias("value"))
