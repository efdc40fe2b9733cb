"""The port index as CSV."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas
from tidewatch.functions import to_int
from tidewatch.sources.files import named_files


def _texts(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """All CSV files at ``path`` as text columns under their own headers, missing columns null."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file in named_files(spark, [path], ["*.csv"]):
        by_header[tuple(reader.csv(file).columns)].append(file)
    known = schemas.PORTS.names
    frames = []
    for header, files in by_header.items():
        df = reader.option("inferSchema", infer).csv(files)
        names = {c.strip().lower(): c for c in header}
        frames.append(df.select(*[(F.col(f"`{names[k]}`") if k in names else F.lit(None).cast("string")).alias(k) for k in known]))
    empty = spark.createDataFrame([], ", ".join(f"{k} string" for k in known))
    return reduce(DataFrame.unionByName, frames) if frames else empty


def _typed(field: T.StructField) -> Column:
    if field.dataType == T.StringType():
        return F.col(field.name)
    return to_int(F.col(field.name)) if field.dataType == T.IntegerType() else F.col(field.name).try_cast(field.dataType)


def read_ports(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Port CSV files with headers: one file, or all ``*.csv`` of a directory.

    Columns are found by header name, in any order and case; quotes inside
    quoted text are doubled. Text that is no number becomes null, and
    ``bad_ports`` returns those rows. ``infer`` lets Spark guess types instead,
    with an extra pass; then all files must agree in them.
    """
    texts = _texts(spark, path, infer)
    return texts if infer else texts.select(*[_typed(f).alias(f.name) for f in schemas.PORTS])


def bad_ports(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files, as text, in which some value is lost by ``read_ports``."""
    lost = [F.col(f.name).isNotNull() & _typed(f).isNull() for f in schemas.PORTS]
    return _texts(spark, path).filter(F.array_contains(F.array(*lost), True))
