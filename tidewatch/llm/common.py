"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import delete_path, fresh_path, ship_package, shuffles_deleted

#: Everything in ASCII that is neither a digit nor a letter ends a word; every other character belongs to one.
WORD_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here, and a lost executor costs no recompute."""
    path = fresh_path(df.sparkSession, name)
    if (paths := _PASSING.get()) is not None:
        paths.append(path)
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrowed(table: DataFrame, columns: list[str], name: str) -> DataFrame:
    """A stored table again with some of its columns; what was stored before is deleted."""
    less = stored(table.select(*columns), name)
    for path in {os.path.dirname(f) for f in table.inputFiles()}:
        delete_path(table.sparkSession, path)
    return less


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end: whatever was made of them must have been written elsewhere by then."""
    token = _PASSING.set([])
    try:
        yield
    finally:
        for path in _PASSING.get() or []:
            delete_path(spark, path)
        _PASSING.reset(token)


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package."""
    ship_package(spark)


def in_fold(key: Column, folds: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; a null key counts as empty text."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % folds == remainder


def word_list(text: Column) -> Column:
    """Lower-cased words of a text in order; null and empty texts have none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK)
    return F.filter(words, lambda w: w != "")


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents for which ``keep`` holds.

    The ids with the smallest hashes are taken, so the sample does not depend on
    the order or the partitions of the tables. A document with several labels
    has the larger one; null ids, null labels and labels without a document
    give no row. Only ids and labels, ``rows`` of them at most, are broadcast.
    """
    chosen = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & keep)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label")
