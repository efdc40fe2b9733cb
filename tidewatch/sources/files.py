"""Which files a set of paths names, and which of them share a schema."""

from __future__ import annotations

import fnmatch

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T


def named_files(spark: SparkSession, paths: list[str], patterns: list[str]) -> list[str]:
    """Every named file, and the files directly in a named directory whose names match a pattern.

    Sub-folders are not searched; hidden files and markers are left out of a
    directory. Sorted and without repeats. A path that names nothing is an error.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = set()
    for text in paths:
        path = hadoop.Path(text)
        system = path.getFileSystem(conf)
        named = system.globStatus(path)
        if not named:
            raise FileNotFoundError(text)
        for status in named:
            if status.isFile():
                found.add(status.getPath().toString())
                continue
            for entry in system.listStatus(status.getPath()):
                name = entry.getPath().getName()
                if entry.isFile() and name[0] not in "._" and any(fnmatch.fnmatchcase(name, p) for p in patterns):
                    found.add(entry.getPath().toString())
    return sorted(found)


def parquet_by_schema(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files in groups whose columns have the same types.

    One job reads the footers of many files and merges their schemas; only
    where that fails are the files halved and tried again, so a few changes of
    type in a long list cost a few jobs more.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    open_lists = [files] if files else []
    while open_lists:
        part = open_lists.pop()
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*part).schema
        except (PySparkException, Py4JJavaError) as error:
            if len(part) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
            half = len(part) // 2
            open_lists += [part[:half], part[half:]]
            continue
        groups.setdefault(schema.json(), (schema, []))[1].extend(part)
    return list(groups.values())
