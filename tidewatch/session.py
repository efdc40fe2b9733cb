"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app_name: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects.

    On a cluster leave ``master`` unset and pass sizes (executors, shuffle
    partitions) through spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``.

    Where neither the setting nor the context names one, a local session gets a
    fresh temporary folder; any other master is refused, because a
    machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    current = spark.sparkContext.getCheckpointDir()
    if folder:
        if not current:
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="tidewatch-")
    spark.sparkContext.setCheckpointDir("file://" + folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING = threading.Lock()
_CLEANERS: dict[str, tuple[int, str]] = {}


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries run inside go when the query ends, not when the driver happens to collect its garbage.

    Tables may be written side by side: the last one to end puts the setting back.
    """
    key = spark._jsparkSession.sessionUUID()
    with _CLEANING:
        inside, before = _CLEANERS.get(key, (0, ""))
        before = before if inside else spark.conf.get(_CLEAN_SHUFFLES)
        _CLEANERS[key] = (inside + 1, before)
        spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        with _CLEANING:
            inside = _CLEANERS[key][0] - 1
            _CLEANERS[key] = (inside, before)
            if not inside:
                spark.conf.set(_CLEAN_SHUFFLES, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application.

    Needed by the operators that run Python in tasks, since a session may have
    started before the package was on anyone's path.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tidewatch-"), "tidewatch.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
