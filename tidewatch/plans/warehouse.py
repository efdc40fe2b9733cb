"""The layered warehouse: every model is a published table, built when first asked for."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import anomalies, dimensions, history, port_calls, ports, positions, weather
from tidewatch.session import shared_dir
from tidewatch.sources.tables import PART, publish, publish_in_parts, register

LAYERS = {
    "silver": [
        "stg_vessel_positions",
        "port_events",
        "stg_port_calls",
        "stg_ports",
        "stg_marine_weather",
    ],
    "gold": [
        "fct_vessel_positions",
        "fct_port_calls",
        "fct_ais_anomalies",
        "dim_vessels",
        "dim_ports",
        "dim_time",
        "dim_weather_zones",
        "dim_vessels_scd2",
        "obt_vessel_tracking",
    ],
}

# Models that can be built side by side, in order of dependence.
WAVES = [
    [
        "stg_vessel_positions",
        "dim_vessels_scd2",
        "stg_marine_weather",
        "stg_ports",
        "dim_time",
        "dim_weather_zones",
    ],
    ["port_events", "fct_vessel_positions", "dim_vessels", "dim_ports"],
    ["stg_port_calls", "fct_ais_anomalies", "obt_vessel_tracking"],
    ["fct_port_calls"],
]

# Facts whose files are laid out by day, and the time that decides the day.
DAILY = {"fct_vessel_positions": "position_ts", "obt_vessel_tracking": "position_ts"}


class Warehouse:
    """Bronze frames in, published silver and gold tables out.

    ``table(name)`` writes a model and what it needs below ``root`` once, then
    reads it back, so that later models start from stored rows instead of
    recomputing (and losing, with an executor) a long lineage.

    Every build writes to paths of its own, ``<table>/build=<time>-<id>``. A
    table is complete once its success marker is there; readers and the next
    build take the newest complete one, so a table is never seen half written.
    The vessel history goes on from the build before. ``drop_old`` removes what
    no reader needs any more.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw_positions: DataFrame,
        raw_ports: DataFrame,
        raw_weather: DataFrame,
        root: str | None = None,
        as_of: Column | None = None,
    ) -> None:
        self.spark = spark
        self.raw_positions = raw_positions
        self.raw_ports = raw_ports
        self.raw_weather = raw_weather
        self.root = (root or f"{shared_dir(spark)}/warehouse").rstrip("/")
        self.as_of = as_of
        self.build_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        self._built: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def _model(self, name: str) -> DataFrame:
        t = self.table
        models: dict[str, Callable[[], DataFrame]] = {
            "stg_vessel_positions": lambda: positions.stage_positions(self.raw_positions),
            "stg_ports": lambda: ports.clean_ports(self.raw_ports),
            "stg_marine_weather": lambda: weather.stage_weather(self.raw_weather),
            "fct_vessel_positions": lambda: positions.fct_vessel_positions(t("stg_vessel_positions")),
            "fct_port_calls": lambda: port_calls.fct_port_calls(t("stg_port_calls")),
            "fct_ais_anomalies": lambda: anomalies.fct_ais_anomalies(t("fct_vessel_positions")),
            "dim_vessels": lambda: dimensions.dim_vessels(t("stg_vessel_positions")),
            "dim_ports": lambda: ports.dim_ports(t("stg_ports")),
            "dim_time": lambda: dimensions.dim_time(self.spark),
            "dim_weather_zones": lambda: dimensions.dim_weather_zones(self.spark),
            "dim_vessels_scd2": self._vessel_history,
            "obt_vessel_tracking": lambda: dimensions.obt_vessel_tracking(
                t("fct_vessel_positions"), t("dim_vessels"), t("dim_time")
            ),
        }
        return models[name]()

    def _parted(self, name: str) -> DataFrame | None:
        """A model written for some vessels after the others, with the column that tells the part; None for other models."""
        if name == "port_events":
            staged = self.table("stg_vessel_positions")
            n = port_calls.parts_of(staged)
            return publish_in_parts(
                self.spark, lambda k: port_calls.stops_near(port_calls.vessel_part(staged, k, n), self.raw_ports), n, self.path(name)
            )
        if name == "stg_port_calls":
            n, events = port_calls.parts_of(self.table("stg_vessel_positions")), self._parts_of("port_events")
            return publish_in_parts(
                self.spark,
                lambda k: port_calls.port_calls(events.filter(F.col(PART) == k).drop(PART), bucket=port_calls.STOPS_SPAN),
                n,
                self.path(name),
            )
        return None

    def _parts_of(self, name: str) -> DataFrame:
        self.table(name)
        return self._stored[name]

    def _vessel_history(self) -> DataFrame:
        """The history of the build before and one more snapshot."""
        source = history.scd2_source(self.raw_positions)
        before = self.latest("dim_vessels_scd2")
        if before is None:
            return history.first_snapshot(source, as_of=self.as_of)
        return history.scd2_merge(self.spark.read.parquet(before), source, as_of=self.as_of)

    def _folder(self, name: str) -> str:
        layer = next(layer for layer, names in LAYERS.items() if name in names)
        return f"{self.root}/{layer}/{name}"

    def path(self, name: str) -> str:
        """Where this build writes a table."""
        return f"{self._folder(name)}/build={self.build_id}"

    def _builds(self, name: str) -> list[str]:
        """Complete builds of a table, oldest first."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._folder(name)}/build=*/_SUCCESS")
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(f.getPath().getParent().toString() for f in system.globStatus(path) or [])

    def latest(self, name: str) -> str | None:
        """Path of the newest complete build of a table."""
        return (self._builds(name) or [None])[-1]

    def drop_old(self, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` builds of every table."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in (n for names in LAYERS.values() for n in names):
            for old in self._builds(name)[:-keep]:
                hadoop.Path(old).getFileSystem(conf).delete(hadoop.Path(old), True)

    def table(self, name: str) -> DataFrame:
        if name not in self._built and (parted := self._parted(name)) is not None:
            self._stored[name] = parted
            self._built[name] = parted.drop(PART)
        if name not in self._built:
            df = self._model(name)
            stored = publish(df, self.path(name), DAILY.get(name))
            self._built[name] = stored.select(*df.columns)
        return self._built[name]

    def build(self, threads: int = 4) -> dict[str, DataFrame]:
        """Publish every model, up to ``threads`` at a time."""
        with ThreadPoolExecutor(threads) as pool:
            for wave in WAVES:
                list(pool.map(self.table, wave))
        return dict(self._built)

    def gold(self) -> dict[str, DataFrame]:
        self.build()
        return {name: self.table(name) for name in LAYERS["gold"]}

    def register_gold(self, database: str = "gold") -> None:
        """Make the gold tables known to the catalog."""
        for name, df in self.gold().items():
            register(self.spark, database, name, self.path(name), df, DAILY.get(name))
