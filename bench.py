"""Headline queries at one scale; prints one JSON line.

Inputs are the driver tables at $BENCH_SF_DIR on local[$BENCH_CPUS]. Each query
is run once to warm up and then three times in full (every row and column is
produced and dropped); the median counts. ``warehouse_build`` is one cold build
of all published tables; ``srv*`` and ``dq5`` run on those tables, all others
start from the raw driver tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatch.plans import all_entries  # noqa: E402
from tidewatch.plans.registry import warehouse  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

HEADLINE = [
    "sil5_dedup_positions",
    "sil6_near_ports",
    "sil8_port_calls",
    "gld5_fct_vessel_positions",
    "gld10_ais_anomalies",
    "gld14_dim_vessels",
    "gld18_obt_vessel_tracking",
    "srv1_kpis",
    "srv6_top_ports",
    "srv13_latest_positions",
    "dq5_run_checks",
    "ml3_delay_features",
]
RUNS = 3


def produce(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="run-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    entries = all_entries()

    times = {"warehouse_build": timed(lambda: warehouse(spark, sf_dir).build())}
    for name in HEADLINE:
        run = entries[name].run
        produce(run(spark, sf_dir))
        times[name] = statistics.median(timed(lambda: produce(run(spark, sf_dir))) for _ in range(RUNS))

    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
