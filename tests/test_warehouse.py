"""The published warehouse as a whole."""

from pyspark.sql import functions as F

from conftest import TINY
from tidewatch.operators import quality, serving
from tidewatch.plans import adapters
from tidewatch.plans.warehouse import LAYERS, WAVES, Warehouse


def test_build_publishes_every_model(spark, tmp_path):
    house = Warehouse(
        spark,
        adapters.ais_raw(spark, TINY),
        adapters.raw_ports(spark, TINY),
        adapters.raw_weather(spark, TINY),
        root=str(tmp_path),
    )
    names = {n for layer in LAYERS.values() for n in layer}
    assert names == {n for wave in WAVES for n in wave} == set(house.build())
    assert all(house.latest(n).endswith(house.path(n)) for n in names)
    assert all(len(list((tmp_path / layer / n).glob("build=*/_SUCCESS"))) == 1 for layer, ns in LAYERS.items() for n in ns)
    assert house.table("fct_vessel_positions") is house.build()["fct_vessel_positions"]

    gold = house.gold()
    failed = quality.run_checks(gold).filter("status = 'fail'").collect()
    # vessels without a type have no description; calls in ports without a name have no port row
    assert {(r.table_name, r.column_name) for r in failed} <= {("dim_vessels", "vessel_type_desc"), ("fct_port_calls", "port_key")}

    report = {r.label: (r.n, r.status) for r in serving.build_report({k: v for k, v in gold.items() if k != "dim_time"}).collect()}
    assert report["Vessel positions"] == (978, "built") and report["Time dimension"] == (None, "not built")


def test_history_lives_on_and_old_builds_go(spark, tmp_path):
    pings = adapters.ais_raw(spark, TINY)
    counts = []
    for day, kept in ((1, pings), (2, pings.filter("MMSI <> '7'")), (3, pings.filter("MMSI <> '7'"))):
        when = F.to_timestamp(F.lit(f"2024-03-0{day}"))
        house = Warehouse(spark, kept, None, None, root=str(tmp_path), as_of=when)
        history = house.table("dim_vessels_scd2")
        counts.append((history.count(), history.filter("valid_to is not null").count()))
    vessels = counts[0][0]
    assert counts == [(vessels, 0), (vessels, 1), (vessels, 1)]
    house.drop_old(keep=1)
    assert house._builds("dim_vessels_scd2") == [house.latest("dim_vessels_scd2")]
    assert history.count() == vessels
