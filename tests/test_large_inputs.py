"""How the larger queries lay out their work."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tarmac.operators import ingest
from tarmac.plans import catalog, round_trips
from tarmac.plans.data import Data
from tarmac.sources import files
from tests.conftest import FLIGHT_DEFAULTS, SF_DIR


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flights_are_shuffled_before_their_texts_are_made(data):
    above, below = optimized(data.derive_flights()).split("RebalancePartitions")
    assert "lpad" in above and "lpad" not in below


def test_orders_meet_customers_before_lines(data):
    plan = optimized(data.derive_flights())
    assert plan.index("l_orderkey") < plan.index("o_custkey")
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and len(joins) == 3


def test_monthly_files_come_in_ordered_parts(spark, data, folder):
    # small ranges stay apart
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        round_trips._write_monthly_csv(data, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    paths = files.glob(spark, f"{folder}/csv/*.csv")
    raw = data.raw_flights_text
    names = {p.rsplit("/", 1)[1] for p in paths}
    assert len(paths) > 12 and {n[:7] for n in names} == {f"2023_{m:02d}" for m in range(1, 13)}
    read = [tuple(r) for path in paths for r in spark.read.option("header", True).csv(path).select("FL_DATE", "OP_CARRIER_FL_NUM").collect()]
    wanted = raw.orderBy("source_file", "source_row").select("FL_DATE", "OP_CARRIER_FL_NUM").collect()
    # white space at the ends is read as it stands only with the readers' own options
    strip = lambda rows: [tuple(None if v is None else v.strip() for v in r) for r in rows]
    assert strip(read) == strip(wanted)


def test_file_stats_compare_keys_and_sources_only(data):
    plan = optimized(catalog.CATALOG["file_stats"](data))
    assert "min(struct(" in plan
    assert not [line for line in plan.splitlines() if "distance_miles" in line and "Relation" not in line]


def test_flights_without_a_date_arrive_too(spark, folder):
    rows = [{**FLIGHT_DEFAULTS, "id": 10 * n, "flight_number": str(n)} for n in range(3)]
    flights = spark.createDataFrame(rows, "id long, flight_date string, airline_code string, flight_number string, "
        "origin string, destination string, dep_time string, dep_delay_min int, arr_time string, arr_delay_min int, "
        "cancelled boolean, diverted boolean, distance_miles int, carrier_delay int, weather_delay int, nas_delay int, "
        "security_delay int, late_aircraft_delay int")
    flights = flights.withColumn("flight_date", F.when(F.col("id") > 0, F.col("flight_date")).cast("date"))
    stored = round_trips.stream_insert_recent(SimpleNamespace(spark=spark, root=folder, plain_flights=flights))
    assert sorted(r["id"] for r in stored.collect()) == [0, 10, 20]


def test_arrivals_are_written_without_a_shuffle(spark, data, folder, monkeypatch):
    hinted = []
    monkeypatch.setattr(type(data.plain_flights), "hint", lambda df, *a: hinted.append(a) or df)
    monkeypatch.setattr(round_trips.event_time, "stream_insert_recent", lambda *a: SimpleNamespace(awaitTermination=lambda: None))
    monkeypatch.setattr(round_trips.event_time, "read_recent", lambda *a: data.flights)
    round_trips.stream_insert_recent(SimpleNamespace(spark=spark, root=folder, plain_flights=data.plain_flights))
    assert not hinted
    arrived = spark.read.parquet(*files.glob(spark, f"{folder}/stream-recent-*/arrivals/*"))
    twice = data.plain_flights.unionByName(data.plain_flights)
    assert sorted(map(str, arrived.select(*twice.columns).collect())) == sorted(map(str, twice.collect()))


def test_raw_flights_are_made_in_one_scan_and_not_stored(spark, data, folder):
    raw = data.raw_flights_text
    plan = optimized(raw)
    assert plan.count("Relation") == 1 and "Union" not in plan
    assert not files.exists(spark, f"{data.root}/raw_flights")
    copies = raw.groupBy((F.col("source_row") / 2).cast("long").alias("id")).count().filter("count > 1").collect()
    flights = data.plain_flights.filter("id % 41 = 0").select("id").distinct().collect()
    assert {r["id"] for r in copies} >= {r["id"] for r in flights} and copies


def test_flights_read_once_are_not_stored_for_it(spark, folder):
    fresh = Data(spark, SF_DIR)
    fresh.root = folder
    once = fresh.raw_flights_once
    assert "Rebalance" not in optimized(once) and not files.exists(spark, f"{folder}/flights")
    assert sorted(map(str, once.collect())) == sorted(map(str, fresh.raw_flights.collect()))


def test_texts_are_parsed_once_for_the_parsable_rows(data):
    plan = optimized(catalog.CATALOG["ingest_flights"](data))
    assert not [line for line in plan.splitlines() if "Filter" in line and ("FL_DATE" in line or "gettimestamp" in line)]


@pytest.mark.parametrize("name", ["insert_flights", "insert_flights_filtered"])
def test_rows_to_insert_are_parsed_once(data, monkeypatch, name):
    asked = []
    for module, made in ((ingest, "insert_flights"), (round_trips, "insert_flights_filtered")):
        monkeypatch.setattr(module, made, lambda *a: asked.append(a[-2]) or a[-2])
    catalog.CATALOG[name](data)
    plan = optimized(asked[0])
    assert not [line for line in plan.splitlines() if "Filter" in line and ("FL_DATE" in line or "gettimestamp" in line)]


def test_rows_are_grouped_in_the_order_of_stored_months(data):
    """Months are sorted by airline and date, so these come first in the sort for the first row of a key."""
    plan = catalog.CATALOG["insert_flights"](data)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line and "dep_time" in line]
    assert len(sorts) == 2
    assert all(line.split("Sort [")[1].startswith("airline_code#") and "flight_date#" in line.split(",")[1] for line in sorts)


def test_parsable_rows_are_not_wrapped_to_be_kept(data):
    plan = optimized(catalog.CATALOG["ingest_flights"](data))
    assert "inline(" not in plan and "RLIKE" not in plan
