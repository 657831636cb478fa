"""Bloom filters of stored business keys."""

import random

import pytest
from pyspark.sql import functions as F

from tarmac.operators.ingest import insert_flights
from tarmac.operators.quality import BUSINESS_KEY
from tarmac.sources import key_filters, tables
from tarmac.sources.key_filters import append_filtered, new_flights_filtered, read_filters, rebuild_filters, with_may_be_stored

YEARS = (2023,)


@pytest.fixture
def many(flights_of):
    """Flights with repeated and with NULL parts of their keys."""
    def build(seed, count, first_id=0):
        rng = random.Random(seed)
        return flights_of(*[
            {"id": first_id + i, "flight_date": f"2023-{rng.randint(1, 3):02d}-{rng.randint(1, 28):02d}",
             "flight_number": rng.choice([None, str(rng.randint(1, 40))]), "airline_code": rng.choice(["AA", "DL"]),
             "dep_time": rng.choice([None, "08:00:00", "09:30:00"])} for i in range(count)])

    return build


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_no_stored_key_is_missed_and_few_others_are_told(spark, data, folder):
    flights = data.plain_flights
    stored = tables.with_partition(flights.filter("flight_date < DATE'2023-07-01'"), YEARS)
    filters = key_filters.key_filters(stored.select(*BUSINESS_KEY, "flight_month"))
    filters.write.parquet(f"{folder}/keys")
    filters = spark.read.parquet(f"{folder}/keys")
    told = with_may_be_stored(stored, filters)
    assert told.filter("NOT may_be_stored").isEmpty() and told.count() == stored.count()
    others = with_may_be_stored(stored.withColumn("flight_number", F.concat(F.lit("X"), "flight_number")), filters)
    share = others.agg(F.avg(F.col("may_be_stored").cast("double"))).collect()[0][0]
    assert share < 0.03


def test_new_flights_equal_the_exact_path(spark, many, folder):
    stored, arriving = many(1, 300), many(2, 400, 1000).unionByName(many(1, 50, 5000))
    tables.write_flights(stored, f"{folder}/flights", YEARS)
    rebuild_filters(spark, f"{folder}/flights", f"{folder}/keys")
    told = new_flights_filtered(arriving, f"{folder}/flights", f"{folder}/keys", YEARS, ("id",))
    exact = insert_flights(arriving, stored, ("id",))
    assert ids(told) == ids(exact) and told.columns == [c for c in exact.columns]


def test_only_days_of_doubtful_rows_are_read(spark, many, folder):
    tables.write_flights(many(3, 200), f"{folder}/flights", YEARS)
    rebuild_filters(spark, f"{folder}/flights", f"{folder}/keys")
    known = tables.read_flights(spark, f"{folder}/flights").filter("flight_month = '2023-02'").limit(1).drop("created_at", "flight_month")
    told = new_flights_filtered(known.unionByName(many(4, 5, 9000).withColumn("flight_number", F.lit("never"))), f"{folder}/flights", f"{folder}/keys", YEARS, ("id",))
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert "2023-02" in plan and "2023-01" not in plan
    new = new_flights_filtered(known.withColumn("flight_number", F.lit("never")), f"{folder}/flights", f"{folder}/keys", YEARS, ("id",))
    assert "/flights" not in "".join(new.inputFiles()) and new.count() == 1


def test_appends_keep_the_filters_and_the_table_in_step(spark, many, folder, monkeypatch):
    """Filters grow, are put together and made anew; a repeated append adds nothing."""
    path, root, seen = f"{folder}/flights", f"{folder}/keys", None
    for seed in (5, 6, 5, 7):
        batch = many(seed, 150, 1000 * seed)
        append_filtered(batch, path, root, YEARS, ("id",))
        seen = batch if seen is None else seen.unionByName(batch)
        stored = tables.read_flights(spark, path)
        keys = stored.select(*BUSINESS_KEY)
        assert keys.distinct().count() == keys.count() == seen.select(*BUSINESS_KEY).distinct().count()
        assert with_may_be_stored(stored, read_filters(spark, root)).filter("NOT may_be_stored").isEmpty()


def test_months_without_a_filter_are_compared_in_full(spark, many, folder):
    path, root = f"{folder}/flights", f"{folder}/keys"
    tables.write_flights(many(8, 200), path, YEARS)
    assert new_flights_filtered(many(8, 200, 5000), path, root, YEARS, ("id",)).isEmpty()
    rebuild_filters(spark, path, root, ["2023-01"])
    assert new_flights_filtered(many(8, 200, 5000), path, root, YEARS, ("id",)).isEmpty()


def test_a_replaced_month_gets_a_new_filter(spark, many, folder):
    path, root = f"{folder}/flights", f"{folder}/keys"
    old = many(9, 200)
    tables.write_flights(old, path, YEARS)
    rebuild_filters(spark, path, root)
    tables.replace_month(many(10, 100, 9000).filter("flight_date < DATE'2023-02-01'"), path, "2023_01.csv", YEARS, ("id",))
    rebuild_filters(spark, path, root, ["2023-01"])
    for rows in (old, many(10, 100, 20000)):
        exact = insert_flights(rows, tables.read_flights(spark, path).select(*BUSINESS_KEY), ("id",))
        assert ids(new_flights_filtered(rows, path, root, YEARS, ("id",))) == ids(exact)


def test_large_filters_are_hashed_and_asking_rows_not_sorted(spark, many, folder, monkeypatch):
    path, root, arriving = f"{folder}/flights", f"{folder}/keys", many(12, 200, 1000).unionByName(many(11, 60, 5000))
    tables.write_flights(many(11, 200), path, YEARS)
    rebuild_filters(spark, path, root)
    placed, filters = tables.with_partition(arriving, YEARS), read_filters(spark, root)
    small = with_may_be_stored(placed, filters)
    exact = ids(new_flights_filtered(arriving, path, root, YEARS, ("id",)))
    monkeypatch.setattr(key_filters, "WORDS_TO_BROADCAST", 0)
    large = with_may_be_stored(placed, filters)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    assert ids(new_flights_filtered(arriving, path, root, YEARS, ("id",))) == exact
