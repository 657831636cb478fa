"""Ingest of flights and dimensions on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import ingest
from tests.conftest import rows

RAW = {
    "FL_DATE": "2023-01-05", "OP_UNIQUE_CARRIER": "AA", "OP_CARRIER_FL_NUM": "1", "ORIGIN": "JFK",
    "DEST": "LAX", "DEP_TIME": "830", "DEP_DELAY": "5.00", "ARR_TIME": "1130", "ARR_DELAY": "7.00",
    "CANCELLED": "0.00", "DIVERTED": "0.00", "DISTANCE": "2475.00", "CARRIER_DELAY": None,
    "WEATHER_DELAY": None, "NAS_DELAY": None, "SECURITY_DELAY": None, "LATE_AIRCRAFT_DELAY": None,
}


@pytest.fixture
def raw_of(spark):
    def build(*changes: dict):
        full = [
            (*{**RAW, **{k: v for k, v in c.items() if k in RAW}}.values(), c.get("source_file", "2023_01.csv"), 0, i)
            for i, c in enumerate(changes)
        ]
        schema = ", ".join(f"{c} string" for c in RAW)
        return spark.createDataFrame(full, f"{schema}, source_file string, source_block bigint, source_row bigint")

    return build


@pytest.fixture
def dims(spark):
    airlines = spark.createDataFrame([("AA",), ("DL",)], "iata_code string")
    airports = spark.createDataFrame([("JFK",), ("LAX",)], "iata_code string")
    return airlines, airports


def test_good_row(raw_of):
    got = ingest.ingest_flights(raw_of({})).first()
    assert (str(got.flight_date), got.airline_code, got.dep_time, got.arr_delay_min) == ("2023-01-05", "AA", "08:30:00", 7)
    assert got.cancelled is False and got.distance_miles == 2475 and got.carrier_delay is None


@pytest.mark.parametrize(
    "change",
    [
        {"FL_DATE": None}, {"FL_DATE": "junk"}, {"OP_UNIQUE_CARRIER": None}, {"OP_UNIQUE_CARRIER": "AAL"},
        {"ORIGIN": None}, {"ORIGIN": "JF"}, {"DEST": " "}, {"DEST": "LAXX"},
    ],
)
def test_rows_without_required_fields_are_skipped(raw_of, change):
    parsed = ingest.parse_flights(raw_of(change))
    assert parsed.first().is_valid is False
    assert ingest.ingest_flights(raw_of(change, {})).count() == 1


def test_fields_are_cleaned(raw_of):
    got = ingest.ingest_flights(raw_of({
        "OP_UNIQUE_CARRIER": " aa ", "ORIGIN": "jfk ", "OP_CARRIER_FL_NUM": " 123456789012", "DEP_DELAY": "-121",
        "ARR_DELAY": "-120.9", "CANCELLED": "1.00",
    })).first()
    assert (got.airline_code, got.origin, got.flight_number) == ("AA", "JFK", "1234567890")
    assert (got.dep_delay_min, got.arr_delay_min, got.cancelled) == (None, -120, True)


def test_each_broken_rule_is_named(raw_of, dims):
    broken = {
        "same_origin_destination": {"DEST": "JFK"},
        "distance_not_positive": {"DISTANCE": "0"},
        "negative_delay_cause": {"NAS_DELAY": "-1"},
        "unknown_airline": {"OP_UNIQUE_CARRIER": "QQ"},
        "unknown_origin": {"ORIGIN": "QQQ"},
        "unknown_destination": {"DEST": "QQQ"},
        "distance_not_positive,unknown_airline": {"DISTANCE": "-3", "OP_UNIQUE_CARRIER": "QQ"},
    }
    checked = ingest.check_constraints(ingest.ingest_flights(raw_of(*broken.values(), {})), *dims)
    got = [r.reject_reason for r in checked.orderBy("source_row").collect()]
    assert got == [*broken, None]
    assert ingest.accepted(checked).count() == 1
    assert ingest.rejected(checked).count() == len(broken)


def test_null_values_pass_every_rule_but_the_date(flights_of, dims):
    nulls = {c: None for c in ("airline_code", "origin", "destination", "distance_miles", "dep_delay_min", "arr_delay_min")}
    assert ingest.check_constraints(flights_of(nulls), *dims).first().reject_reason is None
    assert ingest.check_constraints(flights_of({"flight_date": None}), *dims).first().reject_reason == "missing_flight_date"
    early = flights_of({"dep_delay_min": -121, "arr_delay_min": -121})
    assert ingest.check_constraints(early, *dims).first().reject_reason == "dep_delay_too_early,arr_delay_too_early"


def test_first_row_wins_and_nulls_are_equal(raw_of, flights_of):
    new = ingest.ingest_flights(raw_of(
        {"DEP_TIME": None, "DISTANCE": "1"}, {"DEP_TIME": None, "DISTANCE": "2"}, {"DISTANCE": "3"},
        {"OP_CARRIER_FL_NUM": "2", "DISTANCE": "4"},
    ))
    existing = flights_of({"flight_date": "2023-01-05", "dep_time": "08:30:00", "flight_number": "2"})
    got = ingest.insert_flights(new, existing)
    assert sorted(r.distance_miles for r in got.collect()) == [1, 3]
    assert set(got.columns) == set(new.columns)


def test_hot_key_is_reduced_before_the_shuffle(spark, raw_of, flights_of):
    """A third of the rows share one business key: each map task sends one row of it."""
    new = ingest.ingest_flights(raw_of({})).drop("source_row", "flight_number")
    new = new.repartition(4).selectExpr("*", "explode(sequence(0L, 29999L)) AS source_row").withColumn(
        "flight_number", F.expr("if(source_row % 3 = 0, '1', CAST(source_row AS STRING))")
    )
    got = ingest.insert_flights(new, flights_of({"flight_date": "2020-01-01"}))
    assert got.count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan and "Join" not in plan.split("Exchange")[0]


def test_ids_repeat_for_the_same_key(flights_of):
    flights = flights_of({"dep_time": None, "id": 5}, {"dep_time": None, "id": 6}, {"dep_time": "00:00:00"})
    a, b, c = [r.id for r in ingest.with_flight_id(flights).collect()]
    assert a == b != c


def test_file_stats_add_up(raw_of, dims, flights_of):
    raw = raw_of({}, {}, {"FL_DATE": "junk"}, {"DISTANCE": "0"}, {"source_file": "2023_02.csv", "FL_DATE": "2023-02-01"}, {"source_file": "bad.csv", "ORIGIN": None})
    checked = ingest.check_constraints(ingest.parse_flights(raw), *dims)
    good = ingest.accepted(checked.filter("is_valid"))
    stats = ingest.file_stats(checked, ingest.insert_flights(good, flights_of({"flight_date": "2020-01-01"})))
    assert sorted(rows(stats)) == [("2023_01.csv", 4, 1, 1, 1), ("2023_02.csv", 1, 1, 0, 0), ("bad.csv", 1, 0, 1, 0)]


def test_dry_run_looks_at_every_row_of_every_file(raw_of):
    last = {"source_file": "2023_12.csv"}
    raw = raw_of(*[{}] * 3, last, {**last, "FL_DATE": "junk"}, {**last, "FL_DATE": "junk"})
    assert sorted(rows(ingest.dry_run(raw))) == [("2023_01.csv", 3, 0, 0, 0), ("2023_12.csv", 3, 0, 2, 0)]
    assert sorted(rows(ingest.dry_run(raw, sample=2))) == [("2023_01.csv", 3, 0, 0, 0), ("2023_12.csv", 3, 0, 1, 0)]


def test_search_tokens_keep_accented_letters(spark):
    df = spark.sql("SELECT 'São Paulo–Guarulhos' AS name, 'Zürich' AS city, 'GRU' AS iata_code, 'BR' AS country")
    assert ingest.airport_search_tokens(df).first().search_tokens == ["br", "gru", "guarulhos", "paulo", "são", "zürich"]


AIRPORT_SCHEMA = (
    "iata_code string, type string, name string, municipality string, iso_country string, "
    "latitude_deg string, longitude_deg string, elevation_ft string, time_zone string"
)


def airports_of(spark, *changes):
    base = ("JFK", "large_airport", "Kennedy", "New York", "US", "40.6", "-73.7", "13", "America/New_York")
    names = [part.split()[0] for part in AIRPORT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple({**dict(zip(names, base)), **c}.values()) for c in changes], AIRPORT_SCHEMA)


def test_airports_keep_the_largest_type(spark):
    raw = airports_of(spark, {"type": "small_airport", "name": "S"}, {"type": "large_airport", "name": " L "}, {"type": "heliport", "name": "H"})
    assert rows(ingest.ingest_airports(raw)) == [("JFK", "L", "New York", "US", -73.7, 40.6, 13, "America/New_York")]


def test_airport_code_is_dropped_when_its_best_row_is_incomplete(spark):
    raw = airports_of(spark, {"latitude_deg": "x"}, {"type": "small_airport"})
    assert ingest.ingest_airports(raw).count() == 0


def test_airport_rows_that_do_not_count(spark):
    raw = airports_of(spark, {"iata_code": None}, {"iata_code": "JF"}, {"iata_code": "JF "}, {"iata_code": "   "}, {"type": "closed"}, {"name": " "})
    assert ingest.ingest_airports(raw).count() == 0


def test_airport_codes_that_differ_in_case_meet(spark):
    raw = airports_of(spark, {"name": "Large"}, {"iata_code": "jfk", "type": "small_airport", "name": "Small"})
    assert [r.name for r in ingest.ingest_airports(raw).collect()] == ["Small"]


def test_airport_country_and_blanks(spark):
    raw = airports_of(spark, {"iso_country": "USA", "municipality": " ", "elevation_ft": "x", "time_zone": None})
    got = ingest.ingest_airports(raw).first()
    assert (got.city, got.country, got.elevation_ft, got.timezone) == (None, "US", None, None)


def test_airlines_are_named_where_known(raw_of):
    raw = raw_of({"OP_UNIQUE_CARRIER": " wn"}, {"OP_UNIQUE_CARRIER": "WN"}, {"OP_UNIQUE_CARRIER": "q1"}, {"OP_UNIQUE_CARRIER": "LONG"}, {"OP_UNIQUE_CARRIER": None})
    assert sorted(rows(ingest.ingest_airlines(raw))) == [("Q1", "Airline Q1", "US"), ("WN", "Southwest Airlines", "US")]


def test_upsert_replaces_whole_rows(spark):
    schema = "iata_code string, name string"
    old = spark.createDataFrame([("A", "old"), ("B", "old")], schema)
    new = spark.createDataFrame([("B", None), ("C", "new")], schema)
    assert sorted(rows(ingest.upsert(old, new))) == [("A", "old"), ("B", None), ("C", "new")]


def test_airports_in_use_cannot_be_deleted(spark, flights_of):
    candidates = spark.createDataFrame([("JFK",), ("LAX",), ("BOS",)], "iata_code string")
    got = dict(rows(ingest.delete_airports(candidates, flights_of({}))))
    assert got == {"JFK": False, "LAX": False, "BOS": True}


def test_search_index_finds_both_kinds(spark):
    airports = spark.createDataFrame([("ATL", "Delta Field", "Atlanta", "US")], "iata_code string, name string, city string, country string")
    airlines = spark.createDataFrame([("DL", "Delta Air Lines", "US")], "iata_code string, name string, country string")
    index = ingest.search_index(airports, airlines)
    assert sorted(rows(index.filter("token = 'delta'").drop("token"))) == [("airline", "DL"), ("airport", "ATL")]
