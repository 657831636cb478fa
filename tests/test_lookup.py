"""Searches in stored postings, and statistics from footers."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import lookup
from tarmac.plans.data import YEARS
from tarmac.sources import footers, tables


@pytest.fixture(scope="module")
def postings(spark, tmp_path_factory):
    words = [f"w{i:04d}" for i in range(3000)]
    rows = [(w, "airport", f"A{i % 700:03d}") for i, w in enumerate(words)]
    rows += [("common", "airport", f"A{i:03d}") for i in range(700)] + [("air", "airline", "AA"), ("airport", "airport", "A001")]
    path = str(tmp_path_factory.mktemp("postings") / "p")
    lookup.write_postings(spark.createDataFrame(rows, lookup.POSTINGS_SCHEMA), path, 8)
    return lookup.read_postings(spark, path)


def codes(df):
    return sorted((r["code"], r["matched"]) for r in df.collect())


def test_all_words_any_word_and_prefix(postings):
    assert codes(lookup.find(postings, ["Common", "w0003", "common"])) == [("A003", 2)]
    assert codes(lookup.find(postings, ["w0003", "w0004"])) == []
    assert codes(lookup.find(postings, ["w0003", "w0703", "w0004"], every=False)) == [("A003", 2), ("A004", 1)]
    assert codes(lookup.find(postings, ["common", "w000"], prefix=True)) == [(f"A{i:03d}", 2) for i in range(10)]
    assert codes(lookup.find(postings, ["air"], prefix=True)) == [("A001", 1), ("AA", 1)]
    # a whole word may answer itself and the prefix
    assert codes(lookup.find(postings, ["air", "air"], prefix=True)) == [("AA", 2)]
    assert codes(lookup.find(postings, [])) == [] and codes(lookup.find(postings, ["no%", "_"])) == []


def test_a_lookup_reads_only_files_that_may_hold_its_words(spark, postings):
    found = lookup.find(postings, ["w0003", "w00"], prefix=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(In(token, [w0003]),StringStartsWith(token,w00))" in plan or "StringStartsWith(token,w00)" in plan
    ranges = postings.groupBy(F.input_file_name().alias("f")).agg(F.min("token").alias("a"), F.max("token").alias("b")).collect()
    assert len(ranges) == 8 and sum(r["a"] <= "w0003" <= r["b"] for r in ranges) == 1


def test_footers_answer_without_reading_rows(spark, data):
    stats = footers.footer_stats(spark, data.flights_path)
    exact = data.flights.groupBy("flight_month").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("flight_date").alias("first_date"), F.max("flight_date").alias("last_date"))
    assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, exact.collect()))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    total = footers.count_whole_months(stats, "2023-02-01", "2023-03-31").collect()[0][0]
    assert total == data.flights.filter("month(flight_date) IN (2, 3)").count()
    with pytest.raises(Exception, match="only part of it"):
        footers.count_whole_months(stats, "2023-02-10", "2023-03-31").collect()


def test_what_is_read_from_footers_does_not_depend_on_the_rows(spark, flights_of, folder):
    """The scan gives one row per file, however many rows the files hold."""
    for name, rows in (("few", 3), ("many", 3000)):
        flights = flights_of(*[{"id": i, "flight_date": "2023-01-05"} for i in range(rows)])
        tables.write_flights(flights, f"{folder}/{name}", YEARS)
        assert [tuple(r)[:2] for r in footers.footer_stats(spark, f"{folder}/{name}").collect()] == [("2023-01", rows)]


def test_stored_audit_is_built_once(data, monkeypatch):
    from tarmac.plans import data as module

    data.audit.count()
    monkeypatch.setattr(module, "rebuild_audit", lambda *_: pytest.fail("built again"))
    assert data.audit.count() > 0
