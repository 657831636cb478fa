"""Each stream against the batch operator on the same rows."""

from pyspark.sql import functions as F

from tarmac.operators import views
from tarmac.operators.audit import delay_audit
from tarmac.sources import tables
from tarmac.streaming import jobs
from tests.conftest import rows

YEARS = (2023,)


def test_audit_stream_in_many_batches_equals_batch(spark, data, folder):
    stream = jobs.flight_stream(spark, data.flights_path, files_per_batch=1)
    query = jobs.stream_delay_audit(stream, f"{folder}/audit", f"{folder}/check")
    query.awaitTermination()
    assert len(query.recentProgress) >= 12
    got = tables.read_audit(spark, f"{folder}/audit")
    assert sorted(rows(got)) == sorted(rows(delay_audit(data.flights, "flight_month")))
    replayed = jobs.stream_delay_audit(jobs.flight_stream(spark, data.flights_path), f"{folder}/audit", f"{folder}/other")
    replayed.awaitTermination()
    again = jobs.stream_delay_audit(jobs.flight_stream(spark, data.flights_path), f"{folder}/audit", f"{folder}/check")
    again.awaitTermination()  # nothing new since the checkpoint
    assert tables.read_audit(spark, f"{folder}/audit").count() == delay_audit(data.flights).count()


def test_insert_stream_ignores_repeats_however_late(spark, flights_of, folder):
    tables.write_flights(flights_of({}, {"dep_time": None}, {"flight_date": "2023-06-01"}), f"{folder}/in", YEARS)
    run = lambda: jobs.stream_insert_flights(
        jobs.flight_stream(spark, f"{folder}/in", files_per_batch=1), f"{folder}/t", f"{folder}/check", YEARS
    ).awaitTermination()
    run()
    tables.write_flights(flights_of({}, {"dep_time": None}, {"dep_time": "23:00:00"}), f"{folder}/in", YEARS)
    run()
    assert tables.read_flights(spark, f"{folder}/t").count() == 4


def test_refresh_stream_follows_the_table(spark, data, folder):
    table, measures = f"{folder}/t", f"{folder}/m"
    half = data.flights.filter(F.col("id") % 2 == 0).drop("flight_month")
    tables.write_flights(half, table, YEARS)

    def refresh(checkpoint="check"):
        jobs.stream_refresh(
            jobs.flight_stream(spark, table, files_per_batch=4), measures, f"{folder}/{checkpoint}"
        ).awaitTermination()

    def check():
        flights = tables.read_flights(spark, table)
        direct = {
            "airline_summary": views.airline_summary(flights, data.airlines),
            "delay_heatmap": views.delay_heatmap(flights),
            "top_routes": views.top_routes(flights, data.airports),
            "monthly_trend": views.monthly_trend(flights, data.airlines),
            "route_performance": views.route_performance(flights, data.airlines),
        }
        for name, live in jobs.live_summaries(spark, measures, data.airlines, data.airports).items():
            assert sorted(rows(live), key=repr) == sorted(rows(direct[name]), key=repr), name

    refresh()
    refresh("replayed")  # all batches again
    check()
    tables.write_flights(data.flights.filter(F.col("id") % 2 == 1).drop("flight_month"), table, YEARS)
    refresh()
    check()
    march = tables.read_flights(spark, table).filter("flight_month = '2023-03' AND distance_miles < 900").drop("flight_month")
    tables.replace_month(march, table, "2023_03.csv", YEARS, order=("id",))
    jobs.recompute_months(spark, table, measures, ["2023-03"])
    check()


def test_audit_stream_keeps_one_row_of_repeats_and_nulls_equal(spark, flights_of, folder):
    """Rows that repeat each other, with NULL in their keys, in one batch and in two."""
    flights = flights_of({"id": 1, "origin": None, "arr_delay_min": 20}, {"id": 1, "origin": None, "arr_delay_min": 20}, {"id": 2})
    for n in range(2):
        tables.write_flights(flights, f"{folder}/in", YEARS)
        stream = jobs.flight_stream(spark, f"{folder}/in", files_per_batch=1)
        jobs.stream_delay_audit(stream, f"{folder}/audit", f"{folder}/check{n}").awaitTermination()
    assert sorted(r["flight_id"] for r in tables.read_audit(spark, f"{folder}/audit").collect()) == [1, 2]


def test_first_inserted_batch_is_not_staged_and_later_ones_are(spark, flights_of, folder, monkeypatch):
    staged, publish = [], tables.publish
    monkeypatch.setattr(tables, "publish", lambda df, root, name: staged.append(name) or publish(df, root, name))
    for n, wanted in ((0, []), (1, ["batch"])):
        tables.write_flights(flights_of({"id": 9}, {"id": 3}, {"flight_number": str(n)}, {"dep_time": None}), f"{folder}/in{n}", YEARS)
        stream = jobs.flight_stream(spark, f"{folder}/in{n}")
        jobs.stream_insert_flights(stream, f"{folder}/t", f"{folder}/check{n}", YEARS).awaitTermination()
        assert staged == wanted
    stored = tables.read_flights(spark, f"{folder}/t")
    assert stored.count() == 3 and stored.filter("dep_time = '08:00:00' AND flight_number = '1'").first()["id"] == 3
