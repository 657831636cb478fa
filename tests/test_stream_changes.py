"""Insert by event time, and summaries under signed corrections."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tarmac.operators.ingest import insert_flights
from tarmac.plans.round_trips import tall
from tarmac.sources import tables
from tarmac.streaming import corrections, event_time, jobs

YEARS = (2023,)


def arrivals(flights_of, seed, batches, size):
    """Batches of flights whose dates move on, some of them weeks behind, many of them repeated."""
    rng, seen, out = random.Random(seed), [], []
    for n in range(batches):
        rows = []
        for i in range(size):
            if seen and rng.random() < 0.3:
                row = dict(rng.choice(seen))
            else:
                day = date(2023, 1, 10) + timedelta(days=12 * n - rng.choice([0, 1, 2, 3, 5, 8, 30, 60]))
                row = {"flight_date": str(max(day, date(2023, 1, 1))), "flight_number": str(rng.randint(1, 30)),
                       "dep_time": rng.choice([None, "07:00:00"])}
            row = {**row, "id": 10_000 * n + rng.randrange(10_000)}
            rows.append(row)
            seen.append(row)
        out.append(flights_of(*rows))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_accepted_and_late_rows_equal_the_exact_path(spark, flights_of, folder, seed):
    exact, states = None, []
    for n, batch in enumerate(arrivals(flights_of, seed, 7, 40)):
        batch.coalesce(2).withColumn("created_at", F.lit(None).cast("timestamp")).write.parquet(f"{folder}/in/n={n}")
        new = batch if exact is None else insert_flights(batch, exact, ("id",))
        exact = insert_flights(batch, spark.createDataFrame([], tables.FLIGHTS_SCHEMA), ("id",)) if exact is None else exact.unionByName(new)
        stream = jobs.flight_stream(spark, f"{folder}/in/*")
        query = event_time.stream_insert_recent(stream, f"{folder}/out", f"{folder}/check", YEARS, delay_days=15)
        query.awaitTermination()
        states.append(query.lastProgress.stateOperators[0].numRowsTotal)
    found = event_time.read_recent(spark, f"{folder}/out")
    told = sorted(map(str, found.select(*exact.columns).collect()))
    assert told == sorted(map(str, exact.collect()))
    late = found.filter("is_late")
    assert 0 < late.count() < found.count() / 2
    # the state holds the window's keys, not all of them
    assert states[-1] < found.count() / 2


def test_a_batch_that_comes_again_changes_nothing(spark, flights_of, folder):
    """The checkpoint is that of the batch before, as after a crash between writing and committing."""
    import shutil

    for n, batch in enumerate(arrivals(flights_of, 3, 4, 30)):
        batch.coalesce(1).withColumn("created_at", F.lit(None).cast("timestamp")).write.parquet(f"{folder}/in/n={n}")
        for again in range(2):
            shutil.copytree(f"{folder}/check", f"{folder}/before-{n}") if n and not again else None
            where = f"{folder}/check" if not again or not n else f"{folder}/before-{n}"
            stream = jobs.flight_stream(spark, f"{folder}/in/*")
            event_time.stream_insert_recent(stream, f"{folder}/out", where, YEARS, delay_days=15).awaitTermination()
            now = sorted(map(str, event_time.read_recent(spark, f"{folder}/out").drop("created_at").collect()))
            assert not again or now == before
            before = now
    keys = event_time.read_recent(spark, f"{folder}/out").select(*event_time.BUSINESS_KEY)
    assert keys.count() == keys.distinct().count()


def test_the_state_is_on_disk_and_holds_a_window(spark, flights_of, folder):
    for n, batch in enumerate(arrivals(flights_of, 4, 5, 40)):
        batch.coalesce(1).withColumn("created_at", F.lit(None).cast("timestamp")).write.parquet(f"{folder}/in/n={n}")
        stream = jobs.flight_stream(spark, f"{folder}/in/*")
        query = event_time.stream_insert_recent(stream, f"{folder}/out", f"{folder}/check", YEARS, delay_days=15)
        query.awaitTermination()
    assert any(name.startswith("rocksdb") for name in query.lastProgress.stateOperators[0].customMetrics)
    stored = event_time.read_recent(spark, f"{folder}/out")
    kept = spark.read.format("statestore").load(f"{folder}/check").select("key.*")
    latest = stored.agg(F.max("flight_date")).collect()[0][0]
    inside = stored.filter(F.col("flight_date") > latest - timedelta(days=15)).select(*kept.columns)
    assert {str(r) for r in inside.collect()} <= {str(r) for r in kept.collect()}
    # a key goes when the watermark has passed its date by as many days again
    assert kept.filter(F.col("flight_date") <= latest - timedelta(days=30)).count() == 0
    assert 0 < kept.count() < stored.count() / 2
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_batches_without_rows_end_after_their_state(spark, flights_of, folder, monkeypatch):
    written, write = [], event_time._write
    monkeypatch.setattr(event_time, "_write", lambda rows, path, years, n: written.append(n) or write(rows, path, years, n))
    flown = flights_of({"flight_date": "2023-01-10"}, {"flight_date": None}, {"flight_date": "2023-03-10"})
    for part in (flown.filter("flight_date < '2023-02-01'"), flown.filter("flight_date IS NULL"), flown):
        n = len(written)
        part.coalesce(1).withColumn("created_at", F.lit(None).cast("timestamp")).write.parquet(f"{folder}/in/n={n}")
        query = event_time.stream_insert_recent(
            jobs.flight_stream(spark, f"{folder}/in/*"), f"{folder}/out", f"{folder}/check", YEARS, delay_days=15)
        query.awaitTermination()
        done = {p.batchId: p.numInputRows for p in query.recentProgress}
        assert [k for k, rows in done.items() if rows == 0] == [] or max(done) not in written
        assert min(done) in written
    stored = event_time.read_recent(spark, f"{folder}/out").select("flight_date", "is_late").collect()
    assert sorted(map(str, map(tuple, stored))) == sorted(map(str, [
        (date(2023, 1, 10), False), (None, True), (date(2023, 3, 10), False)]))


def test_late_rows_are_not_grouped_with_new_keys(spark, flights_of, folder, monkeypatch):
    """What the watermark has passed has no key in the state, so no part of it is sorted for the accepted rows."""
    read, write = [], event_time._write
    monkeypatch.setattr(event_time, "_write", lambda rows, path, years, n: read.append(
        (path, rows._jdf.queryExecution().optimizedPlan().toString())) or write(rows, path, years, n))
    for n, day in enumerate(("2023-06-01", "2023-01-01")):
        flights_of({"flight_date": day}).withColumn("created_at", F.lit(None).cast("timestamp")).write.parquet(f"{folder}/in/n={n}")
        event_time.stream_insert_recent(
            jobs.flight_stream(spark, f"{folder}/in/*"), f"{folder}/out", f"{folder}/check", YEARS).awaitTermination()
    accepted = [plan for path, plan in read if path.endswith("/flights")]
    assert len(accepted) == 2
    assert [line for line in accepted[1].splitlines() if "Filter" in line and "flight_date" in line and "> 2023-05-01" in line], accepted[1]
    late = event_time.read_recent(spark, f"{folder}/out").filter("is_late").select("flight_date").collect()
    assert [r[0] for r in late] == [date(2023, 1, 1)]


def test_random_corrections_give_the_batch_summaries(spark, data, folder):
    """Inserts, replacements, deletions and a batch that comes again, against summaries of what is left."""
    rng = random.Random(4)
    left = data.flights.drop("created_at").filter("flight_month < '2023-06'")
    changes = [corrections.entering(left)]
    for n in range(3):
        month = f"2023-{rng.randint(1, 5):02d}"
        tables.publish(left, folder, f"left{n}")
        left = tables.read_current(spark, folder, f"left{n}")
        gone = left.filter(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(7)) == 0)
        changed = left.filter(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(7)) == 1)
        moved = changed.withColumns({"arr_delay_min": F.col("arr_delay_min") + 11, "cancelled": F.lit(False)})
        whole = left.filter(F.col("flight_month") == month)
        fewer = whole.filter(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(7)) > 3)
        changes.append(corrections.leaving(gone).unionByName(corrections.leaving(changed)).unionByName(corrections.entering(moved)))
        left = left.join(gone.unionByName(changed).select("id"), "id", "left_anti").unionByName(moved)
        tables.publish(left, folder, f"mid{n}")
        left = tables.read_current(spark, folder, f"mid{n}")
        changes.append(corrections.month_replacement(fewer.join(left.select("id"), "id", "left_semi"), left, month))
        left = left.filter(F.col("flight_month") != month).unionByName(fewer.join(left.select("id"), "id", "left_semi"))
    for n, part in enumerate(changes):
        part.withColumn("created_at", F.lit(None).cast("timestamp")).coalesce(1).write.parquet(f"{folder}/changes/n={n}")
    for where in ("check", "check-again"):  # the second stream takes all batches once more
        stream = spark.readStream.schema(corrections.CHANGES_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/changes/*")
        corrections.stream_corrections(stream, f"{folder}/sums", f"{folder}/{where}").awaitTermination()
    live = corrections.corrected_summaries(spark, f"{folder}/sums", data.airlines, data.airports)
    tables.refresh_summaries(left, data.airlines, data.airports, f"{folder}/batch")
    for name in tables.SUMMARIES:
        exact = tables.read_summary(spark, f"{folder}/batch", name)
        assert sorted(map(str, tall({name: live[name]}).collect())) == sorted(map(str, tall({name: exact}).collect())), name
    assert tall(live).count() > 100


def test_a_correction_takes_the_stored_row_of_its_key_back(flights_of):
    stored = flights_of({"id": 1, "dep_time": None, "arr_delay_min": 5}, {"id": 2, "flight_number": "9"})
    new = flights_of({"id": 3, "dep_time": None, "arr_delay_min": 50}, {"id": 4, "flight_number": "8"})
    found = sorted((r["sign"], r["id"]) for r in corrections.corrections(new, stored).collect())
    assert found == [(-1, 1), (1, 3), (1, 4)]
