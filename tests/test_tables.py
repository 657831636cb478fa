"""Tables on disk: partitions, versions, loads and refreshes."""

import datetime
from pathlib import Path

import pytest

from tarmac.operators import ingest, views
from tarmac.operators.audit import delay_audit
from tarmac.sources import csv, load, tables
from tests.conftest import rows

YEARS = (2023,)


def stored(spark, path):
    return tables.read_flights(spark, path)


def by_month(spark, path):
    return dict(rows(stored(spark, path).groupBy("flight_month").count()))


def test_rows_go_to_their_month_or_to_default(spark, flights_of, folder):
    flights = flights_of(*[{"flight_date": d} for d in ("2023-01-31", "2023-02-01", "2024-01-01", "1999-01-01")])
    tables.write_flights(flights, f"{folder}/t", YEARS)
    assert by_month(spark, f"{folder}/t") == {"2023-01": 1, "2023-02": 1, "default": 2}
    assert stored(spark, f"{folder}/t").schema["flight_month"].dataType.typeName() == "string"


@pytest.mark.parametrize("year", [1999, 2101])
def test_years_outside_the_range_are_refused(flights_of, folder, year):
    with pytest.raises(ValueError, match="invalid year"):
        tables.write_flights(flights_of({}), f"{folder}/t", [2023, year])


def test_appending_again_adds_nothing(spark, flights_of, folder):
    flights = flights_of({}, {"dep_time": None}, {"dep_time": None}, {"flight_date": "2023-05-01"})
    for _ in range(2):
        tables.append_new_flights(flights, f"{folder}/t", YEARS, order=("id",))
    assert stored(spark, f"{folder}/t").count() == 3


def test_replace_month(spark, flights_of, folder):
    path, audit = f"{folder}/t", f"{folder}/audit"
    tables.write_flights(flights_of({}, {"flight_number": "2"}, {"flight_date": "2023-02-01"}), path, YEARS)
    tables.rebuild_audit(spark, path, audit, ["2023-01", "2023-02"])
    new = flights_of({"flight_number": "3", "arr_delay_min": 90}, {"flight_date": "2023-02-01"}, {"flight_date": "2023-02-02"})
    tables.replace_month(new, path, "2023_01.csv", YEARS, order=("id",), audit_path=audit)
    assert by_month(spark, path) == {"2023-01": 1, "2023-02": 2}
    got = tables.read_audit(spark, audit)
    assert sorted(rows(got.groupBy("flight_month", "delay_category").count())) == [("2023-01", "severe", 1), ("2023-02", "on_time", 2)]


def test_a_month_can_be_replaced_from_the_table_itself(spark, flights_of, folder):
    path = f"{folder}/t"
    tables.write_flights(flights_of({}, {"flight_number": "2"}, {"flight_date": "2023-02-01"}), path, YEARS)
    own = stored(spark, path).filter("flight_number = '2'")
    tables.replace_month(own, path, "2023_01.csv", YEARS, order=("id",))
    assert by_month(spark, path) == {"2023-01": 1, "2023-02": 1}


def test_replace_month_leaves_out_rows_that_break_a_constraint(spark, flights_of, folder, data):
    path = f"{folder}/t"
    new = flights_of({}, {"flight_number": "2", "distance_miles": -5}, {"flight_number": "3", "origin": "QQQ"})
    tables.replace_month(new, path, "2023_01.csv", YEARS, ("id",), None, data.airlines, data.airports)
    assert by_month(spark, path) == {"2023-01": 1}


def test_a_reload_replaces_the_months_of_its_files(spark, data, folder):
    for name, origin in (("2023_01.csv", "JFK"), ("2023_02.csv", "BOS")):
        write(f"{folder}/csv", name, HEADER, line(HEADER, ORIGIN=origin), line(HEADER, ORIGIN=origin, FL_DATE="2023-02-03"))
    paths = csv.flight_files(spark, f"{folder}/csv")
    tables.write_flights(data.plain_flights.filter("month(flight_date) <= 3"), f"{folder}/flights", YEARS)
    before = by_month(spark, f"{folder}/flights")
    report = load.load_flight_files(spark, paths, folder, data.airlines, data.airports, YEARS, replace=True)
    assert sorted(tuple(r)[:3] for r in report.collect()) == [("2023_01.csv", 2, 2), ("2023_02.csv", 2, 2)]
    assert by_month(spark, f"{folder}/flights") == {"2023-01": 2, "2023-02": 2, "2023-03": before["2023-03"]}


def test_old_versions_are_removed(spark, folder):
    for n in range(5):
        tables.publish(spark.range(n + 1), folder, "t")
    (Path(folder) / "t" / "v00_unfinished").mkdir()
    tables.prune(spark, folder, "t", keep=2)
    assert len(list((Path(folder) / "t").iterdir())) == 2
    assert tables.read_current(spark, folder, "t").count() == 5


def test_replace_month_by_an_empty_file_clears_it(spark, flights_of, folder):
    path = f"{folder}/t"
    tables.write_flights(flights_of({}, {"flight_date": "2023-02-01"}), path, YEARS)
    tables.replace_month(flights_of({}).limit(0), path, "2023_01.csv", YEARS, order=("id",))
    assert by_month(spark, path) == {"2023-02": 1}


def test_replace_month_takes_rows_straight_from_ingest(spark, folder):
    write(f"{folder}/csv", "2023_01.csv", HEADER, line(HEADER), line(HEADER), line(HEADER, ORIGIN="BOS"))
    path, audit = f"{folder}/t", f"{folder}/audit"
    raw = csv.read_flights_csv(spark, csv.flight_files(spark, f"{folder}/csv"))
    for _ in range(2):
        tables.replace_month(ingest.ingest_flights(raw), path, "2023_01.csv", YEARS, audit_path=audit)
    got = stored(spark, path)
    assert sorted(rows(got.select("origin"))) == [("BOS",), ("JFK",)]
    assert tables.read_audit(spark, audit).count() == 2
    assert got.filter("id IS NULL OR created_at IS NULL").count() == 0


@pytest.mark.parametrize("name", ["flights.csv", "2023_13.csv", "2023_01_02.csv", "x_01.csv"])
def test_replace_month_refuses_unclear_names(flights_of, folder, name):
    with pytest.raises(ValueError, match="no month"):
        tables.replace_month(flights_of({}), f"{folder}/t", name, YEARS)


def test_partition_stats_are_exact(spark, data):
    stats = {r.partition_name: r for r in tables.partition_stats(spark, data.flights_path, (2022, 2023)).collect()}
    months = [f"flights_{y}_{m:02d}" for y in (2022, 2023) for m in range(1, 13)]
    assert sorted(stats) == [*months, "flights_default"]
    assert stats["flights_2022_05"].row_count == stats["flights_default"].total_bytes == 0
    assert sum(r.row_count for r in stats.values()) == data.flights.count()
    size = sum(p.stat().st_size for p in Path(data.flights_path.removeprefix("file:")).glob("flight_month=2023-03/*.parquet"))
    assert stats["flights_2023_03"].total_bytes == size


def test_partition_for_date(spark):
    days = spark.createDataFrame([(datetime.date(2023, 3, 1),), (datetime.date(2024, 3, 1),), (None,)], "flight_date date")
    got = [r.partition_name for r in tables.partition_for_date(days, YEARS).collect()]
    assert got == ["flights_2023_03", "flights_default (no partition has been created for flights_2024_03)", None]


def test_versions_become_current_when_committed(spark, folder):
    tables.publish(spark.range(1), folder, "t")
    tables.publish(spark.range(2), folder, "t")
    assert tables.read_current(spark, folder, "t").count() == 2
    (Path(folder) / "t" / "v9_unfinished").mkdir()  # a job that never committed
    assert tables.read_current(spark, folder, "t").count() == 2
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, folder, "other")


def test_upsert_table_can_read_what_it_replaces(spark, folder):
    schema = "iata_code string, name string"
    for batch in ([("A", "1")], [("A", "2"), ("B", "1")]):
        tables.upsert_table(spark.createDataFrame(batch, schema), folder, "airports")
    assert sorted(rows(tables.read_current(spark, folder, "airports"))) == [("A", "2"), ("B", "1")]


def test_refresh_equals_direct_summaries(spark, data, folder):
    tables.refresh_summaries(data.flights, data.airlines, data.airports, folder)
    direct = {
        "airline_summary": views.airline_summary(data.flights, data.airlines),
        "delay_heatmap": views.delay_heatmap(data.flights),
        "top_routes": views.top_routes(data.flights, data.airports),
        "monthly_trend": views.monthly_trend(data.flights, data.airlines),
        "route_performance": views.route_performance(data.flights, data.airlines),
    }
    for name, df in direct.items():
        got = tables.read_summary(spark, folder, name)
        assert got.dtypes == df.dtypes == tables.read_current(spark, folder, name).dtypes
        assert sorted(rows(got), key=repr) == sorted(rows(df), key=repr)
    counts = dict(rows(tables.summary_counts(spark, folder)))
    assert counts == {name: df.count() for name, df in direct.items()}


def test_refresh_gathers_statistics_of_catalog_tables(spark, data, folder):
    name = f"stats_{Path(folder).name.replace('-', '_')}"
    data.airlines.write.option("path", f"{folder}/cat").saveAsTable(name)
    tables.refresh_summaries(data.flights, data.airlines, data.airports, folder, analyze=[name])
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert "9 rows" in described["Statistics"]
    spark.sql(f"DROP TABLE {name}")


HEADER = list(ingest.RAW_FLIGHT_COLUMNS)


def line(columns, **values):
    base = dict(zip(HEADER, ["2023-01-05", "AA", "1", "JFK", "LAX", "830", "5.00", "1130", "7.00", "0.00", "0.00", "2475", "", "", "", "", ""]))
    return ",".join({**base, **values}.get(c, "x") for c in columns)


def write(folder, name, columns, *lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text("\n".join([",".join(columns), *lines]) + "\n")


def test_files_with_other_headers_are_read_by_name(spark, folder):
    shuffled = ["EXTRA", *HEADER[::-1]]
    write(folder, "2023_01.csv", [*HEADER, ""], line(HEADER, ORIGIN="BOS") + ",", line(HEADER, ORIGIN="NA") + ",")
    write(folder, "2023_02.csv", [f" {c} " for c in shuffled], line(shuffled, ORIGIN='"SEA"'))
    write(folder, "2022_01.csv", HEADER[1:], line(HEADER[1:]))
    paths = csv.flight_files(spark, folder)
    assert [p.rsplit("/", 1)[1] for p in csv.split_by_columns(spark, paths)[1]] == ["2022_01.csv"]
    raw = csv.read_flights_csv(spark, paths)
    assert sorted(rows(raw.select("source_file", "ORIGIN")), key=repr) == [
        ("2023_01.csv", "BOS"), ("2023_01.csv", None), ("2023_02.csv", "SEA"),
    ]
    assert len(csv.flight_files(spark, folder, year=2022)) == 1
    assert len(csv.flight_files(spark, folder, file=f"{folder}/2023_02.csv")) == 1
    with pytest.raises(FileNotFoundError):
        csv.flight_files(spark, folder, year=1999)


def test_airport_listing(spark, folder):
    write(folder, "a.csv", [" IATA_CODE", "Name ", "type"], 'JFK,"Kennedy, ""New""\nYork",large_airport', "NA,n/a,x")
    got = csv.read_airports_csv(spark, f"{folder}/a.csv")
    assert got.columns == ["iata_code", "name", "type"]
    assert rows(got) == [("JFK", 'Kennedy, "New"\nYork', "large_airport"), (None, None, "x")]


def test_load_is_repeatable(spark, folder):
    write(f"{folder}/csv", "2023_01.csv", HEADER, line(HEADER), line(HEADER, DISTANCE="1"), line(HEADER, FL_DATE="junk"), line(HEADER, DEST="QQQ"))
    write(f"{folder}/csv", "2023_02.csv", HEADER, line(HEADER, FL_DATE="2/5/2023", ARR_DELAY="99"))
    write(f"{folder}/csv", "bad.csv", HEADER[:-1], line(HEADER[:-1]))
    airlines = spark.createDataFrame([("AA",)], "iata_code string")
    airports = spark.createDataFrame([("JFK",), ("LAX",)], "iata_code string")
    args = (spark, csv.flight_files(spark, f"{folder}/csv"), folder, airlines, airports, YEARS)
    assert sorted(rows(load.load_flight_files(*args))) == [
        ("2023_01.csv", 4, 1, 1, 1), ("2023_02.csv", 1, 1, 0, 0), ("bad.csv", 0, 0, 0, 1),
    ]
    flights = stored(spark, f"{folder}/flights")
    assert sorted(rows(flights.select("flight_month", "distance_miles"))) == [("2023-01", 2475), ("2023-02", 2475)]
    audit = lambda: sorted(rows(tables.read_audit(spark, f"{folder}/audit")))
    first = audit()
    assert [r[6] for r in first] and len(first) == 2
    assert sorted(r[2] for r in rows(load.load_flight_files(*args))) == [0, 0, 0]
    assert stored(spark, f"{folder}/flights").count() == 2
    assert audit() == first
    expected = delay_audit(stored(spark, f"{folder}/flights"), "flight_month")
    assert sorted(rows(expected)) == first


def test_the_whole_load_in_one_call(spark, folder):
    listing = ["iata_code", "type", "name", "municipality", "iso_country", "latitude_deg", "longitude_deg", "elevation_ft", "tzid"]
    write(folder, "airports.csv", listing, *[f"{c},large_airport,{c} field,x,US,40.5,-73.5,10,z" for c in ("JFK", "LAX")])
    write(f"{folder}/csv", "2023_01.csv", HEADER, line(HEADER), line(HEADER, DEST="QQQ"))
    write(f"{folder}/csv", "2023_02.csv", [csv.CARRIER], "ZZ")
    (Path(folder) / "csv" / "2023_03.csv").mkdir()  # cannot be opened as a file
    paths = csv.flight_files(spark, f"{folder}/csv")
    for _ in range(2):
        summary = load.load_all(spark, f"{folder}/airports.csv", paths, f"{folder}/lake", YEARS)
    assert sorted(rows(summary), key=repr) == [
        ("airlines", None, 2), ("airports", None, 2), ("delay_audit_log", None, 1), ("flights", "2023-01", 1), ("flights", None, 1),
    ]
    report = tables.read_current(spark, f"{folder}/lake", "load_report")
    assert sorted(rows(report)) == [("2023_01.csv", 2, 0, 0, 1), ("2023_02.csv", 0, 0, 0, 1), ("2023_03.csv", 0, 0, 0, 1)]
    assert len(tables.SUMMARIES) == tables.summary_counts(spark, f"{folder}/lake").count()
