"""Merged sketches against the whole table and exact values."""

from pyspark.sql import functions as F

from tarmac.sources import statistics, tables
from tarmac.sources.statistics import COLUMNS, NUMBERS, QUANTILES, month_sketches, read_sketches, refresh_statistics, table_statistics


def told(df):
    return {r["column_name"]: r for r in table_statistics(df).collect()}


def test_merged_sketches_equal_the_whole_and_are_near_exact_values(spark, data, folder):
    refresh_statistics(spark, data.flights_path, f"{folder}/s")
    merged, whole = told(read_sketches(spark, f"{folder}/s")), told(month_sketches(data.flights.withColumn("flight_month", F.lit("all"))))
    assert set(merged) == set(COLUMNS) and read_sketches(spark, f"{folder}/s").count() == 12 * len(COLUMNS)
    total = data.flights.count()
    for c, row in merged.items():
        assert [row[x] for x in ("row_count", "null_count", "least", "greatest", "distinct_estimate")] == [
            whole[c][x] for x in ("row_count", "null_count", "least", "greatest", "distinct_estimate")]
        exact = data.flights.agg(F.count_distinct(c), F.count(c)).collect()[0]
        assert (row["row_count"], row["null_count"]) == (total, total - exact[1])
        assert abs(row["distinct_estimate"] - exact[0]) <= 0.05 * exact[0]  # three standard errors
    for c in NUMBERS:
        for q in QUANTILES:
            found = merged[c][f"q{round(100 * q)}"]
            below, upto, n = data.flights.agg(F.count_if(F.col(c) < found), F.count_if(F.col(c) <= found), F.count(c)).collect()[0]
            assert below / n - 0.03 <= q <= upto / n + 0.03


def test_a_month_is_sketched_anew(spark, flights_of, folder):
    path, root = f"{folder}/t", f"{folder}/s"
    tables.write_flights(flights_of(*[{"flight_date": f"2023-0{m}-05", "arr_delay_min": m} for m in (1, 2, 2)]), path, (2023,))
    refresh_statistics(spark, path, root)
    assert told(read_sketches(spark, root))["arr_delay_min"]["greatest"] == 2
    tables.replace_month(flights_of({"flight_date": "2023-02-06", "arr_delay_min": 70}), path, "2023_02.csv", (2023,), ("id",))
    refresh_statistics(spark, path, root, ["2023-02"])
    row = told(read_sketches(spark, root))["arr_delay_min"]
    assert (row["row_count"], row["least"], row["greatest"], row["distinct_estimate"]) == (2, 1, 70, 2)
    tables.replace_month(flights_of({}).limit(0), path, "2023_02.csv", (2023,), ("id",))
    refresh_statistics(spark, path, root, ["2023-02"])
    assert told(read_sketches(spark, root))["arr_delay_min"]["row_count"] == 1
    empty = told(read_sketches(spark, root))["carrier_delay"]
    assert (empty["null_count"], empty["least"], empty["distinct_estimate"], empty["q50"]) == (1, None, 0, None)
