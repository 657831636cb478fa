"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import MONTH, date_range
from tarmac.functions.measures import CAUSES, COMPLETED, LATE, SEVERE
from tarmac.functions.numeric import decimals_to_double, pct

BUSINESS_KEY = (
    "flight_date", "airline_code", "flight_number", "origin", "destination", "dep_time",
)
EARLIEST_DELAY = -120
TOP_DUPLICATES = 50

_NO_CAUSE = " AND ".join(f"{cause}_delay IS NULL" for cause in CAUSES)
QUALITY_CHECKS = {
    "null_dep_time": "dep_time IS NULL",
    "null_arr_time": "arr_time IS NULL",
    "cancelled_rows": "cancelled",
    "negative_distance": "distance_miles <= 0",
    "missing_delay_breakdown_on_delayed": f"{COMPLETED} AND {LATE} AND {_NO_CAUSE}",
}


def data_quality_summary(flights: DataFrame, start: str, end: str) -> DataFrame:
    """Six counts with their share of all rows, from one pass over the flights."""
    names = ("total_rows", *QUALITY_CHECKS)
    totals = date_range(flights, start, end).agg(
        F.expr("count(1) AS total_rows"),
        *[F.expr(f"count_if({cond}) AS {name}") for name, cond in QUALITY_CHECKS.items()],
    )
    per_metric = ", ".join(f"'{name}', {name}" for name in names)
    report = totals.selectExpr(
        "total_rows", f"stack({len(names)}, {per_metric}) AS (metric_name, metric_value)"
    ).selectExpr(
        "metric_name",
        "metric_value",
        f"{pct('metric_value', 'total_rows', 3)} AS metric_percent",
    )
    return decimals_to_double(report).orderBy(
        F.expr("metric_name <> 'total_rows'"), F.desc("metric_value"), "metric_name"
    )


def invalid_airport_references(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Codes used by flights that no airport has, per column, NULL included.

    Both columns are counted in one pass; the airport table meets only distinct codes.
    """
    counts = (
        flights.selectExpr(
            "stack(2, 'origin', origin, 'destination', destination) AS (source_col, iata_code)"
        )
        .groupBy("source_col", "iata_code")
        .agg(F.expr("count(1) AS affected_rows"))
    )
    known = airports.selectExpr("iata_code", "TRUE AS _known")
    # A left join with a test for NULL: an anti join would be moved below the count,
    # where it meets every flight instead of every code.
    return (
        counts.join(known, "iata_code", "left")
        .filter("_known IS NULL")
        .select("source_col", "iata_code", "affected_rows")
        .orderBy(F.desc("affected_rows"), "source_col", F.expr("iata_code").asc_nulls_last())
    )


def out_of_range(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.expr(f"count_if(dep_delay_min < {EARLIEST_DELAY}) AS bad_dep_delay_rows"),
        F.expr(f"count_if(arr_delay_min < {EARLIEST_DELAY}) AS bad_arr_delay_rows"),
        F.expr("count_if(distance_miles <= 0) AS bad_distance_rows"),
    )


def duplicate_keys(flights: DataFrame, top: int | None = TOP_DUPLICATES) -> DataFrame:
    """Business keys on more than one row, NULLs being equal; the most repeated first, or all (None)."""
    repeated = (
        flights.groupBy(*BUSINESS_KEY)
        .agg(F.expr("count(1) AS cnt"))
        .filter("cnt > 1")
        .orderBy(F.desc("cnt"), *[F.expr(k).asc_nulls_last() for k in BUSINESS_KEY])
    )
    return repeated if top is None else repeated.limit(top)


def month_distribution(flights: DataFrame) -> DataFrame:
    return flights.groupBy(F.expr(MONTH)).agg(F.expr("count(1) AS row_count")).orderBy("month")


def audit_coverage(flights: DataFrame, audit: DataFrame) -> DataFrame:
    """Severely late flights against severe audit rows; both sides are one-row totals."""
    severe = flights.agg(F.expr(f"count_if({SEVERE}) AS severe_flights"))
    logged = audit.agg(F.expr("count_if(delay_category = 'severe') AS severe_logged"))
    both = severe.unionByName(logged, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("severe_flights", "severe_logged")])
