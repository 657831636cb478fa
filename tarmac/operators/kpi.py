"""Parameterised KPI reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import measures as m
from tarmac.functions.dates import date_range
from tarmac.functions.numeric import decimals_to_double, mean, pct, rounded

MIN_RANKED_FLIGHTS = 100
MIN_COMPARED_FLIGHTS = 10


def with_airline_name(df: DataFrame, airlines: DataFrame) -> DataFrame:
    """Add `airline_name`, `Unknown` where the code has no airline row.

    Meant for aggregated rows: the name depends on the code alone, so joining after
    the aggregation gives the same groups with one row per key to join.
    """
    names = airlines.selectExpr("iata_code AS airline_code", "name AS _name")
    named = df.join(names, "airline_code", "left")
    return named.selectExpr(
        *[f"`{c}`" for c in df.columns], "coalesce(_name, 'Unknown') AS airline_name"
    )


def airline_score(flights: DataFrame, code: str, start: str, end: str) -> DataFrame:
    """One row of KPIs and the weighted score of one airline."""
    picked = date_range(flights, start, end).filter(F.col("airline_code") == code)
    totals = m.measures(picked, []).withColumn("airline_code", F.lit(code))
    return decimals_to_double(
        totals.selectExpr(
            "airline_code",
            "total_flights",
            "completed_flights",
            "on_time_flights",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay_min",
            f"{m.AVG_DEP_DELAY} AS avg_dep_delay_min",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
            f"{m.SEVERE_DELAY_PCT} AS severe_delay_pct",
            f"{m.EXACT_PERFORMANCE} AS performance_score",
        )
    )


def airline_ranking(
    flights: DataFrame, airlines: DataFrame, start: str, end: str
) -> DataFrame:
    """Airlines with enough flights, ranked by the score of their rounded KPIs.

    The rank compares exact decimals, so equal scores share a rank. Its window has
    no partition but runs over one row per airline code.
    """
    stats = (
        m.measures(date_range(flights, start, end), ["airline_code"])
        .filter(f"total_flights >= {MIN_RANKED_FLIGHTS}")
        .selectExpr(
            "airline_code",
            "total_flights",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay_min",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
        )
    )
    score = m.performance("on_time_pct", "avg_arr_delay_min", "cancellation_rate")
    ranked = with_airline_name(stats.selectExpr("*", f"{score} AS _score"), airlines).selectExpr(
        "rank() OVER (ORDER BY _score DESC NULLS FIRST) AS rank_position",
        "airline_code",
        "airline_name",
        "total_flights",
        "on_time_pct",
        "avg_arr_delay_min",
        "cancellation_rate",
        f"{rounded('_score')} AS performance_score",
    )
    return decimals_to_double(ranked).orderBy(
        "rank_position", F.expr("airline_code").asc_nulls_last()
    )


# Report labels of the delay causes.
CAUSE_LABELS = {
    "carrier": "Carrier",
    "weather": "Weather",
    "nas": "NAS",
    "security": "Security",
    "late_aircraft": "Late Aircraft",
}


def delay_breakdown(flights: DataFrame, code: str, start: str, end: str) -> DataFrame:
    """Minutes, mean, count and share per delay cause of one airline.

    Shares are of the minutes on late arrivals, whereas a cause counts wherever it is
    positive, so they need not add up to 100. One scan collects all causes; the single
    total row is then turned into one row per cause that occurs.
    """
    picked = date_range(flights, start, end).filter(
        (F.col("airline_code") == code) & F.expr(m.COMPLETED)
    )
    all_causes = " + ".join(f"coalesce({c}_delay, 0)" for c in CAUSE_LABELS)
    aggs = [F.expr(f"sum(CASE WHEN arr_delay_min > 0 THEN {all_causes} END) AS late_minutes")]
    for c in CAUSE_LABELS:
        positive = f"CASE WHEN {c}_delay > 0 THEN {c}_delay END"
        aggs += [F.expr(f"sum({positive}) AS {c}_sum"), F.expr(f"count({positive}) AS {c}_n")]
    per_cause = ", ".join(f"'{label}', {c}_sum, {c}_n" for c, label in CAUSE_LABELS.items())
    report = (
        picked.agg(*aggs)
        .selectExpr(
            "late_minutes",
            f"stack({len(CAUSE_LABELS)}, {per_cause}) AS (delay_cause, total_minutes, flight_count)",
        )
        .filter("flight_count > 0")
        .selectExpr(
            "delay_cause",
            "total_minutes",
            f"{mean('total_minutes', 'flight_count')} AS avg_minutes",
            "flight_count",
            f"{pct('total_minutes', 'late_minutes')} AS pct_of_total_delay",
        )
    )
    return decimals_to_double(report).orderBy(F.desc("total_minutes"), "delay_cause")


def _on_route(flights: DataFrame, origin: str, destination: str, start: str, end: str) -> DataFrame:
    return date_range(flights, start, end).filter(
        (F.col("origin") == origin) & (F.col("destination") == destination)
    )


def best_routes_between(
    flights: DataFrame,
    airlines: DataFrame,
    origin: str,
    destination: str,
    start: str,
    end: str,
) -> DataFrame:
    """Airlines flying one route, the most punctual first, then the least delayed."""
    stats = m.measures(
        _on_route(flights, origin, destination, start, end), ["airline_code"]
    ).filter(f"total_flights >= {MIN_COMPARED_FLIGHTS}")
    report = (
        with_airline_name(stats, airlines)
        .orderBy(
            F.expr("on_time_flights / nullif(completed_flights, 0)").desc_nulls_last(),
            F.expr("arr_sum / nullif(arr_n, 0)").asc_nulls_last(),
            F.expr("airline_code").asc_nulls_last(),
        )
        .selectExpr(
            "airline_code",
            "airline_name",
            "total_flights",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay_min",
            f"{m.AVG_DISTANCE} AS avg_distance_miles",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
        )
    )
    return decimals_to_double(report)


def route_kpi(
    flights: DataFrame, origin: str, destination: str, start: str, end: str
) -> DataFrame:
    """One row of KPIs of a route; counts are zero and rates NULL when it has no flights."""
    picked = _on_route(flights, origin, destination, start, end)
    return decimals_to_double(
        m.measures(picked, []).selectExpr(
            "total_flights",
            "coalesce(completed_flights, 0) AS completed_flights",
            "coalesce(cancelled_flights, 0) AS cancelled_flights",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay_min",
        )
    )
