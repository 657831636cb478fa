"""Saved queries: report heads, slices and display bands on top of views and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import measures as m
from tarmac.functions.dates import MONTH, date_range
from tarmac.functions.numeric import decimals_to_double
from tarmac.operators.views import head, with_route_ends

DEFAULT_ROUTES = 20
MIN_LIVE_ROUTE_FLIGHTS = 20
ON_TIME_TARGET = 80
CANCELLATION_TARGET = 3


_ROUTE_COLUMNS = (
    "origin", "destination", "origin_city", "dest_city", "origin_lat", "origin_lon",
    "dest_lat", "dest_lon", "total_flights", "avg_arr_delay",
)


def _most_flown(routes: DataFrame, limit: int | None) -> DataFrame:
    return head(routes.orderBy(F.desc("total_flights"), "origin", "destination"), limit)


def top_routes(summary: DataFrame, limit: int | None = DEFAULT_ROUTES) -> DataFrame:
    """The head of the route summary table; None for all of it."""
    return _most_flown(summary, limit).select(*_ROUTE_COLUMNS)


def top_routes_live(
    flights: DataFrame, airports: DataFrame, limit: int | None = DEFAULT_ROUTES
) -> DataFrame:
    """The same report straight from the flights, with a lower volume limit."""
    routes = m.measures(flights, ["origin", "destination"]).filter(
        f"total_flights >= {MIN_LIVE_ROUTE_FLIGHTS}"
    )
    named = with_route_ends(routes, airports).selectExpr(
        "origin",
        "destination",
        "coalesce(origin_city, origin_name) AS origin_city",
        "coalesce(dest_city, dest_name) AS dest_city",
        *_ROUTE_COLUMNS[4:-1],
        f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
    )
    return decimals_to_double(_most_flown(named, limit))


def ranking_head(ranking: DataFrame, top: int | None = 20) -> DataFrame:
    return head(ranking.orderBy("rank_position", F.expr("airline_code").asc_nulls_last()), top)


def trend_for(trend: DataFrame, airline: str) -> DataFrame:
    """One airline's months, labelled `YYYY-MM`."""
    return (
        trend.filter(F.col("airline_code") == airline)
        .orderBy("month")
        .selectExpr(
            "date_format(month, 'yyyy-MM') AS month",
            "airline_code",
            "on_time_pct",
            "avg_arr_delay",
            "mom_change_pct",
        )
    )


def trend_for_carriers(trend: DataFrame, airlines: tuple[str, ...] = ("AA", "DL", "UA")) -> DataFrame:
    return trend.filter(F.col("airline_code").isin(*airlines)).orderBy("airline_code", "month")


def riskiest_routes(risk: DataFrame, top: int | None = 20) -> DataFrame:
    return head(risk.orderBy(F.expr("risk_score").desc_nulls_first(), "origin", "destination"), top)


def recent_daily_ops(daily: DataFrame, airline: str = "AA", days: int | None = 30) -> DataFrame:
    return head(daily.filter(F.col("airline_code") == airline).orderBy(F.desc("flight_date")), days)


def kpi_bands(score: DataFrame) -> DataFrame:
    """Score rows with display bands; a missing share is never good."""
    return score.selectExpr(
        "*",
        f"CASE WHEN on_time_pct >= {ON_TIME_TARGET} THEN 'good' ELSE 'warning' END AS on_time_band",
        f"CASE WHEN cancellation_rate < {CANCELLATION_TARGET} THEN 'good' ELSE 'bad' END"
        " AS cancellation_band",
    )


def flag_quality_issues(summary: DataFrame) -> DataFrame:
    return summary.selectExpr(
        "*", "metric_name <> 'total_rows' AND metric_value > 0 AS is_issue"
    )


def count_between(flights: DataFrame, start: str, end: str) -> DataFrame:
    return date_range(flights, start, end).agg(F.expr("count(1) AS flight_count"))


def monthly_delay(flights: DataFrame) -> DataFrame:
    """Unrounded mean arrival delay of flown flights per airline and month."""
    by_month = flights.filter(m.COMPLETED).groupBy("airline_code", F.expr(MONTH))
    return by_month.agg(F.expr("avg(arr_delay_min) AS avg_arr_delay"))


def monthly_slice(summary: DataFrame, airline: str = "AA") -> DataFrame:
    return summary.filter(F.col("airline_code") == airline).orderBy("month")
