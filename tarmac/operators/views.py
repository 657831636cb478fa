"""Trend and operations views, and the five summary tables.

Each summary comes in two forms: from the flights, and `*_from` a finer measure table,
so that one pass over the flights can feed several summaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.functions import measures as m
from tarmac.functions.dates import MONTH
from tarmac.functions.numeric import decimals_to_double, pct, rounded
from tarmac.operators.kpi import with_airline_name

MIN_RISK_FLIGHTS = 50
MIN_TOP_ROUTE_FLIGHTS = 100
MIN_CARRIER_ROUTE_FLIGHTS = 20
CARRIER_ROUTE = ("origin", "destination", "airline_code")


def head(ordered: DataFrame, rows: int | None) -> DataFrame:
    """The first rows of a report; None for all of them."""
    if rows is None:
        return ordered
    if rows < 1:
        raise ValueError(f"a report has at least one row, not {rows}")
    return ordered.limit(rows)


def airline_monthly_trend(flights: DataFrame) -> DataFrame:
    """Punctuality per airline and month with the previous month and the rank in the month."""
    monthly = m.measures(flights, [MONTH, "airline_code"]).selectExpr(
        "month",
        "airline_code",
        "completed_flights",
        f"{m.ON_TIME_PCT} AS on_time_pct",
        f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
    )
    compared = monthly.selectExpr(
        "*",
        "lag(on_time_pct) OVER (PARTITION BY airline_code ORDER BY month) AS prev_on_time_pct",
        "CAST(rank() OVER (PARTITION BY month ORDER BY on_time_pct DESC NULLS LAST) AS BIGINT)"
        " AS rank_in_month",
    )
    change = rounded("on_time_pct - prev_on_time_pct")
    return decimals_to_double(compared.selectExpr("*", f"{change} AS mom_change_pct"))


def airline_daily_ops(flights: DataFrame) -> DataFrame:
    return decimals_to_double(
        m.measures(flights, ["flight_date", "airline_code"]).selectExpr(
            "flight_date",
            "airline_code",
            "total_flights",
            "completed_flights",
            "cancelled_flights",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay_min",
        )
    )


def route_risk_score(flights: DataFrame) -> DataFrame:
    return decimals_to_double(
        m.measures(flights, ["origin", "destination"])
        .filter(f"total_flights >= {MIN_RISK_FLIGHTS}")
        .selectExpr(
            "origin",
            "destination",
            "total_flights",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
            f"{m.RISK_SCORE} AS risk_score",
        )
    )


def fine_measures(flights: DataFrame) -> DataFrame:
    """Measures by month, airline and route: the grain four summaries roll up from."""
    return m.measures(flights, [MONTH, *CARRIER_ROUTE])


def _shape_airline_summary(totals: DataFrame, airlines: DataFrame) -> DataFrame:
    return decimals_to_double(
        with_airline_name(totals, airlines).selectExpr(
            "airline_code",
            "airline_name",
            "total_flights",
            "completed_flights",
            "cancelled_flights",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay_min",
            f"{m.AVG_DEP_DELAY} AS avg_dep_delay_min",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
            "severe_flights AS severe_delay_count",
            "first_date AS data_from",
            "last_date AS data_to",
        )
    )


def airline_summary(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    return _shape_airline_summary(m.measures(flights, ["airline_code"]), airlines)


def airline_summary_from(fine: DataFrame, airlines: DataFrame) -> DataFrame:
    return _shape_airline_summary(m.roll_up(fine, ["airline_code"]), airlines)


CELL = ("day_of_week", "hour_of_day")


def heatmap_cells(flights: DataFrame, *keys: str) -> DataFrame:
    """Measures by weekday (0 = Sunday) and departure hour, over flown departures with a time."""
    return m.measures(
        flights.filter(f"{m.COMPLETED} AND dep_time IS NOT NULL"),
        [
            *keys,
            "dayofweek(flight_date) - 1 AS day_of_week",
            "CAST(substring(dep_time, 1, 2) AS INT) AS hour_of_day",
        ],
    )


def delay_heatmap(flights: DataFrame) -> DataFrame:
    return _shape_heatmap(heatmap_cells(flights))


def delay_heatmap_from(cells: DataFrame) -> DataFrame:
    return _shape_heatmap(m.roll_up(cells, CELL))


def _shape_heatmap(cells: DataFrame) -> DataFrame:
    return decimals_to_double(
        cells.selectExpr(
            "day_of_week",
            "hour_of_day",
            "total_flights AS flight_count",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
            f"{m.AVG_DEP_DELAY} AS avg_dep_delay",
            f"{pct('late_rows', 'total_flights')} AS delay_rate_pct",
        )
    )


def with_route_ends(
    routes: DataFrame, airports: DataFrame, located_only: bool = True
) -> DataFrame:
    """Add names, cities and coordinates of both ends, which must be known airports.

    Routes with an end that has no location are dropped unless asked for. Meant for
    aggregated routes, one row each.
    """
    ends = airports.filter("lon IS NOT NULL AND lat IS NOT NULL") if located_only else airports

    def end(key: str, prefix: str) -> DataFrame:
        return ends.selectExpr(
            f"iata_code AS {key}",
            *[f"{c} AS {prefix}_{c}" for c in ("name", "city", "lon", "lat")],
        )

    return routes.join(end("origin", "origin"), "origin").join(
        end("destination", "dest"), "destination"
    )


def _shape_top_routes(totals: DataFrame, airports: DataFrame) -> DataFrame:
    routes = totals.filter(f"total_flights >= {MIN_TOP_ROUTE_FLIGHTS}")
    return decimals_to_double(
        with_route_ends(routes, airports).selectExpr(
            "origin",
            "destination",
            "origin_name",
            "dest_name",
            "origin_city",
            "dest_city",
            "origin_lon",
            "origin_lat",
            "dest_lon",
            "dest_lat",
            "total_flights",
            "completed_flights",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
            f"{m.AVG_DISTANCE} AS avg_distance_miles",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
        )
    )


def top_routes(flights: DataFrame, airports: DataFrame) -> DataFrame:
    return _shape_top_routes(m.measures(flights, ["origin", "destination"]), airports)


def top_routes_from(fine: DataFrame, airports: DataFrame) -> DataFrame:
    return _shape_top_routes(m.roll_up(fine, ["origin", "destination"]), airports)


def _shape_monthly_trend(totals: DataFrame, airlines: DataFrame) -> DataFrame:
    return decimals_to_double(
        with_airline_name(totals, airlines).selectExpr(
            "month",
            "airline_code",
            "airline_name",
            "total_flights",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
            *[
                f"{cause}_min AS total_{cause}_delay_min"
                for cause in ("carrier", "weather", "nas", "late_aircraft")
            ],
        )
    )


def monthly_trend(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    return _shape_monthly_trend(m.measures(flights, [MONTH, "airline_code"]), airlines)


def monthly_trend_from(fine: DataFrame, airlines: DataFrame) -> DataFrame:
    return _shape_monthly_trend(m.roll_up(fine, ["month", "airline_code"]), airlines)


def _shape_route_performance(totals: DataFrame, airlines: DataFrame) -> DataFrame:
    pairs = totals.filter(f"total_flights >= {MIN_CARRIER_ROUTE_FLIGHTS}")
    return decimals_to_double(
        with_airline_name(pairs, airlines).selectExpr(
            "origin",
            "destination",
            "airline_code",
            "airline_name",
            "total_flights",
            f"{m.AVG_ARR_DELAY} AS avg_arr_delay",
            f"{m.ON_TIME_PCT} AS on_time_pct",
            f"{m.CANCELLATION_RATE} AS cancellation_rate",
        )
    )


def route_performance(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    return _shape_route_performance(m.measures(flights, CARRIER_ROUTE), airlines)


def route_performance_from(fine: DataFrame, airlines: DataFrame) -> DataFrame:
    return _shape_route_performance(m.roll_up(fine, CARRIER_ROUTE), airlines)
