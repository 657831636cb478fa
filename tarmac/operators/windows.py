"""Window analytics.

Every window runs over aggregated rows (months, days, or distinct delay values),
never over raw flights; windows without a partition have a bound on their rows given
by the date range or the delay range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import measures as m
from tarmac.functions.dates import MONTH, date_range
from tarmac.functions.numeric import decimals_to_double, mean, pct, ratio, rounded
from tarmac.operators.views import head

MIN_ROUTE_MONTH_FLIGHTS = 50
TOP_SURGES = 50


def monthly_rank(flights: DataFrame, start: str, end: str) -> DataFrame:
    """Airlines ranked in each month by punctuality and by mean delay.

    Ranks compare the unrounded values; a missing share ranks first, a missing delay last.
    """
    share = ratio("on_time_flights", "completed_flights")
    delay = ratio("arr_sum", "arr_n")
    ranked = m.measures(date_range(flights, start, end), [MONTH, "airline_code"]).selectExpr(
        "month",
        "airline_code",
        "total_flights",
        "on_time_flights",
        f"{m.ON_TIME_PCT} AS on_time_pct",
        f"{m.AVG_ARR_DELAY} AS avg_delay_min",
        f"CAST(rank() OVER (PARTITION BY month ORDER BY {share} DESC NULLS FIRST) AS BIGINT)"
        " AS rank_on_time",
        f"CAST(dense_rank() OVER (PARTITION BY month ORDER BY {delay} ASC NULLS LAST) AS BIGINT)"
        " AS dense_rank_by_delay",
    )
    return decimals_to_double(ranked).orderBy(
        "month", "rank_on_time", F.expr("airline_code").asc_nulls_last()
    )


def moving_averages(flights: DataFrame, start: str, end: str) -> DataFrame:
    """Daily mean delay per airline with 7-row, 30-row and running means of it.

    The frames count rows, so a day without flights does not take up a place.
    """
    flown = date_range(flights, start, end).filter(m.COMPLETED)
    daily = m.measures(flown, ["flight_date", "airline_code"]).selectExpr(
        "flight_date",
        "airline_code",
        "total_flights AS daily_flights",
        f"{m.AVG_ARR_DELAY} AS daily_avg_delay",
    )

    def frame_mean(first: str) -> str:
        over = (
            "OVER (PARTITION BY airline_code ORDER BY flight_date"
            f" ROWS BETWEEN {first} PRECEDING AND CURRENT ROW)"
        )
        return mean(f"sum(daily_avg_delay) {over}", f"count(daily_avg_delay) {over}")

    return decimals_to_double(
        daily.selectExpr(
            "*",
            f"{frame_mean('6')} AS moving_avg_7day",
            f"{frame_mean('29')} AS moving_avg_30day",
            f"{frame_mean('UNBOUNDED')} AS cumulative_avg",
        )
    ).orderBy(F.expr("airline_code").asc_nulls_last(), "flight_date")


def delay_surges(
    flights: DataFrame, start: str, end: str, top: int | None = TOP_SURGES
) -> DataFrame:
    """The largest changes of a route's mean delay against its previous busy month."""
    busy = (
        m.measures(date_range(flights, start, end), [MONTH, "origin", "destination"])
        .filter(f"total_flights >= {MIN_ROUTE_MONTH_FLIGHTS}")
        .selectExpr(
            "month",
            "origin",
            "destination",
            "total_flights AS flight_count",
            f"{m.AVG_ARR_DELAY} AS current_avg_delay",
        )
        .selectExpr(
            "*",
            "lag(current_avg_delay) OVER (PARTITION BY origin, destination ORDER BY month)"
            " AS prev_month_avg_delay",
        )
    )
    change = "(current_avg_delay - prev_month_avg_delay)"
    # The denominator keeps its sign: a route that was early on average flips the change.
    previous = "nullif(CAST(prev_month_avg_delay AS DECIMAL(18,2)), 0.00)"
    largest = (
        busy.selectExpr(
            "*",
            f"{rounded(f'CAST(100 * {change} AS DECIMAL(22,2)) / {previous}')} AS pct_change",
            f"CASE WHEN {change} > 30 THEN 'surge' WHEN {change} > 10 THEN 'up'"
            f" WHEN {change} < -10 THEN 'improved' ELSE 'stable' END AS trend",
        )
        .orderBy(F.expr(f"abs({change})").desc_nulls_last(), "month", "origin", "destination")
    )
    return decimals_to_double(head(largest, top))


def delay_distribution(flights: DataFrame) -> DataFrame:
    """Percentile positions of the distinct arrival delays between -60 and 360 minutes."""
    counts = (
        flights.filter(f"{m.COMPLETED} AND arr_delay_min BETWEEN -60 AND 360")
        .groupBy("arr_delay_min")
        .agg(F.expr("count(1) AS frequency"))
    )
    over = "OVER (ORDER BY arr_delay_min)"
    four_digits = lambda x: f"round(CAST({x} AS DECIMAL(18,8)), 4)"
    return decimals_to_double(
        counts.selectExpr(
            "arr_delay_min",
            "frequency",
            f"ntile(10) {over} AS decile",
            f"ntile(4) {over} AS quartile",
            f"{four_digits(f'percent_rank() {over}')} AS percent_rank",
            f"{four_digits(f'cume_dist() {over}')} AS cumulative_dist",
        )
    ).orderBy("arr_delay_min")


def running_totals(flights: DataFrame, start: str, end: str) -> DataFrame:
    """Flights and cancellations per day with running totals; one row per calendar day."""
    so_far = "OVER (ORDER BY flight_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    daily = m.measures(date_range(flights, start, end), ["flight_date"]).selectExpr(
        "flight_date",
        "total_flights AS flights_today",
        "cancelled_flights AS cancelled_today",
        f"sum(total_flights) {so_far} AS cumulative_flights",
        f"sum(cancelled_flights) {so_far} AS cumulative_cancelled",
    )
    rate = pct("cumulative_cancelled", "cumulative_flights")
    return decimals_to_double(daily.selectExpr("*", f"{rate} AS cumulative_cancel_rate")).orderBy(
        "flight_date"
    )


def airline_vs_industry(flights: DataFrame, start: str, end: str) -> DataFrame:
    """Airline's monthly mean delay against the plain mean of all airlines in the month."""
    over = "OVER (PARTITION BY month)"
    industry = ratio(f"sum(airline_avg_delay) {over}", f"count(airline_avg_delay) {over}")
    compared = (
        m.measures(date_range(flights, start, end), [MONTH, "airline_code"])
        .selectExpr("month", "airline_code", f"{m.AVG_ARR_DELAY} AS airline_avg_delay")
        .selectExpr("*", f"{industry} AS _industry")
    )
    report = compared.selectExpr(
        "month",
        "airline_code",
        "airline_avg_delay",
        f"{rounded('_industry')} AS industry_avg_delay",
        f"{rounded('airline_avg_delay - _industry')} AS diff_from_industry",
        "CASE WHEN airline_avg_delay < _industry - 5 THEN 'better than industry'"
        " WHEN airline_avg_delay > _industry + 5 THEN 'worse than industry'"
        " ELSE 'same as industry' END AS vs_industry",
    )
    return decimals_to_double(report).orderBy(
        "month",
        F.expr("diff_from_industry").asc_nulls_last(),
        F.expr("airline_code").asc_nulls_last(),
    )
