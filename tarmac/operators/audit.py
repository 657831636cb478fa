"""Delay audit rows, shared by the batch and the streaming path."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.functions.measures import COMPLETED


def delay_audit(flights: DataFrame, *extra: str) -> DataFrame:
    """One row per flown flight with a known arrival delay, early arrivals included.

    A stored flight is logged with the time it was stored, so an audit month rebuilt
    from the flights table equals the one written at load time. `extra` columns are kept.
    """
    logged_at = "created_at" if "created_at" in flights.columns else "current_timestamp()"
    return flights.filter(f"{COMPLETED} AND arr_delay_min IS NOT NULL").selectExpr(
        "id AS flight_id",
        "flight_date",
        "airline_code",
        "origin",
        "destination",
        "arr_delay_min AS delay_minutes",
        "CASE WHEN arr_delay_min <= 0 THEN 'on_time' WHEN arr_delay_min <= 15 THEN 'minor'"
        " WHEN arr_delay_min <= 60 THEN 'major' ELSE 'severe' END AS delay_category",
        f"{logged_at} AS logged_at",
        *extra,
    )
