"""Additive flight measures and the KPIs derived from them, as SQL expression text.

Every report is `measures(flights, keys)` followed by a projection of KPI columns.
The measures are plain sums, counts, minima and maxima, so they
  * combine map-side: a shuffle carries one row per key and task, however hot a key is;
  * roll up: a finer-grained measure table can be aggregated again without loss.
Measures a report does not project are pruned by Catalyst, and so are the file
columns they would have read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numeric import mean, pct, ratio, rounded

# Thresholds of the metric definitions, in minutes.
ON_TIME_MAX = 15
SEVERE_OVER = 60

CAUSES = ("carrier", "weather", "nas", "security", "late_aircraft")

COMPLETED = "NOT cancelled"
ON_TIME = f"NOT cancelled AND arr_delay_min <= {ON_TIME_MAX}"
SEVERE = f"NOT cancelled AND arr_delay_min > {SEVERE_OVER}"
LATE = f"arr_delay_min > {ON_TIME_MAX}"


def _rows(cond: str) -> str:
    return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)"


_ARR = f"CASE WHEN {COMPLETED} THEN arr_delay_min END"
_DEP = f"CASE WHEN {COMPLETED} THEN dep_delay_min END"

MEASURES = {
    "total_flights": "count(1)",
    "completed_flights": _rows(COMPLETED),
    "cancelled_flights": _rows("cancelled"),
    "on_time_flights": _rows(ON_TIME),
    "severe_flights": _rows(SEVERE),
    "late_rows": _rows(LATE),
    "arr_sum": f"sum({_ARR})",
    "arr_n": f"count({_ARR})",
    "dep_sum": f"sum({_DEP})",
    "dep_n": f"count({_DEP})",
    "dist_sum": "sum(distance_miles)",
    "dist_n": "count(distance_miles)",
    "first_date": "min(flight_date)",
    "last_date": "max(flight_date)",
    **{f"{cause}_min": f"sum(coalesce({cause}_delay, 0))" for cause in CAUSES},
}
_COMBINE = {"first_date": "min", "last_date": "max"}


def measures(flights: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Aggregate flights to `keys`, given as SQL text (none: one row for everything)."""
    aggs = [F.expr(f"{text} AS {name}") for name, text in MEASURES.items()]
    return flights.groupBy(*[F.expr(key) for key in keys]).agg(*aggs)


def roll_up(fine: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Aggregate a measure table again, to coarser keys."""
    aggs = [F.expr(f"{_COMBINE.get(name, 'sum')}({name}) AS {name}") for name in MEASURES]
    return fine.groupBy(*keys).agg(*aggs)


ON_TIME_PCT = pct("on_time_flights", "completed_flights")
CANCELLATION_RATE = pct("cancelled_flights", "total_flights")
SEVERE_DELAY_PCT = pct("severe_flights", "completed_flights")
AVG_ARR_DELAY = mean("arr_sum", "arr_n")
AVG_DEP_DELAY = mean("dep_sum", "dep_n")
AVG_DISTANCE = mean("dist_sum", "dist_n", 1)


def performance(on_time_share: str, arr_delay: str, cancel_share: str) -> str:
    """Weighted score, unrounded: half punctuality, the rest delay and cancellations.

    The delay part is clipped below only, so early arrivals lift the score.
    """
    return (
        f"(0.50 * {on_time_share} + 0.30 * greatest(0.00, 100 - coalesce({arr_delay}, 0.00))"
        f" + 0.20 * (100 - coalesce({cancel_share}, 0.00)))"
    )


# Score of unrounded parts, two digits.
EXACT_PERFORMANCE = rounded(
    performance(
        ratio("100 * on_time_flights", "completed_flights"),
        ratio("arr_sum", "arr_n"),
        ratio("100 * cancelled_flights", "total_flights"),
    )
)

# Mean delay (none counts as zero) at 0.7 plus cancellation percentage at 0.3.
RISK_SCORE = rounded(
    f"0.7 * coalesce({ratio('arr_sum', 'arr_n')}, 0.00)"
    f" + 0.3 * {ratio('100 * cancelled_flights', 'total_flights')}"
)
