"""The tables, views, summaries and reports under SQL names, for use with `spark.sql`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.functions import measures as m
from tarmac.functions.numeric import mean, pct, rounded
from tarmac.operators import kpi, views
from tarmac.operators.quality import QUALITY_CHECKS


def register_views(
    flights: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    audit: DataFrame,
    summaries: dict[str, DataFrame] | None = None,
) -> None:
    """Create temporary views in the session of `flights`.

    Without stored `summaries` the `mv_` names stand for the summaries computed live.
    """
    live = {
        "airline_summary": lambda: views.airline_summary(flights, airlines),
        "delay_heatmap": lambda: views.delay_heatmap(flights),
        "top_routes": lambda: views.top_routes(flights, airports),
        "monthly_trend": lambda: views.monthly_trend(flights, airlines),
        "route_performance": lambda: views.route_performance(flights, airlines),
    }
    stored = summaries or {}
    named = {
        "flights": flights,
        "airports": airports,
        "airlines": airlines,
        "delay_audit_log": audit,
        "v_airline_monthly_trend": views.airline_monthly_trend(flights),
        "v_airline_daily_ops": views.airline_daily_ops(flights),
        "v_route_risk_score": views.route_risk_score(flights),
        **{f"mv_{name}": stored[name] if name in stored else make() for name, make in live.items()},
    }
    for name, df in named.items():
        df.createOrReplaceTempView(name)


def _measured(where: str, *keys: str) -> str:
    """The measures of some flights as a subquery."""
    columns = ", ".join([*keys, *(f"{text} AS {name}" for name, text in m.MEASURES.items())])
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"(SELECT {columns} FROM flights WHERE {where}{group})"


_DAYS = "flight_date BETWEEN p_start AND p_end"
_ROUTE = f"origin = p_origin AND destination = p_destination AND {_DAYS}"
_NAMED = "LEFT JOIN airlines a ON a.iata_code = s.airline_code"
_NAME = "coalesce(a.name, 'Unknown')"


def _score() -> str:
    return f"""
        SELECT p_code, total_flights, coalesce(completed_flights, 0), coalesce(on_time_flights, 0),
          {m.ON_TIME_PCT}, {m.AVG_ARR_DELAY}, {m.AVG_DEP_DELAY}, {m.CANCELLATION_RATE},
          {m.SEVERE_DELAY_PCT}, {m.EXACT_PERFORMANCE}
        FROM {_measured(f"airline_code = p_code AND {_DAYS}")}"""


def _ranking() -> str:
    score = m.performance("ot", "ad", "cr")
    return f"""
        SELECT rank() OVER (ORDER BY {score} DESC NULLS FIRST), s.airline_code, {_NAME}, total_flights,
          ot, ad, cr, {rounded(score)}
        FROM (SELECT *, {m.ON_TIME_PCT} AS ot, {m.AVG_ARR_DELAY} AS ad, {m.CANCELLATION_RATE} AS cr
              FROM {_measured(_DAYS, "airline_code")} WHERE total_flights >= {kpi.MIN_RANKED_FLIGHTS}) s {_NAMED}"""


def _breakdown() -> str:
    every = " + ".join(f"coalesce({c}_delay, 0)" for c in kpi.CAUSE_LABELS)
    sums = ", ".join(
        f"sum(CASE WHEN {c}_delay > 0 THEN {c}_delay END) AS {c}_s, count_if({c}_delay > 0) AS {c}_n"
        for c in kpi.CAUSE_LABELS
    )
    listed = ", ".join(f"struct('{label}' AS cause, {c}_s AS s, {c}_n AS n)" for c, label in kpi.CAUSE_LABELS.items())
    return f"""
        SELECT x.cause, x.s, {mean("x.s", "x.n")}, x.n, {pct("x.s", "late")}
        FROM (SELECT late, explode(array({listed})) AS x FROM (
          SELECT sum(CASE WHEN arr_delay_min > 0 THEN {every} END) AS late, {sums} FROM flights
          WHERE airline_code = p_code AND {_DAYS} AND {m.COMPLETED})) WHERE x.n > 0"""


def _best_routes() -> str:
    return f"""
        SELECT s.airline_code, {_NAME}, total_flights, {m.ON_TIME_PCT}, {m.AVG_ARR_DELAY}, {m.AVG_DISTANCE},
          {m.CANCELLATION_RATE}
        FROM {_measured(_ROUTE, "airline_code")} s {_NAMED} WHERE total_flights >= {kpi.MIN_COMPARED_FLIGHTS}"""


def _route() -> str:
    return f"""
        SELECT total_flights, coalesce(completed_flights, 0), coalesce(cancelled_flights, 0),
          {m.CANCELLATION_RATE}, {m.ON_TIME_PCT}, {m.AVG_ARR_DELAY} FROM {_measured(_ROUTE)}"""


def _quality() -> str:
    counts = ", ".join(f"count_if({cond}) AS {name}" for name, cond in QUALITY_CHECKS.items())
    listed = ", ".join(f"struct('{name}' AS name, {name} AS n)" for name in ("total_rows", *QUALITY_CHECKS))
    return f"""
        SELECT x.name, x.n, {pct("x.n", "total_rows", 3)}
        FROM (SELECT total_rows, explode(array({listed})) AS x FROM (
          SELECT count(1) AS total_rows, {counts} FROM flights WHERE {_DAYS}))"""


def _invalid() -> str:
    return """
        SELECT source_col, c.iata_code, affected_rows FROM (
          SELECT x.source_col, x.iata_code, count(1) AS affected_rows FROM (
            SELECT explode(array(struct('origin' AS source_col, origin AS iata_code),
              struct('destination' AS source_col, destination AS iata_code))) AS x FROM flights)
          GROUP BY ALL) c LEFT JOIN (SELECT iata_code, TRUE AS known FROM airports) k ON k.iata_code = c.iata_code
        WHERE known IS NULL"""


_PERIOD = "p_start DATE, p_end DATE"
_ENDS = f"p_origin STRING, p_destination STRING, {_PERIOD}"
# name: parameters, columns, body; a column without a type is a DOUBLE
TABLE_FUNCTIONS = {
    "fn_airline_score": (
        f"p_code STRING, {_PERIOD}",
        "airline_code STRING, total_flights BIGINT, completed_flights BIGINT, on_time_flights BIGINT, "
        "on_time_pct, avg_arr_delay_min, avg_dep_delay_min, cancellation_rate, severe_delay_pct, performance_score",
        _score,
    ),
    "fn_airline_ranking": (
        _PERIOD,
        "rank_position INT, airline_code STRING, airline_name STRING, total_flights BIGINT, "
        "on_time_pct, avg_arr_delay_min, cancellation_rate, performance_score",
        _ranking,
    ),
    "fn_delay_breakdown": (
        f"p_code STRING, {_PERIOD}",
        "delay_cause STRING, total_minutes BIGINT, avg_minutes, flight_count BIGINT, pct_of_total_delay",
        _breakdown,
    ),
    "fn_best_routes_between": (
        _ENDS,
        "airline_code STRING, airline_name STRING, total_flights BIGINT, on_time_pct, avg_arr_delay_min, "
        "avg_distance_miles, cancellation_rate",
        _best_routes,
    ),
    "fn_route_kpi": (
        _ENDS,
        "total_flights BIGINT, completed_flights BIGINT, cancelled_flights BIGINT, cancellation_rate, "
        "on_time_pct, avg_arr_delay_min",
        _route,
    ),
    "fn_data_quality_summary": (_PERIOD, "metric_name STRING, metric_value BIGINT, metric_percent", _quality),
    "fn_invalid_airport_references": ("", "source_col STRING, iata_code STRING, affected_rows BIGINT", _invalid),
}


def register_functions(spark: SparkSession) -> None:
    """Create the parameterised reports as temporary SQL table functions over the registered views.

    The bodies are the expressions of the DataFrame reports; call `register_views` first.
    """
    for name, (parameters, columns, body) in TABLE_FUNCTIONS.items():
        typed = ", ".join(c if " " in c.strip() else f"{c} DOUBLE" for c in columns.split(", "))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({typed}) RETURN {body()}")
