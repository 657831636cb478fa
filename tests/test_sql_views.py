from pyspark.sql import functions as F

from tarmac.operators import kpi, quality, reports, views
from tarmac.operators.sql_views import register_functions, register_views
from tests.conftest import rows


def test_saved_queries_run_as_sql(spark, data):
    stored = {"top_routes": views.top_routes(data.flights, data.airports)}
    register_views(data.flights, data.airports, data.airlines, data.audit, stored)
    trend = spark.sql(
        "SELECT airline_code, count(*) AS months, min(rank_in_month) AS best FROM v_airline_monthly_trend"
        " GROUP BY airline_code"
    )
    expected = views.airline_monthly_trend(data.flights).groupBy("airline_code").agg(
        F.count("*"), F.min("rank_in_month"))
    assert sorted(rows(trend)) == sorted(rows(expected))
    flown = spark.sql("SELECT max(total_flights), count(*) FROM mv_top_routes").first()
    assert tuple(flown) == (reports.top_routes(stored["top_routes"], 1).first().total_flights, stored["top_routes"].count())
    assert spark.sql("SELECT * FROM mv_delay_heatmap").count() == 168
    severe = spark.sql(
        "SELECT count(*), (SELECT count(*) FROM delay_audit_log WHERE delay_category = 'severe')"
        " FROM flights WHERE NOT cancelled AND arr_delay_min > 60"
    ).first()
    assert severe[0] == severe[1] > 0
    named = spark.sql("SELECT count(*) FROM mv_airline_summary s JOIN airlines a ON a.iata_code = s.airline_code")
    assert named.first()[0] == 9


def test_table_functions_equal_the_reports(spark, data):
    register_views(data.flights, data.airports, data.airlines, data.audit)
    register_functions(spark)
    year = ("2023-01-01", "2023-12-31")
    f, a = data.flights, data.airlines
    days = "DATE'2023-01-01', DATE'2023-12-31'"
    for call, report in {
        f"fn_airline_score('AA', {days})": kpi.airline_score(f, "AA", *year),
        f"fn_airline_ranking({days})": kpi.airline_ranking(f, a, *year),
        f"fn_delay_breakdown('AA', {days})": kpi.delay_breakdown(f, "AA", *year),
        f"fn_best_routes_between('JFK', 'LAX', {days})": kpi.best_routes_between(f, a, "JFK", "LAX", *year),
        f"fn_route_kpi('JFK', 'LAX', {days})": kpi.route_kpi(f, "JFK", "LAX", *year),
        f"fn_route_kpi('JFK', 'none', {days})": kpi.route_kpi(f, "JFK", "none", *year),
        f"fn_data_quality_summary({days})": quality.data_quality_summary(f, *year),
        "fn_invalid_airport_references()": quality.invalid_airport_references(f, data.airports),
    }.items():
        found = spark.sql(f"SELECT * FROM {call}")
        assert found.columns == report.columns
        assert sorted(rows(found), key=repr) == sorted(rows(report), key=repr), call
