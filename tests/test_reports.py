"""KPI, view, window and quality reports on small hand-made inputs."""

import datetime
from fractions import Fraction

import pytest

from tarmac.functions.numeric import mean, pct
from tarmac.operators import kpi, quality, reports, views, windows
from tarmac.operators.audit import delay_audit
from tests.conftest import rows

YEAR = ("2023-01-01", "2023-12-31")


def half_away(x: Fraction, digits: int) -> float:
    scaled = abs(x) * 10**digits
    whole = int(scaled + Fraction(1, 2))
    return float(Fraction(whole, 10**digits) * (1 if x >= 0 else -1))


def test_rounding_is_exact_half_away_from_zero(spark):
    pairs = [(n, d) for d in (1, 3, 7, 8, 16, 40, 200, 400, 1000, 4000) for n in range(-60, 61)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.selectExpr("n", "d", f"CAST({pct('n', 'd')} AS DOUBLE)", f"CAST({mean('n', 'd', 1)} AS DOUBLE)")
    for n, d, share, average in rows(got):
        assert share == half_away(Fraction(100 * n, d), 2)
        assert average == half_away(Fraction(n, d), 1)


def test_rounding_stays_exact_for_huge_totals(spark):
    # 100 * part / whole = 50.005 minus 1e-11: rounds down although a double shows a tie
    whole = 2 * 10**12
    part = whole * 50005 // 100000 - 1
    got = spark.range(1).selectExpr(f"CAST({pct(f'{part}L', f'{whole}L')} AS DOUBLE)").first()[0]
    assert got == 50.0


def test_zero_denominator_is_null(spark):
    assert spark.range(1).selectExpr(pct("1", "0")).first()[0] is None


def test_score_without_flights_is_one_row_of_nulls(flights_of):
    got = kpi.airline_score(flights_of({}), "ZZ", *YEAR).first().asDict()
    assert got["airline_code"] == "ZZ" and got["total_flights"] == 0
    assert all(v is None for k, v in got.items() if k not in ("airline_code", "total_flights"))


def test_route_without_flights_counts_zero(flights_of):
    got = rows(kpi.route_kpi(flights_of({}), "AAA", "BBB", *YEAR))
    assert got == [(0, 0, 0, None, None, None)]


def test_diverted_flights_are_completed_but_never_on_time(flights_of):
    flights = flights_of({"diverted": True, "arr_delay_min": None}, {"arr_delay_min": 15})
    got = kpi.airline_score(flights, "AA", *YEAR).first()
    assert (got.completed_flights, got.on_time_flights, got.on_time_pct) == (2, 1, 50.0)
    assert got.avg_arr_delay_min == 15.0


def test_score_may_exceed_one_hundred_when_early(flights_of):
    got = kpi.airline_score(flights_of({"arr_delay_min": -50}), "AA", *YEAR).first()
    assert got.performance_score == 50 + 45 + 20


def test_date_range_includes_both_ends(flights_of):
    flights = flights_of(
        {"flight_date": "2022-12-31"}, {"flight_date": "2023-01-01"}, {"flight_date": "2023-12-31"},
        {"flight_date": "2024-01-01"},
    )
    assert reports.count_between(flights, *YEAR).first()[0] == 2


def test_ranking_shares_ranks_and_puts_missing_scores_first(spark, flights_of):
    some = lambda code, n, **kw: [{"airline_code": code, **kw}] * n
    flights = flights_of(
        *some("AA", 100), *some("BB", 100), *some("CC", 100, arr_delay_min=90),
        *some("DD", 100, cancelled=True, arr_delay_min=None), *some("EE", 99),
    )
    airlines = spark.createDataFrame([("AA", "Alpha", "US")], "iata_code string, name string, country string")
    got = rows(kpi.airline_ranking(flights, airlines, *YEAR).select("rank_position", "airline_code", "airline_name", "performance_score"))
    # all cancelled: no punctuality share, so no score; missing scores sort first
    assert got == [
        (1, "DD", "Unknown", None), (2, "AA", "Alpha", 100.0), (2, "BB", "Unknown", 100.0),
        (4, "CC", "Unknown", 23.0),
    ]


def test_breakdown_counts_causes_on_early_flights_too(flights_of):
    flights = flights_of(
        {"arr_delay_min": 30, "carrier_delay": 10, "weather_delay": 10},
        {"arr_delay_min": -5, "carrier_delay": 40},
        {"arr_delay_min": 30, "cancelled": True, "nas_delay": 30},
    )
    got = rows(kpi.delay_breakdown(flights, "AA", *YEAR))
    assert got == [("Carrier", 50, 25.0, 2, 250.0), ("Weather", 10, 10.0, 1, 50.0)]


def test_best_routes_order(spark, flights_of):
    rows_of = lambda code, late, delay: [{"airline_code": code, "arr_delay_min": delay}] * (10 - late) + [{"airline_code": code, "arr_delay_min": 16}] * late
    flights = flights_of(*rows_of("AA", 5, 0), *rows_of("BB", 0, 10), *rows_of("CC", 0, 5), *rows_of("DD", 0, 0)[:9])
    airlines = spark.createDataFrame([], "iata_code string, name string, country string")
    got = rows(kpi.best_routes_between(flights, airlines, "JFK", "LAX", *YEAR).select("airline_code"))
    assert [r[0] for r in got] == ["CC", "BB", "AA"]


def test_month_rank_treats_missing_share_by_view(flights_of):
    flights = flights_of(
        {"airline_code": "AA"}, {"airline_code": "BB", "cancelled": True, "arr_delay_min": None},
    )
    view = {r.airline_code: r.rank_in_month for r in views.airline_monthly_trend(flights).collect()}
    assert view == {"AA": 1, "BB": 2}  # missing share last
    query = {r.airline_code: (r.rank_on_time, r.dense_rank_by_delay) for r in windows.monthly_rank(flights, *YEAR).collect()}
    assert query == {"BB": (1, 2), "AA": (2, 1)}  # missing share first, missing delay last


def test_trend_uses_previous_month_present(flights_of):
    flights = flights_of(
        {"flight_date": "2023-01-10"}, {"flight_date": "2023-03-10", "arr_delay_min": 60},
    )
    got = rows(reports.trend_for(views.airline_monthly_trend(flights), "AA"))
    assert got == [("2023-01", "AA", 100.0, 0.0, None), ("2023-03", "AA", 0.0, 60.0, -100.0)]


def test_heatmap_weekday_zero_is_sunday(flights_of):
    flights = flights_of(
        {"flight_date": "2023-01-01", "dep_time": "23:59:00", "arr_delay_min": 16},
        {"flight_date": "2023-01-01", "dep_time": "23:00:00", "arr_delay_min": None},
        {"flight_date": "2023-01-07", "dep_time": None},
        {"flight_date": "2023-01-07", "cancelled": True},
    )
    assert rows(views.delay_heatmap(flights)) == [(0, 23, 2, 16.0, 0.0, 50.0)]


def test_risk_needs_fifty_flights(flights_of):
    flights = flights_of(*[{"arr_delay_min": 10}] * 49, {"cancelled": True, "arr_delay_min": None})
    assert rows(views.route_risk_score(flights)) == [("JFK", "LAX", 50, 10.0, 2.0, 7.6)]
    assert views.route_risk_score(flights_of(*[{}] * 49)).count() == 0


def test_moving_average_counts_rows_not_days(flights_of):
    flights = flights_of(*[{"flight_date": f"2023-01-{d:02d}", "arr_delay_min": d} for d in range(1, 30, 3)])
    got = rows(windows.moving_averages(flights, *YEAR))
    assert len(got) == 10
    assert got[-1][4] == (10 + 13 + 16 + 19 + 22 + 25 + 28) / 7
    assert got[-1][5] == got[-1][6] == sum(range(1, 30, 3)) / 10


def test_surges_skip_thin_months_and_sort_by_size(flights_of):
    month = lambda m, n, delay, origin="JFK": [{"flight_date": f"2023-{m:02d}-05", "arr_delay_min": delay, "origin": origin}] * n
    flights = flights_of(
        *month(1, 50, 10), *month(2, 49, 500), *month(3, 50, 45), *month(4, 50, 34),
        *month(1, 50, -10, "ATL"), *month(2, 50, 1, "ATL"),
    )
    got = [(r.month.month, r.origin, r.prev_month_avg_delay, r.pct_change, r.trend) for r in windows.delay_surges(flights, *YEAR).collect()]
    assert got == [
        (3, "JFK", 10.0, 350.0, "surge"),
        (2, "ATL", -10.0, -110.0, "up"),
        (4, "JFK", 45.0, -24.44, "improved"),
        (1, "ATL", None, None, "stable"),
        (1, "JFK", None, None, "stable"),
    ]


def test_distribution_runs_over_distinct_delays(flights_of):
    flights = flights_of(*[{"arr_delay_min": d} for d in (0, 0, 0, 5, 10, 400, -61)])
    got = rows(windows.delay_distribution(flights))
    assert [r[:2] for r in got] == [(0, 3), (5, 1), (10, 1)]
    assert [r[4:] for r in got] == [(0.0, 0.3333), (0.5, 0.6667), (1.0, 1.0)]


def test_running_totals_end_at_the_totals(data):
    got = rows(windows.running_totals(data.flights, *YEAR))
    assert got[-1][3] == sum(r[1] for r in got) == data.flights.count()
    assert got[-1][4] == sum(r[2] for r in got)


def test_industry_mean_is_unweighted(flights_of):
    flights = flights_of(*[{"airline_code": "AA", "arr_delay_min": 0}] * 9, {"airline_code": "BB", "arr_delay_min": 20})
    got = [r[1:] for r in rows(windows.airline_vs_industry(flights, *YEAR))]
    assert got == [
        ("AA", 0.0, 10.0, -10.0, "better than industry"), ("BB", 20.0, 10.0, 10.0, "worse than industry"),
    ]


def test_quality_summary(flights_of):
    flights = flights_of(
        {}, {"dep_time": None, "arr_time": None, "cancelled": True, "arr_delay_min": None},
        {"distance_miles": 0}, {"arr_delay_min": 16},
    )
    got = rows(quality.data_quality_summary(flights, *YEAR))
    assert got[0] == ("total_rows", 4, 100.0)
    assert set(got[1:]) == {(n, 1, 25.0) for n in (
        "null_dep_time", "null_arr_time", "cancelled_rows", "negative_distance", "missing_delay_breakdown_on_delayed")}
    empty = rows(quality.data_quality_summary(flights, "2020-01-01", "2020-12-31"))
    assert {r[1:] for r in empty} == {(0, None)} and len(empty) == 6


def test_orphan_codes_include_null(spark, flights_of):
    airports = spark.createDataFrame([("LAX",)], "iata_code string")
    got = rows(quality.invalid_airport_references(flights_of({}, {"origin": None}), airports))
    assert got == [("origin", "JFK", 1), ("origin", None, 1)]


def test_duplicates_treat_nulls_as_equal(flights_of):
    got = rows(quality.duplicate_keys(flights_of({"dep_time": None}, {"dep_time": None}, {})))
    assert got == [(datetime.date(2023, 1, 1), "AA", "1", "JFK", "LAX", None, 2)]


def test_audit_categories(flights_of):
    delays = (-5, 0, 1, 15, 16, 60, 61, None)
    got = delay_audit(flights_of(*[{"arr_delay_min": d} for d in delays], {"cancelled": True}))
    assert [r.delay_category for r in got.orderBy("flight_id").collect()] == [
        "on_time", "on_time", "minor", "minor", "major", "major", "severe",
    ]


def test_bands(flights_of):
    flights = flights_of(*[{}] * 97, *[{"cancelled": True}] * 3)
    got = reports.kpi_bands(kpi.airline_score(flights, "AA", *YEAR)).first()
    assert (got.on_time_band, got.cancellation_band) == ("good", "bad")  # 3 % is not below 3


def test_route_limit(spark):
    columns = ", ".join(f"0 AS {c}" for c in reports._ROUTE_COLUMNS if c not in ("origin", "total_flights"))
    summary = spark.range(200).selectExpr("CAST(id AS STRING) AS origin", "id AS total_flights", *columns.split(", "))
    assert [reports.top_routes(summary, n).count() for n in (150, 5, None)] == [150, 5, 200]
    assert reports.top_routes(summary).count() == 20
    for wrong in (0, -1):
        with pytest.raises(ValueError, match="at least one row"):
            reports.top_routes(summary, wrong)
