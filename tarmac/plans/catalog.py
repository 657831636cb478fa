"""Runnable queries by name, over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import ingest, kpi, quality, reports, spatial, views, windows
from tarmac.operators.audit import delay_audit
from tarmac.operators.quality import BUSINESS_KEY
from tarmac.plans import round_trips
from tarmac.plans.data import YEAR, YEARS, Data
from tarmac.sources import footers, tables

Query = Callable[[Data], DataFrame]


def _checked(d: Data) -> DataFrame:
    """Every raw row, parsed and checked against the ingested dimensions."""
    return ingest.check_constraints(
        ingest.parse_flights(d.raw_flights), d.loaded_airlines, d.airports
    )


def _insertable(d: Data) -> DataFrame:
    parsed = ingest.ingest_flights(d.raw_flights)
    return ingest.accepted(ingest.check_constraints(parsed, d.loaded_airlines, d.airports))


def _existing(d: Data) -> DataFrame:
    """The first half of the year counts as loaded; the raw files hold the whole year."""
    return d.plain_flights.filter("flight_date < DATE'2023-07-01'")


def _inserted(d: Data) -> DataFrame:
    return ingest.insert_flights(_insertable(d), _existing(d))


def _ingest_constraints(d: Data) -> DataFrame:
    """Every parsed row with what it breaks; NULL for the good ones."""
    return _checked(d).filter("is_valid").drop("is_valid", "source_block")


def _ingest_flights(d: Data) -> DataFrame:
    return ingest.ingest_flights(d.raw_flights_once).drop("source_block")


def _audit_without_stamp(d: Data) -> DataFrame:
    return delay_audit(d.flights).drop("logged_at")


def _upsert_airports(d: Data) -> DataFrame:
    """The fixed airports keep their row unless the listing has the same code."""
    return d.upserted_airports


def _file_stats(d: Data) -> DataFrame:
    """From the staged rows, so that the text is parsed and checked once.

    Which file's row is inserted is told by key and source alone, so only these are compared.
    """
    checked = d.checked_flights
    good = ingest.accepted(checked.filter("is_valid")).select(*BUSINESS_KEY, *ingest.SOURCE_COLUMNS)
    return ingest.file_stats(checked, ingest.insert_flights(good, _existing(d)))


def _partition_stats(d: Data) -> DataFrame:
    stats = tables.partition_stats(d.spark, d.flights_path, YEARS)
    return stats.selectExpr("partition_name", "row_count", "total_bytes > 0 AS has_files")


def _upsert_airlines(d: Data) -> DataFrame:
    """Carriers seen in the raw flights replace their old row; the others keep it."""
    old = ingest.known_airlines(d.spark).selectExpr(
        "iata_code", "concat(name, ' (old)') AS name", "country"
    )
    return ingest.upsert(old, ingest.ingest_airlines(d.raw_flights))


def _with_flat_tokens(df: DataFrame) -> DataFrame:
    return df.select("iata_code", F.array_join("search_tokens", " ").alias("search_text"))


def _search_tokens_airports(d: Data) -> DataFrame:
    return _with_flat_tokens(ingest.airport_search_tokens(d.listed_airports))


def _search_tokens_airlines(d: Data) -> DataFrame:
    return _with_flat_tokens(ingest.airline_search_tokens(ingest.ingest_airlines(d.raw_flights)))


def _search_index(d: Data) -> DataFrame:
    return ingest.search_index(d.listed_airports, ingest.ingest_airlines(d.raw_flights))


def _delete_airports(d: Data) -> DataFrame:
    codes = d.airports.select("iata_code").unionByName(d.listed_airports.select("iata_code"))
    return ingest.delete_airports(codes.distinct(), d.flights)


def _partition_for_date(d: Data) -> DataFrame:
    shifted = d.flights.select(F.add_months("flight_date", 6).alias("flight_date")).distinct()
    return tables.partition_for_date(shifted, YEARS)


def _load_summary(d: Data) -> DataFrame:
    return tables.load_summary(d.airports, d.airlines, d.flights, d.audit)


def _insert_filtered(d: Data) -> DataFrame:
    return round_trips.insert_flights_filtered(d, _insertable(d), _existing(d)).drop("source_block")


CATALOG: dict[str, Query] = {
    # sources, sinks and tables
    "read_flights_csv": round_trips.read_flights_csv,
    "read_airports_csv": round_trips.read_airports_csv,
    "write_flights": round_trips.write_flights,
    "replace_month": round_trips.replace_month,
    "upsert_airports": _upsert_airports,
    "upsert_airlines": _upsert_airlines,
    "insert_flights": lambda d: _inserted(d).drop("source_block"),
    "insert_flights_filtered": _insert_filtered,
    "load_summary": _load_summary,
    "file_stats": _file_stats,
    "load_flights": round_trips.load_flights,
    "dry_run": lambda d: ingest.dry_run(d.raw_flights_once),
    "refresh_summaries": round_trips.refresh_summaries,
    "summary_counts": lambda d: tables.summary_counts(d.spark, d.summaries),
    "table_statistics": lambda d: round_trips.table_statistics(d).select(
        "column_name", "row_count", "null_count", "least", "greatest"),
    # estimates, which SQL cannot give alike; held against exact values in tests
    "table_sketches": lambda d: round_trips.table_statistics(d).drop("row_count", "null_count", "least", "greatest"),
    "partition_stats": _partition_stats,
    "partition_for_date": _partition_for_date,
    "partition_rows_footers": lambda d: footers.partition_rows(round_trips.footer_stats(d), YEARS),
    "month_distribution_footers": lambda d: footers.month_distribution(round_trips.footer_stats(d)),
    "count_year_footers": lambda d: footers.count_whole_months(round_trips.footer_stats(d), *YEAR),
    # ingest
    "ingest_flights": _ingest_flights,
    "ingest_constraints": _ingest_constraints,
    "ingest_airports": lambda d: d.listed_airports,
    "ingest_airlines": lambda d: ingest.ingest_airlines(d.raw_flights),
    "search_tokens_airports": _search_tokens_airports,
    "search_tokens_airlines": _search_tokens_airlines,
    "search_index": _search_index,
    "search_all_words": lambda d: round_trips.search(d, ["blue", "Brand"]),
    "search_any_word": lambda d: round_trips.search(d, ["hot", "air", "lines"], every=False),
    "search_prefix": lambda d: round_trips.search(d, ["brand", "b"], prefix=True),
    "delete_airports": _delete_airports,
    "deleted_airports": round_trips.deleted_airports,
    "delay_audit": _audit_without_stamp,
    # parameterised KPIs
    "airline_score": lambda d: kpi.airline_score(d.flights, "AA", *YEAR),
    "airline_ranking": lambda d: kpi.airline_ranking(d.flights, d.airlines, *YEAR),
    "delay_breakdown": lambda d: kpi.delay_breakdown(d.flights, "AA", *YEAR),
    "best_routes_between": lambda d: kpi.best_routes_between(
        d.flights, d.airlines, "JFK", "LAX", *YEAR
    ),
    "route_kpi": lambda d: kpi.route_kpi(d.flights, "JFK", "LAX", *YEAR),
    "data_quality_summary": lambda d: quality.data_quality_summary(d.flights, *YEAR),
    "invalid_airport_references": lambda d: quality.invalid_airport_references(
        d.flights, d.airports
    ),
    # views and summaries
    "v_airline_monthly_trend": lambda d: views.airline_monthly_trend(d.flights),
    "v_airline_daily_ops": lambda d: views.airline_daily_ops(d.flights),
    "v_route_risk_score": lambda d: views.route_risk_score(d.flights),
    "mv_airline_summary": lambda d: views.airline_summary(d.flights, d.airlines),
    "mv_delay_heatmap": lambda d: views.delay_heatmap(d.flights),
    "mv_top_routes": lambda d: views.top_routes(d.flights, d.airports),
    "mv_monthly_trend": lambda d: views.monthly_trend(d.flights, d.airlines),
    "mv_route_performance": lambda d: views.route_performance(d.flights, d.airlines),
    # window analytics
    "w1_monthly_rank": lambda d: windows.monthly_rank(d.flights, *YEAR),
    "w2_moving_avg": lambda d: windows.moving_averages(d.flights, *YEAR),
    "w3_delay_surge": lambda d: windows.delay_surges(d.flights, *YEAR),
    "w4_delay_distribution": lambda d: windows.delay_distribution(d.flights),
    "w5_running_total": lambda d: windows.running_totals(d.flights, *YEAR),
    "w6_vs_industry": lambda d: windows.airline_vs_industry(d.flights, *YEAR),
    # spatial analytics
    "g1_airport_distances": lambda d: spatial.hub_distances(d.flights, d.airports),
    "g2_busiest_routes": lambda d: spatial.busiest_routes(d.flights, d.airports),
    "g3_airports_within": lambda d: spatial.airports_within(d.flights, d.airports, *YEAR),
    "g3_airports_around_each": lambda d: spatial.airports_around_each(d.stored_airports),
    "g4_airport_clusters": lambda d: spatial.airport_clusters(
        d.flights, d.stored_airports, *YEAR, country=None
    ),
    "g5_short_route_delay": lambda d: spatial.short_route_delay(d.flights, d.airports, *YEAR),
    # quality checks
    "q1_out_of_range": lambda d: quality.out_of_range(d.flights),
    "q1_out_of_range_dirty": lambda d: quality.out_of_range(d.dirty_flights),
    "q2_duplicate_keys": lambda d: quality.duplicate_keys(d.flights),
    "q2_duplicate_keys_dirty": lambda d: quality.duplicate_keys(d.dirty_flights),
    "q3_month_distribution": lambda d: quality.month_distribution(d.flights),
    "q4_audit_coverage": lambda d: quality.audit_coverage(d.flights, d.audit),
    # repeated flights that the stored audit has not logged
    "q4_audit_coverage_dirty": lambda d: quality.audit_coverage(d.dirty_flights, d.audit),
    # saved queries
    "top_routes": lambda d: reports.top_routes(tables.read_summary(d.spark, d.summaries, "top_routes")),
    "top_routes_live": lambda d: reports.top_routes_live(d.flights, d.airports, 50),
    "ranking_top20": lambda d: reports.ranking_head(
        kpi.airline_ranking(d.flights, d.airlines, *YEAR)
    ),
    "trend_for": lambda d: reports.trend_for(views.airline_monthly_trend(d.flights), "AA"),
    "trend_for_carriers": lambda d: reports.trend_for_carriers(
        views.airline_monthly_trend(d.flights)
    ),
    "riskiest_routes": lambda d: reports.riskiest_routes(views.route_risk_score(d.flights)),
    "recent_daily_ops": lambda d: reports.recent_daily_ops(views.airline_daily_ops(d.flights)),
    "kpi_bands": lambda d: reports.kpi_bands(kpi.airline_score(d.flights, "AA", *YEAR)),
    "quality_flags": lambda d: reports.flag_quality_issues(
        quality.data_quality_summary(d.flights, *YEAR)
    ),
    "b_count_year": lambda d: reports.count_between(d.flights, *YEAR),
    "b_monthly_direct": lambda d: reports.monthly_delay(d.flights),
    "b_monthly_slice": lambda d: reports.monthly_slice(
        tables.read_summary(d.spark, d.summaries, "monthly_trend")
    ),
    # streams
    "stream_delay_audit": round_trips.stream_delay_audit,
    "stream_insert_flights": round_trips.stream_insert_flights,
    "stream_insert_recent": round_trips.stream_insert_recent,
    "stream_refresh": round_trips.stream_refresh,
    "stream_refresh_corrected": round_trips.stream_refresh_corrected,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return CATALOG[name](Data(spark, sf_dir))
