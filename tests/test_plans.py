"""Physical plans: what is read, what is shuffled, and what never appears."""

import re

import pytest

from tarmac.operators import kpi, quality
from tarmac.plans.catalog import CATALOG

YEAR = ("2023-01-01", "2023-12-31")
READS_BACK = {
    "read_flights_csv", "read_airports_csv", "write_flights", "replace_month", "load_flights",
    "refresh_summaries", "stream_delay_audit", "stream_insert_flights", "stream_refresh",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CATALOG) - READS_BACK))
def test_no_cross_join_and_no_python_rows(data, name):
    plan = plan_of(CATALOG[name](data))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_ranking_reads_four_columns_of_the_months_in_range(data):
    plan = plan_of(kpi.airline_ranking(data.flights, data.airlines, "2023-03-01", "2023-04-30"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["airline_code", "arr_delay_min", "cancelled", "flight_date"]
    assert "flight_month" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "GreaterThanOrEqual(flight_date,2023-03-01)" in plan


def test_date_range_prunes_folders(data):
    df = kpi.airline_ranking(data.flights, data.airlines, "2023-03-01", "2023-04-30")
    df.collect()
    scan = [n for n in leaves(df._jdf.queryExecution().executedPlan()) if "Scan" in n.nodeName()][0]
    assert scan.metrics().apply("numPartitions").value() == 2


def leaves(node):
    if "AdaptiveSparkPlan" in node.nodeName():
        return leaves(node.executedPlan())
    if "QueryStage" in node.nodeName():
        return leaves(node.plan())
    children = [node.children().apply(i) for i in range(node.children().size())]
    return [node] if not children else [leaf for child in children for leaf in leaves(child)]


@pytest.mark.parametrize(
    ("report", "shuffles"),
    [
        ("airline_score", 1), ("route_kpi", 1), ("delay_breakdown", 1), ("mv_airline_summary", 1),
        ("mv_top_routes", 1), ("mv_monthly_trend", 1), ("mv_route_performance", 1), ("mv_delay_heatmap", 1),
        ("v_route_risk_score", 1), ("q1_out_of_range", 1), ("q2_duplicate_keys", 1),
        ("insert_flights", 4),  # three of them on the keys of the small dimensions
    ],
)
def test_one_scan_of_the_flights_and_one_shuffle(data, report, shuffles):
    plan = plan_of(CATALOG[report](data))
    hashed = len(re.findall(r"(?<!Broadcast)Exchange (?:hash|Single)", plan))
    assert hashed == shuffles
    if report != "insert_flights":
        assert plan.count("FileScan parquet") == 1


def test_orphans_meet_airports_after_the_count(data):
    plan = plan_of(quality.invalid_airport_references(data.flights, data.airports))
    assert plan.index("HashJoin") < plan.index("HashAggregate")


def test_shuffled_joins_when_a_dimension_is_too_large_to_broadcast(spark, data):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    broadcast = CATALOG["mv_top_routes"](data).collect()
    spark.conf.set(name, "-1")
    try:
        df = CATALOG["mv_top_routes"](data)
        assert "BroadcastExchange" not in plan_of(df) and "SortMergeJoin" in plan_of(df)
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, broadcast))
    finally:
        spark.conf.set(name, before)
