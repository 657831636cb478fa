"""Time the headline queries; prints one JSON line.

Method: the flights are loaded once (timed as `load`), every query then runs once to
warm up and is timed over three runs, of which the mean counts. Queries are executed in
full (results go to the no-op sink), not merely planned. Two more entries answer the
published figures for the airline summary: `airline_summary_7m`, the direct aggregate over
seven million flights (the loaded ones repeated under other numbers), and `airline_summary_stored`, the same
result collected from the stored summary table.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from tarmac.operators import views
from tarmac.plans.catalog import CATALOG
from tarmac.plans.data import YEARS, Data
from tarmac.session import build_session
from tarmac.sources import tables

RUNS = 3
PUBLISHED_ROWS = 7_000_000
# Each of these performs a load, a refresh or a stream per call: timed once, after the rest.
ONCE = (
    "load_flights", "refresh_summaries", "stream_delay_audit", "stream_insert_flights",
    "stream_refresh", "read_flights_csv", "read_airports_csv", "write_flights", "replace_month",
    "g4_airport_clusters",
)
SKIPPED = ("q1_out_of_range_dirty", "q2_duplicate_keys_dirty", "q4_audit_coverage_dirty")


def execute(name: str, data: Data) -> float:
    start = time.perf_counter()
    CATALOG[name](data).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(action: Callable[[], object]) -> float:
    """Mean of the runs after one warm-up."""
    action()
    start = time.perf_counter()
    for _ in range(RUNS):
        action()
    return (time.perf_counter() - start) / RUNS


def airline_summary_times(data: Data, rows: int) -> dict[str, float]:
    copies = -(-PUBLISHED_ROWS // max(rows, 1))
    numbered = data.plain_flights.selectExpr("*", f"explode(sequence(1, {copies})) AS copy")
    repeated = numbered.selectExpr(
        "* EXCEPT (id, flight_number)", f"id * {copies} + copy AS id", "concat(flight_number, '-', copy) AS flight_number"
    )
    path = f"{data.root}/repeated"
    tables.write_flights(repeated, path, YEARS, mode="overwrite")
    root = f"{data.root}/stored"
    tables.publish(views.airline_summary(data.flights, data.airlines), root, "airline_summary")

    def direct() -> None:
        flights = tables.read_flights(data.spark, path)
        views.airline_summary(flights, data.airlines).collect()

    return {
        "airline_summary_7m": timed(direct),
        "airline_summary_stored": timed(
            lambda: tables.read_summary(data.spark, root, "airline_summary").collect()
        ),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or [n for n in CATALOG if n not in SKIPPED]
    spark = build_session(
        "tarmac-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    data = Data(spark, sf_dir)
    start = time.perf_counter()
    rows = data.flights.count()
    times = {"load": time.perf_counter() - start}
    for name in names:
        if name in ONCE:
            continue
        times[name] = timed(lambda: execute(name, data))
    for name in names:
        if name in ONCE:
            times[name] = execute(name, data)
    if not sys.argv[1:]:
        times |= airline_summary_times(data, rows)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 4) for name, t in times.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "flight_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
