"""Structured Streaming jobs over the flights as they arrive.

Each job can be stopped and started again from its checkpoint: all do only steps that
give the same table when a batch is replayed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions import measures as m
from tarmac.functions.dates import MONTH
from tarmac.operators.audit import delay_audit
from tarmac.operators import views
from tarmac.sources import files, tables

AUDIT_KEY = ["flight_id", "flight_date", "airline_code", "origin", "destination", "delay_minutes", "flight_month"]


def flight_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of a flights folder, in micro-batches of bounded size."""
    return (
        spark.readStream.schema(tables.FLIGHTS_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_delay_audit(flights: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Audit rows of every arriving flight, added by month to an audit table in the batch layout.

    Rows that the table has already are left out, NULLs being equal, and rows that repeat each
    other count once, in one batch like in two. So a replayed batch adds nothing, and the table
    can be read, rebuilt and replaced by month like one that a load wrote. A batch is evaluated
    once, into a staged table.
    """
    stage = f"{sink.rstrip('/')}_staged"

    def add(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        tables.publish(delay_audit(batch, "flight_month").dropDuplicates(AUDIT_KEY), stage, "batch")
        rows = tables.read_current(spark, stage, "batch")
        if files.child_names(spark, sink):
            touched = F.col("flight_month").isin(*tables.months_of(rows))
            rows, logged = rows.alias("r"), tables.read_audit(spark, sink).filter(touched).alias("l")
            same = F.lit(True)
            for key in AUDIT_KEY:
                same &= F.col(f"r.{key}").eqNullSafe(F.col(f"l.{key}"))
            rows = rows.join(logged, same, "left_anti")
        tables.append_months(rows, sink)
        tables.prune(spark, stage, "batch", keep=1)

    return (
        flights.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_insert_flights(
    flights: DataFrame,
    table: str,
    checkpoint: str,
    years: Iterable[int],
    order: tuple[str, ...] = ("id",),
) -> StreamingQuery:
    """Insert arriving flights unless their business key is already in the table.

    Each batch is compared with the stored months it touches, so lateness has no
    limit and no state grows with time; a replayed batch finds its own rows there. A batch is
    evaluated once, into a staged table, or into the table itself while that holds nothing to
    compare it with.
    """
    years, stage = list(years), f"{table.rstrip('/')}_staged"

    def insert(batch: DataFrame, _batch_id: int) -> None:
        if not files.child_names(batch.sparkSession, table):
            tables.append_new_flights(batch.drop("flight_month"), table, years, order)
            return
        tables.publish(batch.drop("flight_month"), stage, "batch")
        tables.append_new_flights(tables.read_current(batch.sparkSession, stage, "batch"), table, years, order)
        tables.prune(batch.sparkSession, stage, "batch", keep=1)

    return (
        flights.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _fine(flights: DataFrame) -> DataFrame:
    """The grain that four summaries roll up from."""
    return m.measures(flights, ["flight_month", MONTH, "airline_code", "origin", "destination"])


def _cells(flights: DataFrame) -> DataFrame:
    return views.heatmap_cells(flights, "flight_month")


#: Measure tables of a stream: name and the measures of a batch.
MEASURE_TABLES = {"fine": _fine, "cells": _cells}
#: Stands for a batch number where a month was computed as a whole.
WHOLE_MONTH = -1


def _write_measures(flights: DataFrame, root: str, batch_id: int) -> None:
    for name, measured in MEASURE_TABLES.items():
        (
            measured(flights)
            .withColumn("batch", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("flight_month", "batch")
            .parquet(f"{root}/{name}")
        )


def stream_refresh(arrivals: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep additive measures up to date with arriving flights, enough for all five summaries.

    A batch is read for its own sums only, which are stored by month and batch number: a
    replayed batch overwrites itself, and no stored flight is read again. Sums and counts are
    stored, never rounded ratios; readers roll them up. `recompute_months` folds a month into
    one part, and follows a month that was replaced.
    """
    return (
        arrivals.writeStream.foreachBatch(lambda batch, n: _write_measures(batch, root, n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def recompute_months(spark: SparkSession, table: str, root: str, months: Iterable[str]) -> None:
    """Measures of whole months from the flights table, in place of those by batch.

    Run it while the stream stands still and has taken all that the table holds of the months.
    """
    months = list(months)
    stored = tables.read_flights(spark, table).filter(F.col("flight_month").isin(*months))
    for name in MEASURE_TABLES:
        for month in months:
            files.delete(spark, f"{root}/{name}/flight_month={month}")
    _write_measures(stored, root, WHOLE_MONTH)


def read_measures(spark: SparkSession, root: str, name: str = "fine") -> DataFrame:
    measured = MEASURE_TABLES[name](spark.createDataFrame([], tables.FLIGHTS_SCHEMA))
    schema = measured.withColumn("batch", F.lit(0).cast("bigint")).schema
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def live_summaries(spark: SparkSession, root: str, airlines: DataFrame, airports: DataFrame) -> dict[str, DataFrame]:
    """The five summaries as the stream has them now."""
    fine = read_measures(spark, root)
    return {
        "airline_summary": views.airline_summary_from(fine, airlines),
        "delay_heatmap": views.delay_heatmap_from(read_measures(spark, root, "cells")),
        "top_routes": views.top_routes_from(fine, airports),
        "monthly_trend": views.monthly_trend_from(fine, airlines),
        "route_performance": views.route_performance_from(fine, airlines),
    }
