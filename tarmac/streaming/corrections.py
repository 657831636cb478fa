"""Summaries kept up to date under corrections, by signed deltas.

A change is a flight with a sign: +1 enters, -1 leaves. A replaced flight leaves with its old
values and enters with its new ones. Sums and counts of signed changes are the measures of what
is left. First and last dates cannot be taken back like that; they come from counted cells, one
per airline and day, of which those with a positive count remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions import measures as m
from tarmac.functions.dates import MONTH
from tarmac.operators import views
from tarmac.operators.quality import BUSINESS_KEY
from tarmac.sources import tables

CHANGES_SCHEMA = f"{tables.FLIGHTS_SCHEMA}, sign INT"
FINE, CELL = ("month", "airline_code", "origin", "destination"), views.CELL
_DATES = ("first_date", "last_date")


def entering(flights: DataFrame) -> DataFrame:
    return flights.withColumn("sign", F.lit(1))


def leaving(flights: DataFrame) -> DataFrame:
    return flights.withColumn("sign", F.lit(-1))


def corrections(new: DataFrame, stored: DataFrame) -> DataFrame:
    """The changes by which each new row replaces the stored rows of its business key, NULLs equal."""
    n, s = new.select(*BUSINESS_KEY).distinct().alias("n"), stored.alias("s")
    same = F.lit(True)
    for key in BUSINESS_KEY:
        same &= F.col(f"s.{key}").eqNullSafe(F.col(f"n.{key}"))
    return leaving(s.join(n, same, "left_semi")).unionByName(entering(new), allowMissingColumns=True)


def month_replacement(new: DataFrame, stored: DataFrame, month: str) -> DataFrame:
    """The changes by which all stored rows of a month make way for new ones."""
    return leaving(stored.filter(F.col("flight_month") == month)).unionByName(entering(new), allowMissingColumns=True)


def _signed(measured: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    sums = [f"sign * {name} AS {name}" for name in m.MEASURES if name not in _DATES]
    return measured.selectExpr("flight_month", *keys, *sums, *[f"CAST(NULL AS DATE) AS {name}" for name in _DATES])


def _fine(changes: DataFrame) -> DataFrame:
    return _signed(m.measures(changes, ["flight_month", "sign", MONTH, *FINE[1:]]), FINE)


def _cells(changes: DataFrame) -> DataFrame:
    return _signed(views.heatmap_cells(changes, "flight_month", "sign"), CELL)


def _days(changes: DataFrame) -> DataFrame:
    return changes.groupBy("flight_month", "airline_code", "flight_date").agg(F.sum("sign").alias("flights"))


TABLES = {"fine": _fine, "cells": _cells, "days": _days}


def stream_corrections(changes: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep signed sums of arriving changes, by month and batch.

    A batch is read for its own sums only; one that comes again overwrites itself, month by
    month. Neither a stored flight nor an earlier sum is read, whatever is replaced.
    """

    def write(batch: DataFrame, n: int) -> None:
        for name, measured in TABLES.items():
            (
                measured(batch).withColumn("batch", F.lit(n).cast("bigint"))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("flight_month", "batch").parquet(f"{root}/{name}")
            )

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    measured = TABLES[name](spark.createDataFrame([], CHANGES_SCHEMA))
    return spark.read.schema(measured.withColumn("batch", F.lit(0).cast("bigint")).schema).parquet(f"{root}/{name}")


def _left(spark: SparkSession, root: str, name: str, keys: tuple[str, ...]) -> DataFrame:
    """Sums over all batches, without the groups that nothing is left of."""
    return m.roll_up(_read(spark, root, name), keys).filter("total_flights > 0")


def corrected_summaries(spark: SparkSession, root: str, airlines: DataFrame, airports: DataFrame) -> dict[str, DataFrame]:
    """The five summaries of the flights that are left after all changes."""
    fine = _left(spark, root, "fine", FINE)
    days = _read(spark, root, "days").groupBy("airline_code", "flight_date").agg(F.sum("flights").alias("flights")).filter("flights > 0")
    dates = days.groupBy("airline_code").agg(F.min("flight_date").alias("data_from"), F.max("flight_date").alias("data_to"))
    of_airlines = views.airline_summary_from(fine, airlines).drop("data_from", "data_to").alias("a")
    of_airlines = of_airlines.join(dates.alias("d"), F.expr("a.airline_code <=> d.airline_code"), "left").select("a.*", "data_from", "data_to")
    return {
        "airline_summary": of_airlines,
        "delay_heatmap": views.delay_heatmap_from(_left(spark, root, "cells", CELL)),
        "top_routes": views.top_routes_from(fine, airports),
        "monthly_trend": views.monthly_trend_from(fine, airlines),
        "route_performance": views.route_performance_from(fine, airlines),
    }
