"""Counts and date ranges of stored flights from file footers alone.

Spark's second Parquet source answers count, min and max, by partition columns too, from the
row-group statistics in the footers, so that no column is read and what is read does not
depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.dates import DEFAULT_PARTITION
from tarmac.sources import tables

#: Settings under which a Parquet scan takes the aggregate over.
PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
STATS_SCHEMA = "flight_month STRING, row_count BIGINT, first_date DATE, last_date DATE"


def month_aggregates(spark: SparkSession, path: str) -> DataFrame:
    """Rows, first and last date by stored month; planned from footers while PUSHED is set."""
    return tables.read_flights(spark, path).groupBy("flight_month").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("flight_date").alias("first_date"), F.max("flight_date").alias("last_date"))


def footer_stats(spark: SparkSession, path: str) -> DataFrame:
    """Rows, first and last date of each stored month: at most twelve rows a declared year and the default one.

    The plan is checked: if the files cannot answer (no statistics, another format), this raises
    rather than reading the table.
    """
    before = {name: spark.conf.get(name, None) for name in PUSHED}
    try:
        for name, value in PUSHED.items():
            spark.conf.set(name, value)
        found = month_aggregates(spark, path)
        plan = found._jdf.queryExecution().executedPlan().toString()
        if "PushedAggregation: [COUNT" not in plan:
            raise RuntimeError("the footers cannot answer: " + plan)
        rows = found.collect()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.createDataFrame([tuple(r) for r in rows], STATS_SCHEMA)


def partition_rows(stats: DataFrame, years: Iterable[int] = ()) -> DataFrame:
    """Rows per partition from footer statistics; months of declared years and the default are listed even if empty."""
    spark = stats.sparkSession
    names = [f"{y}-{m:02d}" for y in tables.check_years(years) for m in range(1, 13)] + [DEFAULT_PARTITION]
    every = spark.createDataFrame([(n,) for n in names], "flight_month string")
    return every.join(stats, "flight_month", "full").selectExpr(
        f"{tables._partition_name('flight_month')} AS partition_name", "coalesce(row_count, 0) AS row_count", "first_date", "last_date")


def month_distribution(stats: DataFrame) -> DataFrame:
    """Flights per month label, as the quality check of that name has them; for tables without a default partition."""
    return stats.filter(F.col("flight_month") != DEFAULT_PARTITION).select(F.col("flight_month").alias("month"), "row_count")


def count_whole_months(stats: DataFrame, start: str, end: str) -> DataFrame:
    """Flights from start to end, if each stored month lies in the range or outside of it; raises otherwise."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = (F.col("first_date") >= first) & (F.col("last_date") <= last)
    outside = (F.col("first_date") > last) | (F.col("last_date") < first)
    return stats.agg(
        F.coalesce(F.sum(F.when(inside, F.col("row_count")).when(
            outside, F.lit(0)).otherwise(F.raise_error(F.concat(F.lit("only part of it is asked for: "), "flight_month")))),
            F.lit(0)).alias("flight_count"))
