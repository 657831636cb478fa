"""Statistics of the stored flights from mergeable sketches, kept per month and column.

Distinct values are held by HyperLogLog sketches and quantiles by KLL sketches, both of Spark
itself. A month's sketches are made when the month is written; statistics of the table, or of
any months, merge them without reading a flight. A merged HyperLogLog sketch is the one that
the months' rows together would have given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources import files, tables

#: Logarithm of the HyperLogLog registers (a relative standard error of 1.04 / sqrt(2 ** 12), 1.6 %) and the
#: KLL size (a rank error of about 1.3 % at 99 % confidence).
REGISTERS, KLL_SIZE = 12, 200
QUANTILES = (0.25, 0.5, 0.75, 0.95)
NUMBERS = (
    "dep_delay_min", "arr_delay_min", "distance_miles", "carrier_delay", "weather_delay", "nas_delay",
    "security_delay", "late_aircraft_delay",
)
DAYS = ("flight_date",)
TEXTS = ("airline_code", "flight_number", "origin", "destination", "dep_time", "arr_time")
COLUMNS = (*NUMBERS, *DAYS, *TEXTS)
SCHEMA = (
    "column_name STRING, row_count BIGINT, null_count BIGINT, least BIGINT, greatest BIGINT, "
    "distinct_sketch BINARY, quantile_sketch BINARY, flight_month STRING"
)


def _number(column: str) -> str:
    return f"CAST({f'unix_date({column})' if column in DAYS else column} AS BIGINT)"


def month_sketches(flights: DataFrame) -> DataFrame:
    """A row per month and column. One pass; tasks send on a sketch a month and column, whatever a month holds."""
    made = ["count(1) AS row_count"]
    for c in COLUMNS:
        counted = c if c in TEXTS else _number(c)
        made += [f"count({c}) AS {c}_n", f"hll_sketch_agg({counted}, {REGISTERS}) AS {c}_d"]
        if c not in TEXTS:
            made += [f"min({counted}) AS {c}_lo", f"max({counted}) AS {c}_hi", f"kll_sketch_agg_bigint({counted}, {KLL_SIZE}) AS {c}_q"]
    wide = flights.groupBy("flight_month").agg(*[F.expr(x) for x in made])
    rows = [
        f"'{c}', row_count, row_count - {c}_n, "
        + (f"CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), {c}_d, CAST(NULL AS BINARY)" if c in TEXTS else f"{c}_lo, {c}_hi, {c}_d, {c}_q")
        for c in COLUMNS
    ]
    names = ", ".join(part.split()[0] for part in SCHEMA.split(", ")[:-1])
    return wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})", "flight_month")


def refresh_statistics(spark: SparkSession, path: str, root: str, months: Sequence[str] | None = None) -> None:
    """Sketch some months of a flights table (None: all) afresh; months without rows lose theirs."""
    flights = tables.read_flights(spark, path)
    if months is not None:
        flights = flights.filter(F.col("flight_month").isin(*months))
    made = month_sketches(flights)
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("flight_month").parquet(root)
    stored = {name.split("=", 1)[1] for name in files.child_names(spark, root) if name.startswith("flight_month=")}
    for month in stored & set(months if months is not None else stored):
        if flights.filter(F.col("flight_month") == month).isEmpty():
            files.delete(spark, f"{root}/flight_month={month}")


def read_sketches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(root)


def table_statistics(sketches: DataFrame) -> DataFrame:
    """Per column, of all months given: rows, nulls, least and greatest number (days since 1970 of dates), exactly;
    distinct values and quantiles as the merged sketches estimate them (NULL for texts, and without values)."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.expr("hll_sketch_estimate(hll_union_agg(distinct_sketch))").alias("distinct_estimate"),
        F.expr("kll_merge_agg_bigint(CASE WHEN least IS NOT NULL THEN quantile_sketch END)").alias("_quantiles"),
    )
    return merged.select(
        "column_name", "row_count", "null_count", "least", "greatest", "distinct_estimate",
        *[F.expr(f"CASE WHEN least IS NOT NULL THEN kll_sketch_get_quantile_bigint(_quantiles, {q}D) END").alias(f"q{round(100 * q)}")
          for q in QUANTILES])
