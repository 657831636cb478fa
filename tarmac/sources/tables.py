"""Parquet tables: month-partitioned flights and versioned small tables.

Large facts are partitioned by `flight_month` and changed by whole months. Small
tables and summaries are published as whole versions: a version is a new folder that
readers see once its job has committed, so a refresh never disturbs running readers
and a table can be rebuilt from its own current version.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.dates import DEFAULT_PARTITION, month_label
from tarmac.operators import views
from tarmac.operators.audit import delay_audit
from tarmac.operators.ingest import (
    SOURCE_COLUMNS,
    accepted,
    check_constraints,
    delete_airports as mark_deletable,
    insert_flights,
    upsert,
    with_flight_id,
)
from tarmac.operators.quality import BUSINESS_KEY
from tarmac.sources import files

FLIGHTS_SCHEMA = (
    "id BIGINT, flight_date DATE, airline_code STRING, flight_number STRING, origin STRING, "
    "destination STRING, dep_time STRING, dep_delay_min INT, arr_time STRING, "
    "arr_delay_min INT, cancelled BOOLEAN, diverted BOOLEAN, distance_miles INT, "
    "carrier_delay INT, weather_delay INT, nas_delay INT, security_delay INT, "
    "late_aircraft_delay INT, created_at TIMESTAMP, flight_month STRING"
)
AUDIT_SCHEMA = (
    "flight_id BIGINT, flight_date DATE, airline_code STRING, origin STRING, "
    "destination STRING, delay_minutes INT, delay_category STRING, logged_at TIMESTAMP, "
    "flight_month STRING"
)
FLIGHT_COLUMNS = tuple(part.split()[0] for part in FLIGHTS_SCHEMA.split(", "))
FIRST_YEAR, LAST_YEAR = 2000, 2100


# ---------------------------------------------------------------- month partitions


def check_years(years: Iterable[int]) -> list[int]:
    years = sorted(set(years))
    for year in years:
        if not FIRST_YEAR <= year <= LAST_YEAR:
            raise ValueError(f"invalid year {year}: only {FIRST_YEAR}-{LAST_YEAR} can be declared")
    return years


def _declared(years: Iterable[int]) -> str:
    listed = ", ".join(map(str, check_years(years)))
    return f"year(flight_date) IN ({listed})" if listed else "FALSE"


def with_partition(df: DataFrame, years: Iterable[int]) -> DataFrame:
    """Add `flight_month`: the month of a date in a declared year, else the default one."""
    month = f"CASE WHEN {_declared(years)} THEN {month_label('flight_date')} ELSE '{DEFAULT_PARTITION}' END"
    return df.withColumn("flight_month", F.expr(month))


def _as_flights(df: DataFrame) -> DataFrame:
    """Table columns in order; ids and load times are added where they are missing."""
    if "id" not in df.columns:
        df = with_flight_id(df)
    if "created_at" not in df.columns:
        df = df.withColumn("created_at", F.current_timestamp())
    return df.select(*FLIGHT_COLUMNS)


def _laid_out(df: DataFrame, gathered: bool = False) -> DataFrame:
    """One shuffle that gathers months into files of even size, sorted for row-group skipping.

    The rebalance hint lets adaptive execution split a month that is far larger than
    the others and merge small ones, so files stay even under skew. Rows that are `gathered`
    by month already are only sorted.
    """
    return (df if gathered else df.hint("rebalance", "flight_month")).sortWithinPartitions(
        "flight_month", *[c for c in ("airline_code", "flight_date") if c in df.columns]
    )


def write_flights(
    df: DataFrame, path: str, years: Iterable[int], mode: str = "append", gathered: bool = False
) -> None:
    """Route rows to the monthly partitions of the declared years, all others to default.

    Rows that come `gathered` by month are not shuffled again.
    """
    _write_months(_as_flights(with_partition(df, years)), path, mode, gathered)


def rebuild_audit(spark: SparkSession, flights: str, audit: str, months: Sequence[str]) -> None:
    """Write the audit rows of some months afresh from the flights table.

    Replacing whole months keeps flights and audit in step however often a load is
    repeated, and removes the audit rows of flights that were replaced.
    """
    picked = read_flights(spark, flights).filter(F.col("flight_month").isin(*months))
    _overwrite_months(delay_audit(picked, "flight_month"), audit)


def _write_months(rows: DataFrame, path: str, mode: str, gathered: bool = False) -> None:
    """`overwrite` replaces the whole table, whatever the session says of partitions."""
    (
        _laid_out(rows, gathered)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy("flight_month")
        .parquet(path)
    )


def append_months(rows: DataFrame, path: str) -> None:
    """Add rows with a `flight_month` to a table by month."""
    _write_months(rows, path, "append")


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """The schema is declared, so month names are never guessed to be dates."""
    return spark.read.schema(FLIGHTS_SCHEMA).parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def months_of(rows: DataFrame) -> list[str]:
    """Partitions a frame touches: at most twelve per declared year and the default one."""
    return [r[0] for r in rows.select("flight_month").distinct().collect()]


def new_flights(
    arriving: DataFrame, path: str, years: Iterable[int], order: Sequence[str] = SOURCE_COLUMNS
) -> DataFrame:
    """The arriving rows whose business key is new to the table.

    Only the partitions that the rows touch are compared.
    """
    spark = arriving.sparkSession
    rows = with_partition(arriving, check_years(years))
    if files.child_names(spark, path):
        touched = F.col("flight_month").isin(*months_of(rows))
        existing = read_flights(spark, path).filter(touched)
    else:
        existing = spark.createDataFrame([], FLIGHTS_SCHEMA)
    return insert_flights(rows, existing, order).drop("flight_month")


def append_new_flights(
    arriving: DataFrame, path: str, years: Iterable[int], order: Sequence[str] = SOURCE_COLUMNS
) -> None:
    """Append the rows whose business key is new; running it again adds nothing."""
    write_flights(new_flights(arriving, path, years, order), path, years)


def month_of_file(name: str) -> str:
    """`2023_01.csv` to `2023-01`; any other form is refused rather than clearing the table."""
    stem = name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    parts = stem.split("_")
    if len(parts) == 2 and all(p.isdigit() for p in parts) and 1 <= int(parts[1]) <= 12:
        return f"{int(parts[0]):04d}-{int(parts[1]):02d}"
    raise ValueError(f"no month in file name {name!r}")


def replace_month(
    new: DataFrame,
    path: str,
    file_name: str,
    years: Iterable[int],
    order: Sequence[str] = SOURCE_COLUMNS,
    audit_path: str | None = None,
    airlines: DataFrame | None = None,
    airports: DataFrame | None = None,
) -> None:
    """Replace the month a file is named after by the rows of that file.

    The month is replaced as a whole, also when the file has no row for it; rows of other
    months in the file are added like any insert. The audit table, if named, gets the same
    months replaced. With both dimensions given, rows that break a constraint stay out.
    """
    month = month_of_file(file_name)
    if airlines is not None and airports is not None:
        new = accepted(check_constraints(new, airlines, airports))
    replace_months(new.withColumn("_own_month", F.lit(month)), path, [month], years, order, audit_path)


def replace_months(
    new: DataFrame,
    path: str,
    months: Sequence[str],
    years: Iterable[int],
    order: Sequence[str] = SOURCE_COLUMNS,
    audit_path: str | None = None,
) -> DataFrame:
    """Replace whole months; `_own_month` of a row names the month that its file stands for.

    The input is read once, into a staged table, and the rows to write are staged before
    anything is replaced, so the input may be the table itself and a failed call can be
    repeated. Returns the rows written, with the other columns of `new`.
    """
    years = check_years(years)
    for month in months:
        if int(month[:4]) not in years:
            raise ValueError(f"month {month} is not in a declared year")
    spark, stage = new.sparkSession, f"{path.rstrip('/')}_staged"
    publish(with_partition(new, years), stage, "arrived")
    arrived = read_current(spark, stage, "arrived")
    is_own, replaced = F.expr("flight_month <=> _own_month"), F.col("flight_month").isin(*months)
    rest = arrived.filter(~is_own).drop("_own_month")
    nothing = spark.createDataFrame([], FLIGHTS_SCHEMA)
    own = insert_flights(arrived.filter(is_own).drop("_own_month"), nothing, order)
    publish(own, stage, "own")
    own = read_current(spark, stage, "own")
    known = own.select(*BUSINESS_KEY)
    if files.child_names(spark, path):
        touched = months_of(rest)
        stored = read_flights(spark, path).filter(~replaced & F.col("flight_month").isin(*touched))
        known = known.unionByName(stored.select(*BUSINESS_KEY))
    publish(own.unionByName(insert_flights(rest, known, order)), stage, "rows")
    rows = read_current(spark, stage, "rows")
    flights = _as_flights(rows)
    inside = flights.filter(replaced)
    _overwrite_months(inside, path)
    for month in set(months) - set(months_of(inside)):
        _overwrite_folder(nothing, f"{path}/flight_month={month}")
    _write_months(flights.filter(~replaced), path, "append")
    if audit_path is not None:
        rebuild_audit(spark, path, audit_path, months_of(rows))
        stored = read_flights(spark, path).filter(replaced)
        for month in set(months) - set(months_of(delay_audit(stored, "flight_month"))):
            _overwrite_folder(spark.createDataFrame([], AUDIT_SCHEMA), f"{audit_path}/flight_month={month}")
    for name in ("arrived", "own", "rows"):
        prune(spark, stage, name, keep=1)
    return rows


def _overwrite_months(rows: DataFrame, path: str) -> None:
    """Replace the months that the rows have, leaving the others."""
    (
        _laid_out(rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("flight_month")
        .parquet(path)
    )


def _overwrite_folder(rows: DataFrame, folder: str) -> None:
    _laid_out(rows).drop("flight_month").write.mode("overwrite").parquet(folder)


def partition_stats(spark: SparkSession, path: str, years: Iterable[int] = ()) -> DataFrame:
    """Exact rows and bytes per partition; months of declared years and the default are listed even if empty.

    File sizes are counted once per file: the per-file pre-aggregation sends one row
    per file and task.
    """
    by_file = (
        read_flights(spark, path)
        .groupBy("flight_month", F.expr("_metadata.file_path AS file"))
        .agg(F.expr("count(1) AS row_count"), F.expr("max(_metadata.file_size) AS file_bytes"))
    )
    found = by_file.groupBy(F.expr(f"{_partition_name('flight_month')} AS partition_name")).agg(
        F.expr("sum(row_count) AS row_count"), F.expr("sum(file_bytes) AS total_bytes")
    )
    declared = [f"flights_{y}_{m:02d}" for y in check_years(years) for m in range(1, 13)]
    names = spark.createDataFrame([(n,) for n in [*declared, f"flights_{DEFAULT_PARTITION}"]], "partition_name string")
    return names.join(found, "partition_name", "full").selectExpr(
        "partition_name", "coalesce(row_count, 0) AS row_count", "coalesce(total_bytes, 0) AS total_bytes"
    )


def _partition_name(month: str) -> str:
    return f"concat('flights_', translate({month}, '-', '_'))"


def partition_for_date(dates: DataFrame, years: Iterable[int]) -> DataFrame:
    """Add `partition_name` to a frame with `flight_date`; NULL for a NULL date."""
    own = _partition_name(month_label("flight_date"))
    missing = f"concat('flights_default (no partition has been created for ', {own}, ')')"
    return dates.selectExpr(
        *[f"`{c}`" for c in dates.columns],
        f"CASE WHEN {_declared(years)} THEN {own} ELSE {missing} END AS partition_name",
    )


# ---------------------------------------------------------------- versioned tables


def publish(df: DataFrame, root: str, name: str) -> str:
    """Write the next version of a table; it becomes current when its job commits."""
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    target = f"{root}/{name}/{version}"
    df.write.parquet(target)
    return target


def prune(spark: SparkSession, root: str, name: str, keep: int = 3) -> None:
    """Remove all but the newest `keep` committed versions of a table, and older unfinished ones.

    Readers of an older version fail then, so keep as many as refreshes can overlap with them.
    """
    versions = files.child_names(spark, f"{root}/{name}")
    committed = [v for v in versions if files.exists(spark, f"{root}/{name}/{v}/_SUCCESS")]
    if len(committed) > keep:
        oldest_kept = committed[-keep]
        for version in versions:
            if version < oldest_kept:
                files.delete(spark, f"{root}/{name}/{version}")


def current_path(spark: SparkSession, root: str, name: str) -> str | None:
    """Newest committed version, or None."""
    for version in reversed(files.child_names(spark, f"{root}/{name}")):
        if files.exists(spark, f"{root}/{name}/{version}/_SUCCESS"):
            return f"{root}/{name}/{version}"
    return None


def read_current(
    spark: SparkSession, root: str, name: str, schema: str | None = None
) -> DataFrame:
    path = current_path(spark, root, name)
    if path is None:
        raise FileNotFoundError(f"{root}/{name}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def upsert_table(new: DataFrame, root: str, name: str, key: str = "iata_code") -> None:
    """Insert or replace rows of a small table by key, as a new version."""
    path = current_path(new.sparkSession, root, name)
    old = new.sparkSession.read.parquet(path) if path else new.limit(0)
    publish(upsert(old, new, key), root, name)


def delete_airports(candidates: DataFrame, flights: DataFrame, root: str, name: str = "airports") -> DataFrame:
    """Delete the candidate codes that no flight uses from a dimension table, as a new version.

    Returns the codes that were refused, because flights use them.
    """
    marked = mark_deletable(candidates.select("iata_code").distinct(), flights)
    spark, stage = candidates.sparkSession, f"{root}/{name}_deletions"
    publish(marked, stage, "marked")
    marked = read_current(spark, stage, "marked")
    rest = read_current(spark, root, name).join(marked.filter("deletable").select("iata_code"), "iata_code", "left_anti")
    publish(rest, root, name)
    prune(spark, stage, "marked", keep=1)
    return marked.filter("NOT deletable").select("iata_code")


# ---------------------------------------------------------------- summaries

# Declared, so that opening a summary needs no look into its files.
SUMMARIES = {
    "airline_summary": "airline_code STRING, airline_name STRING, total_flights BIGINT, "
    "completed_flights BIGINT, cancelled_flights BIGINT, on_time_pct DOUBLE, "
    "avg_arr_delay_min DOUBLE, avg_dep_delay_min DOUBLE, cancellation_rate DOUBLE, "
    "severe_delay_count BIGINT, data_from DATE, data_to DATE",
    "delay_heatmap": "day_of_week INT, hour_of_day INT, flight_count BIGINT, "
    "avg_arr_delay DOUBLE, avg_dep_delay DOUBLE, delay_rate_pct DOUBLE",
    "top_routes": "origin STRING, destination STRING, origin_name STRING, dest_name STRING, "
    "origin_city STRING, dest_city STRING, origin_lon DOUBLE, origin_lat DOUBLE, "
    "dest_lon DOUBLE, dest_lat DOUBLE, total_flights BIGINT, completed_flights BIGINT, "
    "avg_arr_delay DOUBLE, avg_distance_miles DOUBLE, on_time_pct DOUBLE, "
    "cancellation_rate DOUBLE",
    "monthly_trend": "month DATE, airline_code STRING, airline_name STRING, "
    "total_flights BIGINT, avg_arr_delay DOUBLE, on_time_pct DOUBLE, "
    "cancellation_rate DOUBLE, total_carrier_delay_min BIGINT, total_weather_delay_min BIGINT, "
    "total_nas_delay_min BIGINT, total_late_aircraft_delay_min BIGINT",
    "route_performance": "origin STRING, destination STRING, airline_code STRING, "
    "airline_name STRING, total_flights BIGINT, avg_arr_delay DOUBLE, on_time_pct DOUBLE, "
    "cancellation_rate DOUBLE",
}


def refresh_summaries(
    flights: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    root: str,
    analyze: Sequence[str] = (),
) -> None:
    """Rebuild the five summary tables; optionally gather statistics of catalog tables.

    The flights are read twice in all: once for the heatmap, once for a measure table
    by month, airline and route, which the other four roll up from.
    """
    spark = flights.sparkSession
    publish(views.fine_measures(flights), root, "fine_measures")
    fine = read_current(spark, root, "fine_measures")
    publish(views.airline_summary_from(fine, airlines), root, "airline_summary")
    publish(views.delay_heatmap(flights), root, "delay_heatmap")
    publish(views.top_routes_from(fine, airports), root, "top_routes")
    publish(views.monthly_trend_from(fine, airlines), root, "monthly_trend")
    publish(views.route_performance_from(fine, airlines), root, "route_performance")
    for table in analyze:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def count_rows(tables: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.expr("count(1) AS row_count")).selectExpr(f"'{name}' AS {label}", "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


def summary_counts(spark: SparkSession, root: str) -> DataFrame:
    return count_rows({name: read_summary(spark, root, name) for name in SUMMARIES}, "summary_name")


def read_summary(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_current(spark, root, name, SUMMARIES[name])


def load_summary(
    airports: DataFrame, airlines: DataFrame, flights: DataFrame, audit: DataFrame
) -> DataFrame:
    """Rows per table, and of flights also per month (`month` is NULL in the table totals)."""
    by_month = flights.groupBy(F.expr(f"{month_label('flight_date')} AS month")).agg(
        F.expr("count(1) AS row_count")
    )
    flight_rows = by_month.rollup("month").agg(F.expr("sum(row_count) AS row_count"))
    others = count_rows({"airports": airports, "airlines": airlines, "delay_audit_log": audit})
    return flight_rows.selectExpr(
        "'flights' AS table_name", "month", "coalesce(row_count, 0) AS row_count"
    ).unionByName(others.selectExpr("table_name", "CAST(NULL AS STRING) AS month", "row_count"))
