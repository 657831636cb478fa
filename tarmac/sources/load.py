"""The whole load of monthly flight files, restartable at any point."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import ingest
from tarmac.sources import csv, tables


def load_flight_files(
    spark: SparkSession,
    paths: list[str],
    root: str,
    airlines: DataFrame,
    airports: DataFrame,
    years: Iterable[int],
    replace: bool = False,
) -> DataFrame:
    """Load CSV files into `root/flights` and `root/audit`; return the rows per file.

    The text is parsed and checked once, into a staged table that also keeps the
    skipped and rejected rows with their reasons; what is new is staged before it is
    appended. A load that died half-way is simply run again: rows already stored are
    ignored as duplicates, and the touched audit months are rebuilt from the flights.
    Files without the required columns are reported with one error and no rows.

    With `replace`, the month that each file is named after is replaced by the file's rows;
    rows of other months are added as new. Staged tables of earlier loads are removed.
    """
    years = list(years)
    groups, unusable = csv.split_by_columns(spark, paths)
    usable = [path for group in groups.values() for path in group]
    report = _unusable_report(spark, unusable)
    if not usable:
        return report

    parsed = ingest.parse_flights(csv.read_flights_csv(spark, usable))
    tables.publish(
        ingest.check_constraints(parsed, airlines, airports), root, "staged_checked"
    )
    checked = tables.read_current(spark, root, "staged_checked")
    good = ingest.accepted(checked.filter("is_valid")).drop("is_valid")
    if replace:
        months = {path.rsplit("/", 1)[-1]: tables.month_of_file(path) for path in usable}
        named = F.create_map(*[F.lit(x) for pair in months.items() for x in pair])
        new = tables.replace_months(
            good.withColumn("_own_month", named[F.col("source_file")]),
            f"{root}/flights", sorted(set(months.values())), years, audit_path=f"{root}/audit",
        )
        tables.prune(spark, root, "staged_checked", keep=1)
        return ingest.file_stats(checked, new).unionByName(report)
    tables.publish(tables.new_flights(good, f"{root}/flights", years), root, "staged_new")
    new = tables.read_current(spark, root, "staged_new")
    tables.write_flights(new, f"{root}/flights", years)
    touched = tables.months_of(tables.with_partition(good, years))
    tables.rebuild_audit(spark, f"{root}/flights", f"{root}/audit", touched)
    for name in ("staged_checked", "staged_new"):
        tables.prune(spark, root, name, keep=1)
    return ingest.file_stats(checked, new).unionByName(report)


def _unusable_report(spark: SparkSession, paths: list[str]) -> DataFrame:
    names = [(path.rsplit("/", 1)[-1],) for path in paths]
    files = spark.createDataFrame(names, "source_file string")
    zero = lambda name: F.lit(0).cast("bigint").alias(name)
    return files.select(
        "source_file",
        zero("total_rows"),
        zero("inserted"),
        zero("skipped"),
        F.lit(1).cast("bigint").alias("errors"),
    )


def load_all(
    spark: SparkSession,
    listing: str,
    paths: list[str],
    root: str,
    years: Iterable[int],
    replace: bool = False,
) -> DataFrame:
    """Listing and flight files to refreshed summaries, as one restartable call.

    Airports and airlines are put in, flights loaded (see `load_flight_files`), the summaries
    refreshed; the report per file is kept as table `load_report`. Returns the load summary.
    """
    years = list(years)
    listed = ingest.ingest_airports(csv.read_airports_csv(spark, listing))
    tables.upsert_table(ingest.airport_search_tokens(listed), root, "airports")
    tables.upsert_table(ingest.ingest_airlines(csv.read_carriers_csv(spark, paths)), root, "airlines")
    airports, airlines = (tables.read_current(spark, root, name) for name in ("airports", "airlines"))
    report = load_flight_files(spark, paths, root, airlines, airports, years, replace)
    tables.publish(report, root, "load_report")
    flights = tables.read_flights(spark, f"{root}/flights")
    tables.refresh_summaries(flights, airlines, airports, root)
    for name in ("airports", "airlines", "load_report", "fine_measures", *tables.SUMMARIES):
        tables.prune(spark, root, name)
    return tables.load_summary(airports, airlines, flights, tables.read_audit(spark, f"{root}/audit"))
