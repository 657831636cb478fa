"""The tables a query runs on, derived from one folder of test tables."""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.parsing import missing_to_null
from tarmac.operators.ingest import (
    RAW_FLIGHT_COLUMNS,
    check_constraints,
    ingest_airlines,
    ingest_airports,
    parse_flights,
    upsert,
)
from tarmac.plans import fixtures
from tarmac.plans.workdir import work_root
from tarmac.sources import files
from tarmac.sources.tables import (
    FLIGHT_COLUMNS,
    SUMMARIES,
    current_path,
    months_of,
    publish,
    read_audit,
    read_current,
    read_flights,
    rebuild_audit,
    refresh_summaries,
    write_flights,
)

YEARS = (2023,)
YEAR = ("2023-01-01", "2023-12-31")

_lock = threading.RLock()


class Data:
    """Lazy access to the derived tables.

    The large tables, `flights` and its raw text, are stored once per application (the
    flights partitioned by month), as a data load would, and every query then scans them
    with its own columns, filters and months. No Spark cache is kept, and what is stored
    survives lost executors.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        tag = hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:10]
        self.root = f"{work_root(spark)}/{tag}"

    def _sql(self, text: str, **views: DataFrame) -> DataFrame:
        sql = fixtures.spark_sql(text, self.sf_dir).replace('"', "`")
        for name in views:
            sql = sql.replace(f"FROM {name}", "FROM {" + name + "}")
        return self.spark.sql(sql, **views) if views else self.spark.sql(sql)

    def derive_flights(self, gathered: bool = True) -> DataFrame:
        """Gathered by month while a row is still a few numbers; its texts are made after the shuffle."""
        base = self._sql(fixtures.FLIGHTS_BASE.replace(fixtures.JOINS, fixtures.SPARK_JOINS))
        if gathered:
            base = base.withColumn("month", F.expr(f"trunc({fixtures.SPARK_DATE}, 'MM')")).hint("rebalance", "month")
        return self._sql(f"WITH {fixtures.FLIGHTS_TIMED}", base=base)

    @property
    def flights_path(self) -> str:
        path = f"{self.root}/flights"
        with _lock:
            if not files.exists(self.spark, f"{path}/_SUCCESS"):
                write_flights(self.derive_flights(), path, YEARS, mode="overwrite", gathered=True)
        return path

    @property
    def flights(self) -> DataFrame:
        return read_flights(self.spark, self.flights_path)

    @property
    def plain_flights(self) -> DataFrame:
        """Flights without load-time columns, to compare or combine with raw input."""
        return self.flights.drop("created_at", "flight_month")

    @property
    def airports(self) -> DataFrame:
        return self._sql(fixtures.AIRPORTS)

    @property
    def airlines(self) -> DataFrame:
        return self._sql(fixtures.AIRLINES)

    @property
    def audit(self) -> DataFrame:
        """The stored audit table, written once from the flights as a load does.

        Months are overwritten one by one, which leaves no mark of success, so it is marked here.
        """
        path, mark = f"{self.root}/audit", f"{self.root}/audit_stored"
        with _lock:
            if not files.exists(self.spark, mark):
                rebuild_audit(self.spark, self.flights_path, path, months_of(self.flights))
                files.make_folder(self.spark, mark)
        return read_audit(self.spark, path)

    @property
    def summaries(self) -> str:
        """Folder of the five stored summaries, refreshed once."""
        root = f"{self.root}/summaries"
        with _lock:
            if current_path(self.spark, root, list(SUMMARIES)[-1]) is None:
                refresh_summaries(self.flights, self.airlines, self.airports, root)
        return root

    @property
    def checked_flights(self) -> DataFrame:
        """Every raw row, parsed and checked against the ingested dimensions; staged once, as a load does."""
        with _lock:
            if current_path(self.spark, self.root, "staged_checked") is None:
                parsed = parse_flights(self.raw_flights)
                publish(check_constraints(parsed, self.loaded_airlines, self.airports), self.root, "staged_checked")
        return read_current(self.spark, self.root, "staged_checked")

    @property
    def upserted_airports(self) -> DataFrame:
        """The fixed airports with the listing put in."""
        return upsert(self.airports, self.listed_airports.select(*self.airports.columns))

    @property
    def stored_airports(self) -> DataFrame:
        """The upserted airports as a stored table, for what reads them again and again."""
        with _lock:
            if current_path(self.spark, self.root, "airports") is None:
                publish(self.upserted_airports, self.root, "airports")
        return read_current(self.spark, self.root, "airports")

    @property
    def dirty_flights(self) -> DataFrame:
        return self._sql(fixtures.DIRTY_FLIGHTS, flights=self.plain_flights)

    def _raw_text(self, flights: DataFrame) -> DataFrame:
        return self._sql(fixtures.RAW_FLIGHTS.replace(fixtures.COPIES, fixtures.SPARK_COPIES), flights=flights)

    @property
    def raw_flights_text(self) -> DataFrame:
        """Raw rows as they stand in a file, missing-value marks included.

        Made from the stored flights by whoever reads them, in one scan and only the columns asked for:
        storing the texts would take several times what making them again does.
        """
        return self._raw_text(self.plain_flights)

    @staticmethod
    def _missing_to_null(raw: DataFrame) -> DataFrame:
        return raw.selectExpr(
            *[f"{missing_to_null(c)} AS {c}" if c in RAW_FLIGHT_COLUMNS else c for c in raw.columns]
        )

    @property
    def raw_flights(self) -> DataFrame:
        return self._missing_to_null(self.raw_flights_text)

    @property
    def raw_flights_once(self) -> DataFrame:
        """The raw flights for a query that reads them once and no flights beside: none are stored for it."""
        if files.exists(self.spark, f"{self.root}/flights/_SUCCESS"):
            return self.raw_flights
        return self._missing_to_null(self._raw_text(self.derive_flights(gathered=False)))

    @property
    def loaded_airlines(self) -> DataFrame:
        """The carriers of the raw flights as a stored table, loaded before the flights.

        Stored, its size is known, so checks against it need not shuffle the flights.
        """
        with _lock:
            if current_path(self.spark, self.root, "airlines") is None:
                publish(ingest_airlines(self.raw_flights), self.root, "airlines")
        return read_current(self.spark, self.root, "airlines")

    @property
    def raw_airports_text(self) -> DataFrame:
        return self._sql(fixtures.RAW_AIRPORTS)

    @property
    def raw_airports(self) -> DataFrame:
        raw = self.raw_airports_text
        return raw.selectExpr(*[f"{missing_to_null(c)} AS {c}" for c in raw.columns])

    @property
    def listed_airports(self) -> DataFrame:
        """The airport table ingested from the listing; grows with the input."""
        return ingest_airports(self.raw_airports)


__all__ = ["Data", "FLIGHT_COLUMNS", "YEAR", "YEARS"]
