"""Insert of arriving flights by event time: keyed state that expires, and a table of late rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.operators.ingest import SORTED_KEY, insert_flights
from tarmac.operators.quality import BUSINESS_KEY
from tarmac.session import settings
from tarmac.sources import files, tables

DAY_SECONDS = 86_400
SCHEMA = f"{tables.FLIGHTS_SCHEMA}, batch BIGINT"
#: State in RocksDB on the executors' disks: the window's keys need not fit into their heaps.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a stream that starts again copies files of sorted keys, and need not put all changes once more
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    # one bound for all stores of an executor, however many partitions it holds
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # counting the keys would read each one again when it is put or removed; the state itself can be read to count them
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # many small stores would each set megabytes of disk aside
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def _seconds() -> Column:
    """Event time: the flight date's midnight, in no time zone."""
    return F.unix_date("flight_date").cast("long") * DAY_SECONDS


def _write(rows: DataFrame, path: str, years: list[int], batch: int) -> None:
    """One part of each month for a batch; a batch that comes again overwrites its own."""
    if "created_at" not in rows.columns:
        rows = rows.withColumn("created_at", F.current_timestamp())
    (
        tables.with_partition(rows.drop("flight_month"), years).select(*tables.FLIGHT_COLUMNS)
        .withColumn("batch", F.lit(batch).cast("long"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("flight_month", "batch").parquet(path)
    )


def _read(spark: SparkSession, path: str) -> DataFrame:
    if not files.child_names(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def stream_insert_recent(
    flights: DataFrame,
    root: str,
    checkpoint: str,
    years: Iterable[int],
    delay_days: int = 31,
    order: tuple[str, ...] = ("id",),
) -> StreamingQuery:
    """Insert arriving flights unless their business key came before; what comes too late is kept apart.

    Keys are remembered until the watermark, `delay_days` behind the latest flight date seen,
    has passed their date, so the state holds a window of time and not the table. As the date is
    part of the key, whatever repeats a forgotten key is behind the watermark itself. Such rows
    go to the `late` table, if neither table has their key; only their months are read for it.
    Rows without a date are late too. `flights` and `late` together hold just what comparing
    every batch with the whole table would have stored.

    Each batch is evaluated once, into a staged table; of rows of one key that arrive together
    the first by `order` is taken. What is behind the watermark has no key in the state, so only
    the other rows are grouped for it. Every step writes parts named after the batch, so a batch
    that comes again overwrites itself. Batches without rows, in which keys are forgotten, end there.
    """
    years, spark = tables.check_years(years), flights.sparkSession
    # the state tells which keys are new, the batch's own rows which row of such a key to take
    first = (
        flights.filter("flight_date IS NOT NULL").withColumn("_time", F.timestamp_seconds(_seconds()))
        .withWatermark("_time", f"{delay_days} days").dropDuplicatesWithinWatermark(list(BUSINESS_KEY))
        .select(*BUSINESS_KEY, F.lit(True).alias("_first"))
    )
    both = flights.drop("flight_month").withColumn("_first", F.lit(False)).unionByName(first, allowMissingColumns=True)

    def insert(batch: DataFrame, n: int) -> None:
        # what follows is no part of the stream, so it runs in the caller's session, where plans may adapt
        staged = f"{root}/staged/batch={n}"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_first").parquet(staged)
        files.delete(spark, f"{root}/staged/batch={n - 1}")
        if not any(name.startswith("_first=") for name in files.child_names(spark, staged)):
            return
        # two scans, as the many small files of new keys would be packed beside the rows' large ones
        new, rows = (spark.read.schema(batch.schema).parquet(staged).filter(kind) for kind in ("_first", "NOT _first"))
        rows.agg(F.max(_seconds()).alias("latest")).write.mode("overwrite").parquet(f"{root}/seen/batch={n}")
        seen = spark.read.schema("latest LONG, batch LONG").parquet(f"{root}/seen").filter(F.col("batch") < n)
        latest = seen.agg(F.max("latest")).collect()[0][0]
        # as Spark has it for this batch: from the rows of all batches before, and never before 1970
        watermark = max(0, (latest or 0) - delay_days * DAY_SECONDS)
        is_late = F.col("flight_date").isNull() | (F.col("flight_date") <= F.expr(f"date_from_unix_date({watermark // DAY_SECONDS})"))
        others = ", ".join(f"`{c}`" for c in (*order, *(c for c in rows.columns if c not in (*BUSINESS_KEY, *order, "_first"))))
        taken = rows.filter(~is_late).unionByName(new).groupBy(*SORTED_KEY).agg(
            F.expr(f"min(CASE WHEN NOT _first THEN struct({others}) END) AS _row"), F.expr("bool_or(_first) AS _new"))
        _write(taken.filter("_new").select(*BUSINESS_KEY, "_row.*"), f"{root}/flights", years, n)
        late = tables.with_partition(rows.filter(is_late).drop("_first"), years)
        months = tables.months_of(late)
        if months:
            known = _read(spark, f"{root}/flights").unionByName(_read(spark, f"{root}/late")).filter(
                F.col("flight_month").isin(*months) & (F.col("batch") < n) & is_late)
            _write(insert_flights(late, known.select(*BUSINESS_KEY), order), f"{root}/late", years, n)

    # the staged table's two parts are written side by side, not sorted first
    with settings(spark, STATE_STORE | {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
        return (
            both.writeStream.foreachBatch(insert)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_recent(spark: SparkSession, root: str) -> DataFrame:
    """All flights that the stream stored, with `is_late`."""
    parts = [_read(spark, f"{root}/{name}").withColumn("is_late", F.lit(name == "late")) for name in ("flights", "late")]
    return parts[0].unionByName(parts[1]).drop("batch")
