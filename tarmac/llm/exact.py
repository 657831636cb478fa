"""Operator 3: exact deduplication over a stream with disk-backed keyed state."""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import SPACE, table, text_rows, work_folder, written

#: State in RocksDB on the executors' disks, its changes stored in the shared folder.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # one bound for all stores of an executor, however many partitions it holds
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    # many small stores would each set megabytes of disk aside
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: call and row tell rows apart that repeat each other: the call that added them, and the place in its feed.
FEED = "key string, doc_id {}, n_chars long, text_sha256 string, locator string, call int, row long"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", "")


def _keyed(docs: DataFrame, key_digits: int) -> DataFrame:
    """doc_id, normal text, its digest and the state key (the digest, or fewer of its digits)."""
    rows = text_rows(docs, F.input_file_name().alias("locator"))
    rows = rows.select("doc_id", "locator", F.length("text").cast("long").alias("n_chars"), normalised(F.col("text")).alias("normal"))
    return rows.withColumn("text_sha256", F.sha2("normal", 256)).withColumn("key", F.substring("text_sha256", 1, key_digits))


def append_feed(docs: DataFrame, folder: str, key_digits: int = 64) -> int:
    """Add documents to the feed that the stream reads: digests, identifiers and locators, no texts; returns the call's number."""
    call = random.randrange(1 << 31)
    rows = _keyed(docs, key_digits).select(
        "key", "doc_id", "n_chars", "text_sha256", "locator", F.lit(call).alias("call"), F.monotonically_increasing_id().alias("row"))
    rows.write.mode("append").parquet(f"{folder}/feed")
    return call


def advance(spark: SparkSession, folder: str, id_type: str = "bigint", max_bytes: int = 64 << 30) -> None:
    """Take what is new in the feed into the state: per key the row that stays, and how many there are.

    The state has no watermark and so never expires. Rows of a key are combined in the map
    tasks first, so a key that a third of the rows share is one row per task.
    """
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        feed = (
            spark.readStream.schema(FEED.format(id_type)).option("maxBytesPerTrigger", str(max_bytes))
            .parquet(f"{folder}/feed")
        )
        best = F.struct(
            (-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator", "call", "row")
        query = (
            feed.groupBy("key").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
            .writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keepers(spark: SparkSession, folder: str) -> DataFrame:
    """The state: key, keep_id, keep_chars, keep_locator, keep_call, keep_row, group_size."""
    state = spark.read.format("statestore").load(f"{folder}/state")
    best, count = (state.schema["value"].dataType.names[i] for i in (0, 1))
    value = F.col("value")
    return state.select(
        F.col("key")["key"].alias("key"), value[best]["doc_id"].alias("keep_id"),
        (-value[best]["less"]).alias("keep_chars"), value[best]["locator"].alias("keep_locator"),
        value[best]["call"].alias("keep_call"), value[best]["row"].alias("keep_row"),
        value[count].alias("group_size"),
    )


def read_parquet_rows(spark: SparkSession, locators: list[str]) -> DataFrame:
    """doc_id and text of earlier documents, from the files that their locators name."""
    return spark.read.parquet(*locators).select("doc_id", "text")


def _retained_texts(hits: DataFrame, shared: DataFrame, call: int, folder: str, key_digits: int, read: Callable) -> DataFrame:
    """key, normal: the whole text of the row that stays, found by its locator.

    Keepers of this call are among the hits. The files of earlier ones are read again; rows
    without a locator, which stem from no file, cannot be, and their keys have no text here.
    """
    spark = hits.sparkSession
    is_keeper = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    own = hits.join(shared.filter(F.col("keep_call") == call), "key").filter(is_keeper & (F.col("locator") == F.col("keep_locator")))
    # written before they are grouped, so that adaptive execution may split a key of many rows
    texts = written(own.select("key", "normal"), folder, "own-keepers")
    earlier = shared.filter(F.col("keep_call") != call).join(hits.select("key").distinct(), "key", "left_semi")
    earlier = written(earlier.filter("keep_locator <> ''"), folder, "earlier-keepers")
    files = [r[0] for r in earlier.select("keep_locator").distinct().collect()]
    if files:
        rows = _keyed(read(spark, files), key_digits).drop("text_sha256").join(earlier, "key").filter(
            is_keeper & (F.col("locator") == F.col("keep_locator")))
        texts = texts.unionByName(written(rows.select("key", "normal"), folder, "earlier-texts"))
    return texts.groupBy("key").agg(F.min("normal").alias("kept_normal"))


def exact_dedup(docs: DataFrame, folder: str | None = None, key_digits: int = 64, read: Callable = read_parquet_rows) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal without their white space. Of equal ones the row with most code points in
    its own text stays, then the smallest doc_id (null last), and of rows that repeat it, one.
    The stream finds rows with equal keys; on such hits the whole texts are compared with the
    retained document's, found by its locator, and where they differ the rows of that key are
    grouped by their texts.

    With a folder of an earlier call, its state goes on and `docs` are the new documents;
    `read(spark, locators)` gives doc_id and text of the files that hold earlier keepers (Parquet
    unless told otherwise), for keys that are hit. Where an earlier document came from no file,
    a hit on it rests on its digest. Of a key with unlike texts, group_size counts the rows of
    this call and the earlier keeper.

    Null text counts as empty. An empty table gives an empty result. Columns other than doc_id
    and text are not read.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "exact")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    call = append_feed(docs, folder, key_digits)
    feed = spark.read.schema(FEED.format(id_type)).parquet(f"{folder}/feed").filter(F.col("call") == call)
    if feed.isEmpty():
        found = feed.withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(0).cast("long"), "kept": F.lit(True)})
        return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    advance(spark, folder, id_type)
    work = work_folder(spark, "exact-call")
    state = written(keepers(spark, folder), work, "keepers")
    shared = state.filter("group_size > 1")
    hits = written(
        _keyed(docs, key_digits).withColumn("row", F.monotonically_increasing_id()).join(shared.select("key"), "key", "left_semi"),
        work, "hits")
    kept_text = written(_retained_texts(hits, shared, call, work, key_digits, read), work, "kept_text")
    # written before they are made distinct, for the same reason as above
    differing = written(hits.join(kept_text, "key").filter("normal <> kept_normal").select("key"), work, "differing")
    unlike = written(differing.distinct(), work, "unlike")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    same_row = (F.col("call") == F.col("keep_call")) & (F.col("row") == F.col("keep_row"))
    rest = feed if unlike.isEmpty() else feed.join(unlike, "key", "left_anti")
    rest = rest.join(state, "key").withColumn("kept", same_row).select(*columns)
    if unlike.isEmpty():
        return rest
    # the earlier keeper of such a key is a row of its group, which is not of this call
    earlier = state.filter(F.col("keep_call") != call).join(unlike, "key").join(kept_text, "key").select(
        "key", F.col("keep_id").alias("doc_id"), F.col("keep_chars").alias("n_chars"), F.col("kept_normal").alias("normal"),
        F.sha2("kept_normal", 256).alias("text_sha256"), F.lit(None).cast("long").alias("row"))
    clashing = hits.join(unlike, "key").select(*earlier.columns).unionByName(earlier)
    best = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = clashing.groupBy("key", "normal").agg(F.min(best).alias("best"), F.count("*").alias("group_size")).select(
        "key", "normal", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    mended = clashing.filter("row IS NOT NULL").join(groups, ["key", "normal"]).withColumn(
        "kept", F.col("row").eqNullSafe(F.col("keep_row"))).select(*columns)
    return rest.unionByName(mended)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER best = 1 AS kept, text_sha256
FROM t
WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
