"""Operator 2: token counts through a digest cache."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import memo
from tarmac.llm.common import ship, table, text_rows, work_folder

LIMIT = 4096
CACHE = "content binary, n_tokens long"


def _digest() -> F.Column:
    """Content digest. Null reads as empty; nothing else is normalised, as the tokenizer sees every byte."""
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("content")


def cached_counts(spark: SparkSession, cache_dir: str, version: str) -> DataFrame:
    """The stored counts of one tokenizer version, one row per content."""
    path = f"{cache_dir}/tokenizer={version}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def token_counts(docs: DataFrame, tokenizer: str, cache_dir: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit.

    The cache is keyed by content digest and by the digest of the tokenizer file. Contents that
    it lacks are made distinct before the shuffle (copies meet in the map task), encoded once
    and appended. Writers of one cache folder take turns; without a folder the cache lives for
    this call. A lost task encodes its contents again, nothing is stored twice.

    Null text counts as empty: 0 bytes, 0 tokens. Null and repeated doc_ids are rows like
    others, the result has one row for each. An empty table gives an empty result. Columns
    other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    cache_dir = cache_dir or work_folder(spark, "token-cache")
    version = memo.file_digest(tokenizer)

    def encode(batches):
        counter = memo.worker_tokenizer("PieceCounter", tokenizer)
        for batch in batches:
            counts = [n for run in memo.chunks(batch.column("text").to_pylist()) for n in counter.counts(run)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("content").cast(pa.binary()), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    rows = text_rows(docs).withColumn("content", _digest())
    # distinct first: copies then meet in the map tasks and not in one task of the join
    distinct = rows.groupBy("content").agg(F.first("text").alias("text"))
    missing = distinct.join(cached_counts(spark, cache_dir, version), "content", "left_anti")
    missing.mapInArrow(encode, CACHE).write.mode("append").parquet(f"{cache_dir}/tokenizer={version}")
    return (
        rows.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(cached_counts(spark, cache_dir, version), "content")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
