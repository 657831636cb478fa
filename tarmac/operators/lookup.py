"""Searches in the word index of the dimensions, by relational division over stored postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POSTINGS_SCHEMA = "token STRING, entity STRING, code STRING"


def write_postings(index: DataFrame, path: str, partitions: int | None = None) -> None:
    """Store token, entity, code by ranges of words, so that a file, and within it a row group, holds few words.

    A word that stands for a third of all codes fills several files: codes are part of the range.
    """
    by = ("token", "code")
    dealt = index.repartitionByRange(partitions, *by) if partitions else index.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTINGS_SCHEMA).parquet(path)


def find(postings: DataFrame, words: Sequence[str], every: bool = True, prefix: bool = False) -> DataFrame:
    """entity, code, matched: the rows whose text has all the words (or any), and how many it has.

    Words are compared in lower case, each counts once. With `prefix`, the last word may go on.
    The filter is a list of words and one range, so only row groups that may hold them are read.
    No words find nothing.
    """
    asked = [w.lower() for w in words]
    begun = asked.pop() if prefix and asked else None
    asked = sorted(set(asked))
    wanted = F.col("token").isin(*asked) if asked else F.lit(False)
    # which word a posting answers; a word that is asked for may begin with the prefix too
    answers = [F.when(F.col("token") == w, F.lit(i)) for i, w in enumerate(asked)]
    if begun is not None:
        wanted = wanted | F.col("token").startswith(begun)
        answers.append(F.when(F.col("token").startswith(begun), F.lit(len(asked))))
    number = len(answers)
    if not number:
        return postings.limit(0).select("entity", "code", F.lit(0).alias("matched"))
    found = (
        postings.filter(wanted)
        .select("entity", "code", F.explode(F.array_compact(F.array(*answers))).alias("word"))
        .groupBy("entity", "code").agg(F.count_distinct("word").cast("int").alias("matched"))
    )
    return found.filter(F.col("matched") == number) if every else found
