"""Corpus pipeline: each stage applies one operator of tarmac.llm to all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result
as Parquet and gives it, read again, to the next. All stages but the last return the columns of
documents. Extra columns of documents are carried along. Rows with null doc_id or null text go
through all stages like others; a stage's own docstring says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import table, work_folder, written
from tarmac.llm.exact import exact_dedup, normalised
from tarmac.llm.jaccard import jaccard_components
from tarmac.llm.mixing import mix_sources
from tarmac.llm.packing import pack_documents
from tarmac.llm.quality import classify_quality


def _joined(docs: DataFrame, chosen: DataFrame, keys: tuple[str, ...], how: str) -> DataFrame:
    """Join on columns of both, nulls equal."""
    d, c = docs.alias("d"), chosen.alias("c")
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"d.{key}").eqNullSafe(F.col(f"c.{key}"))
    return d.join(c, same, how)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A verdict holds for rows of equal doc_id (null too), language and text, not for others of that doc_id.
    """
    # hashes, as ids beside nulls turn into floating-point numbers in pandas
    keys = ("__id", "__content")
    keyed = docs.withColumns({"__id": F.xxhash64("doc_id"), "__content": F.xxhash64("lang", "text")})
    found = classify_quality(keyed, table(spark, sf_dir, "labels"), carry=keys)
    rejected = written(found.filter("NOT kept").select(*keys).distinct(), work_folder(spark, "rejected"), "ids")
    return _joined(keyed, rejected, keys, "left_anti").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays; of rows that repeat it, one.

    The join leaves its rows sorted by the keys, so leaving out repeats needs no further shuffle.
    """
    found = exact_dedup(docs).filter("kept").select("doc_id", F.col("text_sha256").alias("__digest"))
    found = written(found, work_folder(spark, "kept"), "ids")
    keyed = docs.withColumn("__digest", F.sha2(normalised(F.coalesce("text", F.lit(""))), 256))
    kept = _joined(keyed, found, ("doc_id", "__digest"), "left_semi")
    return kept.dropDuplicates(["doc_id", "__digest"]).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays, the smallest by doc_id (nulls last) and hash of the text.

    Of rows that repeat its doc_id and text, one stays. Documents without words all stay.
    """
    keys, folder = ("doc_id", "__content"), work_folder(spark, "near")
    keyed = docs.withColumn("__content", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = written(
        jaccard_components(docs, with_first=True).withColumnRenamed("content", "__content").filter("n_shingles > 0")
        .groupBy(*keys, "first").agg(F.count("*").alias("rows")), folder, "found")
    kept = _joined(keyed, found.filter("NOT first"), keys, "left_anti")
    repeated = found.filter("first AND rows > 1")
    # after the exact stage there are none
    if not repeated.isEmpty():
        once = _joined(kept, repeated, keys, "left_semi").dropDuplicates([*keys])
        kept = _joined(kept, repeated, keys, "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it: not at all, once or twice.

    Rows with equal doc_id and text are one document, which stands as often as they are taken together.
    """
    keyed = docs.withColumn("__content", F.xxhash64("text"))
    found = mix_sources(keyed, carry=("__content",)).groupBy("doc_id", "__content").agg(F.sum("copies").cast("int").alias("__copies"))
    found = written(found.filter("__copies > 0"), work_folder(spark, "copies"), "ids")
    taken = _joined(keyed, found, ("doc_id", "__content"), "inner").select("d.*", "__copies")
    once = taken.dropDuplicates(["doc_id", "__content"])
    return once.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Neither the language model, nor the fitted mix, nor the packing can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage{i}")
    return docs
