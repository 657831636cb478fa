"""Operator 9: document fingerprints by a homomorphic multiset hash."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType

from tarmac.llm.common import hash_sample, lean, ship, table, text_rows, work_folder, written

#: Width of the vector of paragraphs (64-bit sums) and of the vector of phrases (16-bit sums).
LANES, CELLS = 8, 128
PHRASE = 3
#: Characters of text per bucket of neighbouring documents.
BUCKET_CHARS = 8_000_000
#: More buckets than this would make the list of their limits too long; beyond, buckets grow.
BUCKETS = 20_000
#: Sampled ids per bucket from which limits of ids that are no whole numbers are taken.
SAMPLED = 20
_SEEDS = tuple(range(LANES // 2))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class Fingerprint:
    """The sum of the vectors of a text's paragraphs, as a multiset.

    A paragraph is a line. Its wide vector has two parts: LANES 64-bit numbers hashed from the
    whole paragraph, and for each of its phrases (PHRASE words running; a shorter paragraph is
    one phrase) plus or minus 1 in one of CELLS cells. Sums are modulo 2^64 and 2^16. They don't
    depend on the order, and paragraphs can be added and taken away. Equal first parts mean
    equal multisets but for a chance of about 2^-128 or less; the second part estimates how many
    phrases differ.
    """

    def __init__(self, text: str = ""):
        self.lanes, self.cells = np.zeros(LANES, np.uint64), np.zeros(CELLS, np.int64)
        self.add(text)

    def add(self, text: str, times: int = 1) -> "Fingerprint":
        """Insert the paragraphs of a text, or with times=-1 take them away."""
        if text:
            with np.errstate(over="ignore"):
                lanes, cells = _vectors(text)
                self.lanes = self.lanes + lanes * np.uint64(times & (2**64 - 1))
                self.cells = self.cells + times * cells
        return self

    def digest(self) -> str:
        return (self.lanes.astype("<u8").tobytes() + self.cells.astype("<i2").tobytes()).hex()

    @staticmethod
    def of(digest: str) -> "Fingerprint":
        raw, made = bytes.fromhex(digest), Fingerprint()
        made.lanes = np.frombuffer(raw[:8 * LANES], "<u8").copy()
        made.cells = np.frombuffer(raw[8 * LANES:], "<i2").astype(np.int64)
        return made

    def likeness(self, other: "Fingerprint") -> float:
        """1 for equal multisets, else the estimated share of phrases in common (0 to 1).

        The squared length of a difference of these vectors estimates the number of phrases in
        which the two differ.
        """
        if np.array_equal(self.lanes, other.lanes) and np.array_equal(self.cells, other.cells):
            return 1.0
        a, b = (x.cells.astype("<i2").astype(np.int64) for x in (self, other))
        apart = (a - b).astype("<i2").astype(np.int64)  # modulo 2^16 again
        both = float((a * a).sum() + (b * b).sum())
        return max(0.0, min(1.0, 1.0 - float((apart * apart).sum()) / both)) if both else 0.0


def _vectors(text: str) -> tuple[np.ndarray, np.ndarray]:
    paragraphs = text.encode("utf-8").split(b"\n")
    lanes = np.zeros(LANES, np.uint64)
    hashes, firsts, at = [], [], 0
    for paragraph in paragraphs:
        wide = b"".join(xxhash.xxh3_128_digest(paragraph, seed) for seed in _SEEDS)
        lanes += np.frombuffer(wide, "<u8")
        words = paragraph.split() or [paragraph]
        words += [b""] * (PHRASE - len(words))
        hashes += map(xxhash.xxh3_64_intdigest, words)
        firsts.append(np.arange(at, at + len(words) - PHRASE + 1))
        at += len(words)
    word = np.array(hashes, np.uint64)
    first = np.concatenate(firsts)
    phrase = word[first] * _MIX[0]
    for i in range(1, PHRASE):
        phrase = (phrase ^ (phrase >> np.uint64(29))) * _MIX[i] + word[first + i]
    phrase = (phrase ^ (phrase >> np.uint64(32))) * _MIX[0]
    cell = (phrase >> np.uint64(40)).astype(np.int64) % CELLS
    sign = 1.0 - 2.0 * ((phrase >> np.uint64(39)) & np.uint64(1)).astype(float)
    return lanes, np.bincount(cell, weights=sign, minlength=CELLS).astype(np.int64)


def _edited(text: str, following: str | None) -> str:
    """The last half of the text replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + (following or "")[:half] if half else text


def _limits(rows: DataFrame, buckets: int) -> list[tuple]:
    """Sorted (doc_id, content) at which a bucket begins; an id that would fill several is cut by its contents' hashes."""
    ids, cuts = rows.select("doc_id").filter("doc_id IS NOT NULL"), [i / buckets for i in range(1, buckets)]
    if isinstance(rows.schema["doc_id"].dataType, IntegralType):
        found = [int(x) for x in rows.stat.approxQuantile("doc_id", cuts, 0.1 / buckets)] if cuts else []
    else:
        drawn = hash_sample(rows.filter("doc_id IS NOT NULL"), SAMPLED * buckets, "doc_id", "content") if cuts else ids.limit(0)
        drawn = [r[0] for r in drawn.select("doc_id").orderBy("doc_id").collect()]
        found = [drawn[int(cut * len(drawn))] for cut in cuts] if drawn else []
    return [(x, (i << 64) // found.count(x) - (1 << 63)) for x in dict.fromkeys(found) for i in range(found.count(x))]


def _bucket(limits: list[tuple], null_buckets: int) -> F.Column:
    """How many of the sorted limits are not above (doc_id, content), by halving steps; null ids come last, by content."""
    share = F.col("content").cast("double") / 2.0**64 + 0.5
    nulls = len(limits) + F.least(F.floor(share * null_buckets), F.lit(null_buckets - 1)).cast("int")
    if not limits:
        return F.when(F.col("doc_id").isNull(), nulls).otherwise(0)
    ids, contents = (F.lit(list(column)) for column in zip(*limits))
    steps = [1 << i for i in reversed(range(len(limits).bit_length()))]

    def not_above(at: F.Column) -> F.Column:
        limit = F.get(ids, at)
        return (limit < F.col("doc_id")) | ((limit == F.col("doc_id")) & (F.get(contents, at) <= F.col("content")))

    found = F.aggregate(
        F.array(*[F.lit(step) for step in steps]), F.lit(0),
        lambda at, step: at + F.when(not_above(at + step - 1), step).otherwise(0))
    return F.when(F.col("doc_id").isNull(), nulls).otherwise(found)


def neighbours(docs: DataFrame, folder: str, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Rows dealt into buckets of neighbouring doc_ids; each bucket also borrows the first row of the next.

    Columns bucket, borrowed, doc_id, text; partitions hold whole buckets, sorted so that each
    row is followed by its next one. The last bucket borrows from the first. Limits and first
    rows are at most one number per bucket, and there are at most BUCKETS of them. Rows without
    an id, or many of one id, fill several buckets in order of their contents' hashes.
    """
    rows = text_rows(docs).withColumn("content", F.xxhash64("text"))
    total, unnamed = rows.agg(
        F.sum(F.length("text")), F.sum(F.when(F.col("doc_id").isNull(), F.length("text")))).collect()[0]
    buckets = int(min(BUCKETS, max(1, -(-(total or 0) // bucket_chars))))
    null_buckets = max(1, round(buckets * (unnamed or 0) / max(1, total or 0)))
    dealt = rows.withColumn("bucket", _bucket(_limits(rows, max(1, buckets - null_buckets + 1)), null_buckets))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")
    firsts = dealt.groupBy("bucket").agg(F.min(first).alias("first"))
    order = Window.orderBy("bucket")
    before = firsts.select(
        "bucket", F.col("first.doc_id").alias("first_id"), F.col("first.content").alias("first_content"),
        F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias("lender"),
    )
    before = F.broadcast(written(before, folder, "firsts")).alias("f")
    is_first = (F.col("d.bucket") == F.col("f.bucket")) & F.col("doc_id").eqNullSafe(F.col("first_id")) & (
        F.col("content") == F.col("first_content"))
    borrowed = dealt.alias("d").join(before, is_first).select(
        F.col("lender").alias("bucket"), F.lit(1).alias("borrowed"), "doc_id", "text", "content")
    everything = dealt.select("bucket", F.lit(0).alias("borrowed"), "doc_id", "text", "content").unionByName(borrowed)
    return everything.repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", "borrowed", F.col("doc_id").asc_nulls_last(), "content").drop("content")


_COLUMNS = (
    "doc_id {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _rows(batches):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "borrowed", "doc_id", "text")))


def _compared(rows):
    """One result per own row, from the row and its follower."""
    last = None
    for bucket, borrowed, doc_id, text in rows:
        if borrowed and (last is None or last[0] != bucket):
            continue  # a further row with the same id as the one borrowed
        print_ = Fingerprint(text)
        if last is not None and last[0] == bucket:
            _, own_id, own, own_print = last
            edited = _edited(own, text)
            edited_print = own_print if edited == own else Fingerprint(edited)
            yield (
                own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_print.digest(),
                edited_print.digest(), own_print.likeness(edited_print), own_print.likeness(print_),
            )
        last = None if borrowed else (bucket, doc_id, text, print_)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the beginning of the next document by doc_id
    (nulls last, equal ids by a hash of their texts; after the last comes the first). Null text counts as empty;
    an empty text has the fingerprint of no paragraphs and is like other empty ones only.
    Repeated rows are documents of their own and neighbours of each other. An empty table gives
    an empty result. Columns other than doc_id and text are not read. Ids may be of any type
    that can be sorted. Copies of one row, id and text, stay in one bucket.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType
    columns = _COLUMNS.format(kind.simpleString())
    schema = pa.schema([
        ("doc_id", to_arrow_type(kind)), ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def compare(batches):
        done = []
        for row in _compared(_rows(batches)):
            done.append(row)
            if len(done) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)

    return neighbours(docs, work_folder(spark, "fingerprints")).mapInArrow(lean(compare), columns)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
