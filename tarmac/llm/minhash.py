"""Operator 11: near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has COORDINATES bins. In each round every shingle is thrown into a bin by the round's
own hash function, and a bin keeps the least value of the first round that reached it; rounds
go on until every bin is filled, and after as many rounds as bins each further one fills a bin
of its own with all shingles, so a sketch is never left with holes. Two sketches agree in a bin
with a probability of the Jaccard similarity, as closely concentrated as by independent
functions, at a cost of the set's size plus the bins, not times the bins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import lean, ship, table, text_rows, work_folder, written
from tarmac.llm.graph import components
from tarmac.llm.jaccard import set_digest, shingle_set, whole_sets

#: Bands and the coordinates of each. At a similarity of 0.85 no band of two sketches agrees with
#: a probability of (1 - 0.85 ** ROWS) ** BANDS, 1.4e-9.
BANDS, ROWS = 64, 8
COORDINATES = BANDS * ROWS
#: Links from overlap * (100 + LIMIT) >= LIMIT * (size + size) on.
LIMIT = 85
#: A pair is verified if its sketches agree in this share of coordinates; at 0.85 a share so low has a probability under 1e-6.
AGREE = 0.77
#: Cells of the parities that bound from below in how many shingles two sets differ.
PARITIES = 1024
#: Rows of one band's bucket compared in one task at once, and rows of a task in that step.
CHUNK, TASK_ROWS = 2000, 40_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_VALUE = np.uint64((1 << 48) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(29))) * _MIX[1]
    return h ^ (h >> np.uint64(32))


_SALTS = _mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * _MIX[2])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least value of each bin: the round in the top 16 bits, then the shingle's hash in that round.

    A value of an earlier round is always less, so rounds that come after all bins are full change nothing.
    """
    full = np.uint64(2**64 - 1)
    least = np.full(COORDINATES, full, np.uint64)
    # so many throws fill all bins at once but for a small chance
    step = max(1, round(COORDINATES * (np.log(COORDINATES) + 1) / len(shingles)))
    at = 0
    while at < COORDINATES and (least == full).any():
        rounds = np.arange(at, min(at + step, COORDINATES))
        h = _mixed(shingles[None, :] ^ _SALTS[rounds, None])
        value = (h & _VALUE) | rounds.astype(np.uint64)[:, None] << np.uint64(48)
        np.minimum.at(least, ((h >> np.uint64(48)) % np.uint64(COORDINATES)).astype(np.int64).ravel(), value.ravel())
        at += step
    for b in np.flatnonzero(least == full).tolist():
        least[b] = (_mixed(shingles ^ _SALTS[COORDINATES + b]) & _VALUE).min() | np.uint64(COORDINATES + b) << np.uint64(48)
    return least


def bands(coordinates: np.ndarray) -> np.ndarray:
    """One key of each band, different from those of other bands."""
    rows = coordinates.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[2]
    for i in range(ROWS):
        key = _mixed(key ^ rows[:, i])
    return key.view(np.int64)


def parities(shingles: np.ndarray) -> bytes:
    """Whether an odd number of shingles lies in each cell: two sets differ in at least as many shingles as cells."""
    cells = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % PARITIES, minlength=PARITIES)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


_SETS = "doc_id {}, content long, lo long, n long, bands array<long>, sig binary"


def _described(batches):
    """Each document's set; the sketch with the first one of a set in the task."""
    seen: set[int] = set()
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            shingles = shingle_set(text.as_py())
            lo = set_digest(shingles)[0]
            if len(shingles) and lo not in seen:
                seen.add(lo)
                made = sketch(shingles)
                rows.append((lo, len(shingles), bands(made), (_mixed(made) >> np.uint64(56)).astype(np.uint8).tobytes() + parities(shingles)))
            else:
                rows.append((lo, len(shingles), None, None))
        if len(seen) > 1_000_000:
            seen = set()
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                names=["doc_id", "content", "lo", "n", "bands", "sig"])


def document_sketches(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = text_rows(docs).withColumn("content", F.xxhash64("text"))
    return rows.mapInArrow(lean(_described), _SETS.format(kind))


def _sizes_allow(a, b):
    """Whether sets of these sizes can be as alike as the limit."""
    return LIMIT * np.maximum(a, b) <= 100 * np.minimum(a, b)


def _signatures(column) -> np.ndarray:
    """Per set its coordinates, in 8 bits each, and behind them its parities."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES + PARITIES // 8)


def _may_link(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether signatures allow a link of sets whose sizes add up to these.

    Linking sets differ in (100 - LIMIT) / (100 + LIMIT) of both sizes at most; parities never
    tell more differences than there are. Coordinates agree as often as the sets are alike, less
    those that agree by chance.
    """
    apart = np.bitwise_count(a[:, COORDINATES:] ^ b[:, COORDINATES:]).sum(axis=1, dtype=np.int64)
    agree = ((a[:, :COORDINATES] == b[:, :COORDINATES]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
    return ((100 + LIMIT) * apart <= (100 - LIMIT) * sizes) & (agree >= AGREE)


def _alike(batches):
    for batch in batches:
        a, b = _signatures(batch.column("sig_a")), _signatures(batch.column("sig_b"))
        n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(_sizes_allow(n, m) & _may_link(a, b, n + m)))


def alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link."""
    for end in "ab":
        own = classes.select(F.col("lo").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}"))
        pairs = pairs.join(own, end)
    return pairs.mapInArrow(_alike, "a long, b long")


def _linked(batches):
    for batch in batches:
        links = []
        for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b")):
            x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
            common = len(np.intersect1d(x, y, assume_unique=True))
            links.append(100 * common >= LIMIT * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, folder: str, name: str) -> DataFrame:
    """The pairs whose whole sets link; sets are built again from the texts of those that stand in a pair."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("lo")).distinct()
    sets = whole_sets(docs, classes, ends, folder, f"{name}-sets")
    for end in "ab":
        pairs = pairs.join(sets.select(F.col("lo").alias(end), F.col("shingles").alias(f"shingles_{end}")), end)
    return written(pairs.select("a", "b", "shingles_a", "shingles_b").mapInArrow(_linked, "a long, b long"), folder, f"{name}-links")


def _merged(labels: DataFrame, links: DataFrame, folder: str, name: str) -> DataFrame:
    """Labels (lo, comp) of all classes after some more links (a, b)."""
    ends = links
    for end in "ab":
        ends = ends.join(labels.select(F.col("lo").alias(end), F.col("comp").alias(f"comp_{end}")), end)
    joined = components(ends.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")), folder, f"{name}-joined")
    whole = joined.select(F.col("id").alias("comp"), F.col("comp").alias("whole"))
    return written(labels.join(whole, "comp", "left").select("lo", F.coalesce("whole", "comp").alias("comp")), folder, f"{name}-labels")


def drawn_together(docs: DataFrame, classes: DataFrame, members: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Labels of the classes after pairs with pivots, and the pairs that were tried.

    First each class meets the least of its buckets' pivots, which a large group shares. Then, as
    long as a quarter of what is tried links, each class meets one pivot of every other component
    that its buckets' pivots belong to. What is left apart is compared in whole afterwards.
    """
    met = written(members.filter("lo <> pivot").select("lo", "pivot").distinct(), folder, "met")
    labels = written(classes.select("lo", F.col("lo").alias("comp")), folder, "labels")
    best, tried, n = met.groupBy("lo").agg(F.min("pivot").alias("pivot")), None, 0
    while True:
        pairs = written(best.select(F.col("pivot").alias("a"), F.col("lo").alias("b")), folder, f"star{n}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        close = written(alike(pairs, classes), folder, f"star{n}-close")
        if close.isEmpty():
            return labels, tried
        links = linked(docs, classes, close, folder, f"star{n}")
        labels = _merged(labels, links, folder, f"star{n}")
        if 4 * links.count() < close.count():
            return labels, tried
        # what has come together or was tried is not asked again, so each round joins less
        own, other = labels.select("lo", F.col("comp").alias("own")), labels.select(F.col("lo").alias("pivot"), F.col("comp").alias("other"))
        met = met.join(pairs.select(F.col("b").alias("lo"), F.col("a").alias("pivot")), ["lo", "pivot"], "left_anti")
        apart = written(met.join(own, "lo").join(other, "pivot").filter("own <> other").select("lo", "pivot", "other"), folder, f"apart{n}")
        met, best = apart.select("lo", "pivot"), apart.groupBy("lo", "other").agg(F.min("pivot").alias("pivot"))
        n += 1


_PAIR = "a long, b long"


def _compared(key: tuple, rows: pa.Table) -> pa.Table:
    """Pairs of different components within buckets that sizes and sketches allow, in order of distance in the bucket."""
    rows = rows.sort_by([(c, "ascending") for c in ("key", "p", "q", "lo")])
    bucket, p, q, lo, n, comp, chunk = (rows.column(c).to_numpy() for c in ("key", "p", "q", "lo", "n", "comp", "chunk"))
    sig = _signatures(rows.column("sig"))
    at, found, d = np.arange(len(lo)), [], 1
    while len(at):
        at = at[at + d < len(lo)]
        at = at[(bucket[at] == bucket[at + d]) & (p[at] == p[at + d]) & (q[at] == q[at + d])]
        to = at + d
        # rows of two chunks meet those of the other only, as each chunk also meets itself
        keep = (comp[at] != comp[to]) & ((p[at] == q[at]) | (chunk[at] != chunk[to])) & _sizes_allow(n[at], n[to])
        x, y = at[keep], to[keep]
        close = _may_link(sig[x], sig[y], n[x] + n[y])
        found.append(np.stack([lo[x[close]], lo[y[close]]], axis=1))
        d += 1
    pairs = np.unique(np.sort(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=1), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def further_pairs(members: DataFrame, labels: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """Pairs that share a bucket, lie in different components and may link.

    A long bucket is cut into chunks, and each two of its chunks meet in a task.
    """
    named = written(members.join(labels, "lo").select("key", "lo", "comp"), folder, "named")
    mixed = named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows")).filter("low <> high")
    rows = (
        named.join(mixed.select("key", F.ceil(F.col("rows") / CHUNK).cast("int").alias("chunks")), "key")
        .withColumn("chunk", F.pmod(F.xxhash64("lo"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", "lo", "comp", "chunk", F.least("chunk", "other").alias("p"), F.greatest("chunk", "other").alias("q"))
    )
    rows = written(rows, folder, "mixed")
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    return (
        rows.join(classes.select("lo", "n", "sig"), "lo")
        .withColumn("task", F.pmod(F.xxhash64("key", "p", "q"), F.lit(tasks))).groupBy("task").applyInArrow(_compared, _PAIR).distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    A document's set are its distinct runs of five words (lower-cased, A-Z), or all its words if
    there are fewer. Sets of a similarity of 0.85 or more link, confirmed on the whole sets.
    Equal sets are one class. Every bucket of every band has a pivot; classes first meet pivots,
    which draws large groups together in few pairs; then all members of a bucket that are still
    in different components are compared by sizes and sketches, and those that may link are
    verified. There is no limit on a bucket's members.

    Null text counts as empty; documents without words have component_id = doc_id, linked with
    nothing. component_id is the smallest doc_id of the component, null only if it has no other.
    kept tells whether it is the row's own, so rows that repeat it are all kept. An empty table
    gives an empty result. Columns other than doc_id and text are not read. Sets and shingles
    are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = work_folder(spark, "minhash")
    described = written(document_sketches(docs), folder, "described")
    rows = described.filter("n > 0")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content", "n")).alias("best")
    classes = written(
        rows.groupBy("lo").agg(best, F.first("sig", ignorenulls=True).alias("sig"))
        .select("lo", *[f"best.{c}" for c in ("no_id", "doc_id", "content", "n")], "sig"),
        folder, "classes")
    keys = rows.filter("bands IS NOT NULL").select("lo", F.explode("bands").alias("key"))
    # most buckets hold one class
    shared = keys.groupBy("key").agg(F.min("lo").alias("pivot"), F.max("lo").alias("other")).filter("pivot <> other")
    members = written(keys.join(shared.select("key", "pivot"), "key").distinct(), folder, "members")
    labels, tried = drawn_together(docs, classes, members, folder)
    more = written(further_pairs(members, labels, classes, folder).join(
        tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), folder, "more")
    labels = _merged(labels, linked(docs, classes, more, folder, "more"), folder, "more")
    named = written(
        classes.select("lo", F.struct("no_id", "doc_id").alias("head")).join(labels, "lo")
        .select("lo", "head", F.col("comp").alias("whole")), folder, "named-classes")
    heads = named.groupBy("whole").agg(F.min("head").alias("head"))
    by_class = written(named.drop("head").join(heads, "whole").select("lo", F.col("head.doc_id").alias("component_id")), folder, "components")
    told = rows.join(by_class, "lo").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = described.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return told.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
