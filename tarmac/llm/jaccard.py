"""Operator 8: n-gram Jaccard join by a blocked sparse matrix product.

The matrix has a row for each distinct set of shingles and a column for each shingle. Its
product with itself would count the shingles that two documents share. Three bounds keep it
small without losing a link: with shingles in one order, rare ones first, two sets that link
share one of the first quarter of each; sizes differ by no more than a quarter; and where in
their order the first shared shingle stands bounds how many more can follow. Pairs that pass
get their exact overlap from the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import lean, ship, table, text_rows, work_folder, written
from tarmac.llm.graph import components

WORDS = 5
#: Links from overlap * 7 >= 3 * (size + size) on, that is a Jaccard similarity of 0.75.
#: Counters of the sketch of document frequencies (4 bytes each, sent to every worker).
SKETCH = 1 << 20
SKETCH_PARTS = 64
#: Incidences gathered by one column block, and the tile size at which a map task hands on.
BLOCK = 500_000
#: Columns that the sketch puts above this are dealt over all blocks.
HOT_COLUMN = 50_000
#: In columns of up to so many rows, rows without a possible partner are left out at once.
SHORT_COLUMN = 64
#: Rows of one column compared in one task at once, and rows of a task in that step.
CHUNK, TASK_ROWS = 2000, 40_000
SIGNATURE_BITS = 512
#: Bits of the filter that keeps texts nobody asks for out of a shuffle; when it fills up, more pass.
FILTER_BITS = 1 << 25

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles: runs of five words, or all words of a shorter text."""
    words = text.encode("utf-8").lower().split()  # of bytes: lowers A-Z only, splits at the six blanks
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    made = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        made = (made ^ (made >> np.uint64(31))) * _MIX[i] + hashes[i:len(hashes) - width + 1 + i]
    return np.unique(_mixed(made))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


def prefix_size(n):
    """How many first shingles of a set of n two linking sets must share one of."""
    return n - (3 * n + 3) // 4 + 1


def signature(shingles: np.ndarray) -> bytes:
    """Parities of the shingles in SIGNATURE_BITS cells: two sets differ in at least as many shingles as bits."""
    cells = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % SIGNATURE_BITS, minlength=SIGNATURE_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def _texts(batch: pa.RecordBatch):
    """One text at a time, as a batch of long ones is large."""
    return (text.as_py() for text in batch.column("text"))


_SETS = "doc_id {}, content long, lo long, hi long, n long, sig binary, task int, part int, counts binary"


def document_sets(docs: DataFrame) -> DataFrame:
    """One row per document with its set's size and digest, and the tasks' sketches in parts.

    The sketch counts in how many documents shingles occur; shingles that share a counter are
    added up. It only sets the order of the shingles.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(batches):
        from pyspark import TaskContext

        task, counters = TaskContext.get().partitionId(), np.zeros(SKETCH, np.int64)
        names = ["doc_id", "content", "lo", "hi", "n", "sig", "task", "part", "counts"]
        id_type = None
        for batch in batches:
            id_type, rows, seen, size = batch.schema.field("doc_id").type, [], [], 0
            for text in _texts(batch):
                shingles = shingle_set(text)
                seen.append(shingles)
                rows.append((*set_digest(shingles), len(shingles), signature(shingles)))
                size += len(shingles)
                if size > SKETCH:
                    counters += np.bincount((np.concatenate(seen) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
                    seen, size = [], 0
            if seen:
                counters += np.bincount((np.concatenate(seen) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
            n = len(rows)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), *columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names=names)
        if id_type is not None:
            parts = counters.astype("<u4").reshape(SKETCH_PARTS, -1)
            n = SKETCH_PARTS
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, id_type), *[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.binary()), pa.array([task] * n, pa.int32()),
                 pa.array(range(n), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=names)

    rows = text_rows(docs).withColumn("content", F.xxhash64("text"))
    return rows.mapInArrow(lean(describe), _SETS.format(kind))


def _sum_parts(key: tuple, rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), "<u4").astype(np.int64) for c in rows.column("counts"))
    total = np.minimum(total, 2**32 - 1).astype("<u4").tobytes()
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([total], pa.binary())})


def merged_sketch(sets: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches, of fixed size; first sums of 64 tasks, then of those."""
    parts = sets.filter("part IS NOT NULL").select("part", "task", "counts")
    for width in (64, 1 << 30):
        parts = parts.withColumn("task", F.floor(F.col("task") / width).cast("int")).groupBy("part", "task").applyInArrow(
            _sum_parts, "part int, task int, counts binary")
    found = {r["part"]: r["counts"] for r in parts.collect()}
    empty = bytes(4 * SKETCH // SKETCH_PARTS)
    return np.frombuffer(b"".join(found.get(i, empty) for i in range(SKETCH_PARTS)), "<u4")


def _tiles(docs: DataFrame, sketch: np.ndarray, blocks: int) -> DataFrame:
    """Tiles of the incidence matrix: the first quarters' shingles of some rows that fall into one column block.

    Copies in one task count as one row. Columns that may be hot are dealt over blocks of their
    own (negative numbers), by row.
    """
    held = docs.sparkSession.sparkContext.broadcast(sketch)
    hot = HOT_COLUMN + 4 * int(sketch.mean())

    def cut(batches):
        counters = held.value
        seen, parts, size = set(), [], 0
        for batch in batches:
            for text in _texts(batch):
                shingles = shingle_set(text)
                n = len(shingles)
                lo = set_digest(shingles)[0]
                if not n or lo in seen:
                    continue
                seen.add(lo)
                counts = counters[(shingles % np.uint64(SKETCH)).astype(np.int64)]
                first = np.lexsort((shingles, counts))[:prefix_size(n)]
                parts.append((shingles[first], np.full(len(first), lo, np.int64), np.full(len(first), n, np.uint32),
                              np.arange(len(first), dtype=np.uint32), counts[first] >= hot))
                size += len(first)
                if size >= BLOCK:
                    yield flush(parts)
                    parts, size = [], 0
            if len(seen) > 1_000_000:
                seen = set()
        if parts:
            yield flush(parts)

    def flush(parts):
        h, lo, n, pos, is_hot = (np.concatenate(c) for c in zip(*parts))
        block = (h >> np.uint64(32)).astype(np.int64) * blocks >> 32
        spread = (_mixed(h ^ lo.view(np.uint64)) >> np.uint64(32)).astype(np.int64) * blocks >> 32
        block = np.where(is_hot, -1 - spread, block)
        order = np.lexsort((h, block))
        block, columns = block[order], [c[order] for c in (h, lo, n, pos)]
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        ends = np.append(starts[1:], len(block))
        tiles = [pa.array([c[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(block[starts], pa.int32()), *tiles], names=["block", "h", "lo", "n", "pos"])

    return text_rows(docs).mapInArrow(lean(cut), "block int, h binary, lo binary, n binary, pos binary")


def _may_link(na, i, nb, j):
    """Whether two sets can link whose first shared shingle is their i-th and j-th, counted from 0."""
    return 7 * np.minimum(na - i, nb - j) >= 3 * (na + nb)


_SHARED = "h long, lo long, n long, pos long, pivot long, ok boolean"


def _with_partner(column: np.ndarray, long: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Rows that the bounds let link with another row of their column; all rows of long columns."""
    found, at = long.copy(), np.flatnonzero(~long)
    for d in range(1, SHORT_COLUMN):
        at = at[at + d < len(column)]
        at = at[column[at] == column[at + d]]
        to = at + d
        may = _may_link(n[at], pos[at], n[to], pos[to])
        found[at[may]] = found[to[may]] = True
    return found


def _multiply(key: tuple, tiles: pa.Table) -> pa.Table:
    """One column block: the rows that may link with another of their column, and the pair of each with a pivot.

    The pivot is the row of smallest priority, the same in all columns that it stands in, so
    that a group of near copies is drawn together by few pairs.
    """
    def whole(name, kind):
        return np.concatenate([np.frombuffer(c.as_py(), kind) for c in tiles.column(name)])

    h, lo = whole("h", np.uint64), whole("lo", np.int64)
    n, pos = whole("n", np.uint32).astype(np.int64), whole("pos", np.uint32).astype(np.int64)
    order = np.lexsort((_mixed(lo.view(np.uint64)), h))
    h, lo, n, pos = h[order], lo[order], n[order], pos[order]
    new = np.append(True, (h[1:] != h[:-1]) | (lo[1:] != lo[:-1]))
    h, lo, n, pos = h[new], lo[new], n[new], pos[new]
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    sizes = np.diff(np.append(starts, len(h)))
    pivot = np.repeat(starts, sizes)
    wanted = _with_partner(np.repeat(np.arange(len(starts)), sizes), np.repeat(sizes > SHORT_COLUMN, sizes), n, pos)
    wanted |= key[0].as_py() < 0
    ok = _may_link(n, pos, n[pivot], pos[pivot]) & (lo != lo[pivot])
    return pa.table({
        "h": h.view(np.int64)[wanted], "lo": lo[wanted], "n": n[wanted], "pos": pos[wanted],
        "pivot": lo[pivot][wanted], "ok": ok[wanted]})


def _whole_sets(batches):
    for batch in batches:
        rows = []
        for text in _texts(batch):
            shingles = shingle_set(text)
            rows.append((set_digest(shingles)[0], shingles.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else ([], []), (pa.int64(), pa.binary()))], names=["lo", "shingles"])


def whole_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, folder: str, name: str) -> DataFrame:
    """lo, shingles of the classes with these ids (column lo), from the text of one document each.

    A filter of fixed size over the content hashes keeps most texts that nobody asks for out of
    the shuffle; the join behind it is exact.
    """
    asked = written(classes.join(ids, "lo", "left_semi").select("doc_id", "content"), folder, f"{name}-asked")
    place = F.col("content").bitwiseAND(FILTER_BITS - 1)
    found = asked.groupBy(F.shiftrightunsigned(place, 6).cast("int").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast((content & {63}) AS int)))").alias("bits")).collect()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[[r["word"] for r in found]] = [r["bits"] for r in found]
    held = docs.sparkSession.sparkContext.broadcast(words)

    def passing(batches):
        bits = held.value
        for batch in batches:
            at = batch.column("content").to_numpy() & (FILTER_BITS - 1)
            yield batch.filter(pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1))

    rows = text_rows(docs).withColumn("content", F.xxhash64("text"))
    rows = rows.mapInArrow(passing, rows.schema).alias("d")
    wanted = asked.alias("f")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.content") == F.col("f.content"))
    return written(rows.join(wanted, same).select("text").mapInArrow(lean(_whole_sets), "lo long, shingles binary"), folder, name)


def _close(batches):
    """Pairs whose signatures do not rule out a link."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, SIGNATURE_BITS // 8) for c in ("sig_a", "sig_b"))
        sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        apart = _BITS[a ^ b].sum(axis=1, dtype=np.int64)
        yield batch.select(["a", "b"]).filter(pa.array(7 * apart <= sizes))


def not_ruled_out(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    one = classes.select(F.col("lo").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    other = classes.select(F.col("lo").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    return pairs.join(one, "a").join(other, "b").mapInArrow(_close, "a long, b long")


def _overlaps(batches):
    """Pairs that link, by their exact overlap."""
    for batch in batches:
        a, b = batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist()
        links = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            links.append(7 * len(np.intersect1d(x, y, assume_unique=True)) >= 3 * (len(x) + len(y)))
        yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    one = sets.select(F.col("lo").alias("a"), F.col("shingles").alias("shingles_a"))
    other = sets.select(F.col("lo").alias("b"), F.col("shingles").alias("shingles_b"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "shingles_a", "shingles_b").mapInArrow(_overlaps, "a long, b long")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _compare(key: tuple, rows: pa.Table) -> pa.Table:
    """All pairs of rows of one column whose components differ and which no bound rules out.

    Rows are sorted by column; a shift by d pairs each row with the d-th after it, for all
    columns at once, until no column is that long.
    """
    rows = rows.sort_by([("h", "ascending"), ("p", "ascending"), ("q", "ascending"), ("lo", "ascending")])
    h, p, q, lo, n, pos, comp, chunk = (rows.column(c).to_numpy() for c in ("h", "p", "q", "lo", "n", "pos", "comp", "chunk"))
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(h), -1)
    at, found, d = np.arange(len(h)), [], 1
    while True:
        at = at[at + d < len(h)]
        to = at + d
        same = (h[at] == h[to]) & (p[at] == p[to]) & (q[at] == q[to])
        at, to = at[same], to[same]
        if not len(at):
            break
        # two chunks of one column are compared with each other only, one chunk with itself
        keep = (comp[at] != comp[to]) & ((p[at] == q[at]) | (chunk[at] != chunk[to])) & _may_link(n[at], pos[at], n[to], pos[to])
        x, y = at[keep], to[keep]
        apart = _BITS[sig[x] ^ sig[y]].sum(axis=1, dtype=np.int64)
        close = 7 * apart <= n[x] + n[y]
        found.append((lo[x[close]], lo[y[close]]))
        d += 1
    a, b = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def remaining_pairs(shared: DataFrame, labels: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """Pairs that share a column, lie in different components and that no bound rules out.

    A long column is cut into chunks, and each two of its chunks are compared in a task.
    """
    named = shared.select("h", "lo", "n", "pos").join(labels.withColumnRenamed("id", "lo"), "lo", "left").withColumn(
        "comp", F.coalesce("comp", "lo"))
    named = written(named, folder, "named")
    mixed = named.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows")).filter("low <> high")
    chunks = F.ceil(F.col("rows") / CHUNK).cast("int")
    rows = (
        named.join(mixed.select("h", chunks.alias("chunks")), "h")
        .withColumn("chunk", F.pmod(F.xxhash64("lo"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("h", "lo", "n", "pos", "comp", "chunk", F.least("chunk", "other").alias("p"), F.greatest("chunk", "other").alias("q"))
    )
    rows = written(rows, folder, "mixed").join(classes.select("lo", "sig"), "lo")
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    return rows.withColumn("task", F.pmod(F.xxhash64("h", "p", "q"), F.lit(tasks))).groupBy("task").applyInArrow(_compare, "a long, b long")


def jaccard_components(docs: DataFrame, with_first: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id; with_first: also content and first.

    content is the 64-bit hash of the text, first tells whether the row has the smallest
    (doc_id, content) of its component, null ids last; repeated rows have it alike.

    Documents with equal sets are one row of the matrix. Groups of near copies are first drawn
    together by pairs with pivots; then every pair of different components that shares a
    shingle of its first quarter and passes the bounds is compared. So no link is lost, and
    pairs within a component are not spelled out.

    Null text counts as empty. Texts without words have no shingles and are linked with
    nothing; their component_id is their own doc_id. A null doc_id is no component_id unless
    all ids of the component are null. Repeated rows are equal documents. An empty table gives an
    empty result. Columns other than doc_id and text are not read. Shingles and sets are told
    apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = work_folder(spark, "jaccard")
    described = written(document_sets(docs), folder, "described")
    members = described.filter("part IS NULL").drop("task", "part", "counts")
    rows = members.filter("n > 0")
    total = rows.agg(F.sum(prefix_size_sql("n"))).collect()[0][0] or 0
    blocks = max(1, -(-total // BLOCK))
    tiles = _tiles(docs, merged_sketch(described), blocks)
    shared = written(tiles.groupBy("block").applyInArrow(_multiply, _SHARED), folder, "shared")
    # one document for each distinct set
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content", "n", "sig"))
    classes = rows.groupBy("lo").agg(best.alias("best")).select("lo", *[f"best.{c}" for c in ("doc_id", "content", "n", "sig")])
    classes = written(classes, folder, "classes")

    def checked(pairs: DataFrame, name: str) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("lo")).distinct()
        return written(verified(pairs, whole_sets(docs, classes, ends, folder, f"{name}-sets")), folder, f"{name}-links")

    star = shared.filter("ok").select(*_ordered("lo", "pivot")).distinct()
    star = written(not_ruled_out(star, classes), folder, "star")
    labels = components(checked(star, "star"), folder, "near")
    more = remaining_pairs(shared, labels, classes, folder).distinct().join(star, ["a", "b"], "left_anti")
    further = checked(written(more, folder, "more"), "more")
    comp = labels.select(F.col("id"), "comp")
    ends = further.join(comp.select(F.col("id").alias("a"), F.col("comp").alias("comp_a")), "a", "left").join(
        comp.select(F.col("id").alias("b"), F.col("comp").alias("comp_b")), "b", "left")
    ends = ends.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
    joined = components(ends, folder, "joined").select(F.col("id").alias("comp"), F.col("comp").alias("whole"))
    # sets in neither table of labels are components of their own
    sizes = rows.groupBy("lo").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("head"))
    named = (
        sizes.join(comp.withColumnRenamed("id", "lo"), "lo", "left").withColumn("comp", F.coalesce("comp", "lo"))
        .join(joined, "comp", "left").select("lo", "head", F.coalesce("whole", "comp").alias("whole"))
    )
    named = written(named, folder, "named-sets")
    smallest = named.groupBy("whole").agg(F.min("head").alias("head"))
    by_set = written(named.drop("head").join(smallest, "whole").select("lo", "head"), folder, "components")
    first = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("content") == F.col("head.content"))
    more = ("content", first.alias("first")) if with_first else ()
    found = rows.join(by_set, "lo").select("doc_id", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), *more)
    more = ("content", F.lit(True).alias("first")) if with_first else ()
    alone = members.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *more)
    return found.unionByName(alone)


def prefix_size_sql(n: str) -> F.Column:
    return F.expr(f"{n} - (3 * {n} + 3) div 4 + 1")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
