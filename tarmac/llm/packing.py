"""Operator 7: best-fit packing with certified bounds."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import memo
from tarmac.llm.common import lean, ship, table, text_rows, work_folder, written

LENGTH = 4096
END_ID = 1
#: Pieces that one task packs; groups are cut by a stored running number, so none is larger by much.
GROUP_PIECES = 50_000
PIECES = "task int, number long, doc_id {}, piece int, start long, length long, ids_crc32 long"
PLACED = "task int, number long, sequence_id long, offset long, open boolean, bins long, bound long"


def tokenized_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """task, number, doc_id, piece, start, length, ids_crc32: whole documents and their end id, cut only beyond `length`."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        from pyspark import TaskContext

        words, task, number = memo.worker_tokenizer("WordIds", tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, run in _runs(batch.column("text")):
                sizes, crcs, starts, pieces, rows = [], [], [], [], []
                for k, ids in enumerate(words.ids(run)):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[at:at + 4 * length]
                        rows.append(i + k)
                        pieces.append(piece)
                        starts.append(at // 4)
                        sizes.append(len(part) // 4)
                        crcs.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task] * len(rows), pa.int32()),
                        pa.array(range(number, number + len(rows)), pa.int64()),
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()),
                    ],
                    names=["task", "number", "doc_id", "piece", "start", "length", "ids_crc32"],
                )
                number += len(rows)

    return text_rows(docs).mapInArrow(lean(cut), PIECES.format(kind))


def _runs(column: pa.Array):
    at = 0
    for run in memo.chunks(column.to_pylist()):
        yield at, run
        at += len(run)


def bin_bound(lengths: np.ndarray, capacity: int = LENGTH) -> int:
    """A number of bins that no packing can go below: the best of a family of dual feasible functions.

    For a threshold e up to half the capacity, lengths above capacity - e count as a whole bin
    and lengths under e as nothing; the rest keep their length. e = 0 is the bound by volume.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    words = counts * np.arange(capacity + 1)
    upto, words_upto = np.cumsum(counts), np.cumsum(words)
    e = np.arange(capacity // 2 + 1)
    whole = upto[capacity] - upto[capacity - e]
    middle = words_upto[capacity - e] - np.where(e > 0, words_upto[np.maximum(e - 1, 0)], 0)
    return int(np.max(whole + -(-middle // capacity)))


def best_fit_decreasing(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's fill: longest first, each into the fullest bin that it fits.

    `free` holds the bins by room left, as a set of bits, so the tightest room is the lowest
    bit from the item's length on.
    """
    bins, offsets, fills = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            one = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, one = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = one, capacity - room
        fills[one] = capacity - room + size
        if room > size:
            if not free[room - size]:
                rooms |= 1 << room - size
            free[room - size].append(one)
    return bins, offsets, np.array(fills, np.int64)


def _pack_group(capacity: int, first_id: int):
    """Packs one group; bins beyond a certified count stay closed, those of a group with a gap open up.

    When the bins meet the bound only the one that is not full may be improved by meeting other
    groups' documents. With a gap, bins under 97 % give up their documents as well.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "task", "number"], ascending=[False, True, True])
        lengths = pdf["length"].to_numpy()
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        bound = bin_bound(lengths, capacity)
        certified = len(fills) == bound
        open_bins = fills < (0.97 * capacity if not certified else fills.min() + 1)
        open_bins &= fills < capacity
        group = int(pdf["group"].iloc[0])
        return pd.DataFrame({
            "task": pdf["task"], "number": pdf["number"],
            "sequence_id": first_id + (group << 24) + bins, "offset": offsets, "open": open_bins[bins],
            "bins": len(fills), "bound": bound,
        })

    return pack


def pack(pieces: DataFrame, folder: str, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Places of all pieces: task, number, sequence_id, offset.

    Each group is packed best-fit decreasing and its bin count held against the bound. In the
    next round, the documents of open bins meet those of other groups in fewer groups. Rounds
    end when one group is left or a round has saved no bin. Bins hold the same documents after
    a retry, as groups are cut from the written table.

    The written tables `round0`, `round1` and so on in the folder hold each group's number of
    bins and its bound (columns bins and bound); `certificates` reads them.
    """
    keys = pieces.filter(F.col("length") < length).select("task", "number", "length")
    whole = pieces.filter(F.col("length") >= length).select(
        "task", "number",
        # full pieces are sequences of their own, numbered from the top by task and number
        (-(F.col("task").cast("long") * (1 << 36) + F.col("number")) - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    columns = ["task", "number", "sequence_id", "offset"]
    done, left, open_bins, round_ = [whole], keys.count(), None, 0
    while True:
        groups = max(1, -(-left // group_pieces))
        dealt = keys.withColumn("group", F.pmod(F.xxhash64("task", "number", F.lit(round_)), F.lit(groups)))
        placed = written(
            dealt.groupBy("group").applyInPandas(_pack_group(length, round_ << 56), PLACED), folder, f"round{round_}")
        bins = placed.groupBy("sequence_id").agg(F.first("open").alias("open"), F.count("*").alias("rows")).agg(
            F.count("*"), F.count_if("open"), F.coalesce(F.sum(F.when(F.col("open"), F.col("rows"))), F.lit(0))
        ).collect()[0] if groups > 1 else None
        # a single group has met all others; as many bins as before were not worth their round
        if bins is None or bins[1] == 0 or (open_bins is not None and bins[0] >= open_bins):
            done.append(placed.select(*columns))
            break
        done.append(placed.filter("NOT open").select(*columns))
        keys = keys.join(placed.filter("open").select("task", "number"), ["task", "number"])
        open_bins, left, round_ = bins[1], bins[2], round_ + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def certificates(spark: SparkSession, folder: str, round_: int = 0) -> DataFrame:
    """Per group of a round: its first sequence_id, bins, the bound that no packing of it goes below, and certified."""
    placed = spark.read.parquet(f"{folder}/round{round_}")
    return placed.groupBy(F.shiftright("sequence_id", 24).alias("group")).agg(
        F.min("sequence_id").alias("first_id"), F.first("bins").alias("bins"), F.first("bound").alias("bound")
    ).select("first_id", "bins", "bound", (F.col("bins") == F.col("bound")).alias("certified"))


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are a document of the end id alone. Documents longer than a sequence
    are cut; each full piece is a sequence of its own. Null and repeated doc_ids are documents
    like others. An empty table gives an empty result. Columns other than doc_id and text are
    not read.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = work_folder(spark, "packing")
    pieces = written(tokenized_pieces(docs, tokenizer, length, end_id), folder, "pieces")
    places = pack(pieces, folder, length)
    return pieces.join(places, ["task", "number"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
