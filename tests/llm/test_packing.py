import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tokenizers

from tarmac.llm.packing import best_fit_decreasing, bin_bound, certificates, op7_packing, pack, pack_documents
from tests.conftest import SF_DIR
from tests.llm.conftest import LONG

WORDS = public_tokenizers.path("word_bpe_49k.json")


def fewest_bins(lengths, capacity):
    """By search over all ways to fill."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                place(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        place(i + 1, bins + [lengths[i]])

    place(0, [])
    return best[0]


def test_bound_is_below_the_best_packing_and_often_equal():
    rng, equal = random.Random(5), 0
    for _ in range(60):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 8))), reverse=True)
        bound, fewest = bin_bound(np.array(lengths), 20), fewest_bins(lengths, 20)
        assert bound <= fewest
        equal += bound == fewest
    assert equal > 50


def test_best_fit_fills_the_tightest_room():
    bins, offsets, fills = best_fit_decreasing(np.array([6, 5, 4, 4, 1]), 10)
    assert fills.tolist() == [10, 10] and bins.tolist() == [0, 1, 0, 1, 1]
    assert offsets.tolist() == [0, 0, 6, 5, 9]


def check_places(rows, length):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


def test_query_equals_the_library_and_packs_to_the_bound(spark):
    model = tokenizers.Tokenizer.from_file(WORDS)
    rows, expected = op7_packing(spark, SF_DIR).collect(), []
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = np.array(model.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            expected.append((r["doc_id"], piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    assert check_places(rows, 4096) == bin_bound(np.array([r["length"] for r in rows]))


def test_groups_exchange_what_is_left_open(spark, folder):
    rng = random.Random(6)
    rows = [(0, i, rng.randint(1, 100)) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "task int, number long, length long")
    placed = pack(pieces, folder, length=100, group_pieces=200).join(pieces, ["task", "number"]).collect()
    assert len(placed) == len(rows)
    used = check_places(placed, 100)
    told = certificates(spark, folder).collect()
    assert len(told) == 15 and all(r["bound"] <= r["bins"] and r["certified"] == (r["bins"] == r["bound"]) for r in told)
    alone = -(-sum(r[2] for r in rows) // 100)
    assert used <= 1.02 * max(alone, bin_bound(np.array([r[2] for r in rows]), 100))


def test_odd_rows(odd, no_docs):
    rows = pack_documents(odd, WORDS).collect()
    assert check_places(rows, 4096) > 0
    assert [(r["length"], r["piece"]) for r in rows if r["doc_id"] in (4, 5, 6)] == [(1, 0)] * 3
    ids = tokenizers.Tokenizer.from_file(WORDS).encode(LONG, add_special_tokens=False).ids
    assert sum(r["length"] for r in rows if r["doc_id"] == 7) == len(ids) + 1 > 4 * 4096
    assert len([r for r in rows if r["doc_id"] == 1]) == 2
    assert pack_documents(no_docs, WORDS).count() == 0


def test_any_tokenizer_gives_the_ids_of_its_library(docs_of):
    """Only a tokenizer that states the steps cut here has its words cut here."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = tokenizers.Tokenizer.from_file(path)
    texts = ["Hello World", "two  blanks", "it's 2024, isn't it", "ÉTÉ größe", "", "a\nb\tc", "x<|endoftext|>y"]
    rows = pack_documents(docs_of(*texts), path).collect()
    told = {r["doc_id"]: r["ids_crc32"] for r in rows}
    assert told == {i: zlib.crc32(np.array(model.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t in enumerate(texts)}
