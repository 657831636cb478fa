import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import infilling
from tarmac.llm.infilling import Units, fill_in_middle, restored

LETTERS = ["a", "é", "漢", "😀", "\x00", "b c", "߿", "￿"]


def plainly(doc_id, text):
    """The transformation by slices of strings."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_places_of_code_points():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40)))
        ends = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
        units = Units(np.frombuffer(text.encode(), np.uint8))
        assert units.place(np.arange(len(text) + 1)).tolist() == ends.tolist()
        assert units.before(ends).tolist() == list(range(len(text) + 1))


@pytest.mark.parametrize("run", [1, 100, 8_000_000])
def test_equals_slices(docs_of, monkeypatch, run):
    monkeypatch.setattr(infilling, "RUN_BYTES", run)
    rng = random.Random(2)
    texts = ["".join(rng.choice([*LETTERS, "<", "P>", "S>", "<S", "M", ">"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "x", "<P>", "a <M> b", "<P", "S>", "😀" * 50_000]
    docs = docs_of(*texts)
    found = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(texts) and {r["form"] for r in found} == {"plain", "psm", "spm"}
    for row in found:
        text = texts[row["doc_id"]]
        assert tuple(row[1:6]) == plainly(row["doc_id"], text) and row["back"] == (text or "")


def test_odd_rows(odd, no_docs):
    rows = fill_in_middle(odd).collect()
    told = sorted((tuple(r) for r in rows), key=repr)
    assert told == sorted(((r["doc_id"], *plainly(r["doc_id"], r["text"])) for r in odd.collect()), key=repr)
    assert fill_in_middle(no_docs).count() == 0


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("x1", "some text é"), (None, "other")], "doc_id string, text string")
    assert {r["doc_id"]: r["output"] for r in fill_in_middle(docs).collect()} == {
        i: plainly(i, t)[4] for i, t in (("x1", "some text é"), (None, "other"))}
