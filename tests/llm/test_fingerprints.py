import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tarmac.llm.fingerprints import Fingerprint, fingerprint_documents, neighbours, op9_fingerprints
from tests.conftest import SF_DIR


def edited(texts):
    for i, text in enumerate(texts):
        half, following = len(text) // 2, texts[(i + 1) % len(texts)]
        yield text[:len(text) - half] + following[:half] if half else text


def test_query_equals_a_plain_loop(spark):
    rows = sorted(op9_fingerprints(spark, SF_DIR).collect())
    docs = sorted(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    texts = [r["text"] or "" for r in docs]
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in docs]
    prints = [Fingerprint(t) for t in texts]
    for i, (r, text) in enumerate(zip(rows, edited(texts))):
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["fingerprint"] == prints[i].digest() and r["edited_fingerprint"] == Fingerprint(text).digest()
        assert r["near_edited"] == prints[i].likeness(Fingerprint(text))
        assert r["near_next"] == prints[i].likeness(prints[(i + 1) % len(rows)])
    long = [r for r in rows if r["n_chars"] > 1000]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)


def test_order_does_not_matter_and_paragraphs_come_and_go():
    parts = [f"paragraph number {i} of several words" for i in range(9)] + ["twice here", "twice here"]
    whole = Fingerprint("\n".join(parts))
    rng = random.Random(1)
    rng.shuffle(parts)
    assert Fingerprint("\n".join(parts)).digest() == whole.digest()
    grown = Fingerprint("\n".join(parts[:5]))
    for p in parts[5:]:
        grown.add(p)
    assert grown.digest() == whole.digest()
    assert grown.add(parts[0], -1).digest() == Fingerprint("\n".join(parts[1:])).digest()
    assert Fingerprint.of(whole.digest()).likeness(whole) == 1.0
    assert Fingerprint("a b").digest() != Fingerprint("b a").digest()
    assert Fingerprint("x\nx").digest() != Fingerprint("x").digest()


def test_likeness_is_near_the_share_of_common_phrases():
    rng = random.Random(2)
    for share in (0.0, 0.3, 0.7, 0.95):
        own = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(6000)]
        cut = int(len(own) * share)
        other = own[:cut] + ["".join(rng.choice("ijklmnop") for _ in range(6)) for _ in own[cut:]]
        assert Fingerprint(" ".join(own)).likeness(Fingerprint(" ".join(other))) == pytest.approx(share, abs=0.3 * (1 - share) + 0.02)


def test_neighbours_over_many_buckets(spark, docs_of, folder):
    texts = [f"text of number {i} " * (i % 7) for i in range(60)]
    rows = neighbours(docs_of(*texts, first=100).repartition(5), folder, bucket_chars=200)
    assert rows.select("bucket").distinct().count() > 10
    buckets = {}
    for r in rows.collect():
        buckets.setdefault(r["bucket"], []).append((r["doc_id"], r["borrowed"]))
    starts = sorted(b[0][0] for b in buckets.values())
    for b in buckets.values():
        own = [i for i, borrowed in b if not borrowed]
        assert own == list(range(own[0], own[-1] + 1))
        assert b[-1] == (own[-1] + 1 if own[-1] < 159 else starts[0], 1)


def test_odd_rows(odd, no_docs, docs_of):
    rows = fingerprint_documents(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    same = {r["fingerprint"] for r in rows if r["doc_id"] in (4, 5)}
    assert len(same) == 1
    assert {r["near_next"] for r in rows if r["doc_id"] == 4} == {1.0}
    assert fingerprint_documents(no_docs).count() == 0
    one = fingerprint_documents(docs_of("only one")).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"onlyonly").hexdigest() and one["near_next"] == 1.0


@pytest.mark.parametrize("kind", ["string", "int", "date", "decimal(20,2)"])
def test_ids_of_other_types(spark, folder, kind):
    rows = [(f"{2000 + i}-01-01" if kind == "date" else str(i + 10), f"text of number {i} and more") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    texts = [t for _, t in rows]
    found = sorted(fingerprint_documents(docs).collect())
    assert [r["edited_sha256"] for r in found] == [hashlib.sha256(t.encode()).hexdigest() for t in edited(texts)]
    buckets = neighbours(docs, folder, bucket_chars=200).filter("borrowed = 0").groupBy("bucket").count().collect()
    assert len(buckets) > 3


def test_many_rows_of_one_id_or_none_fill_many_buckets(spark, folder):
    rows = [(7, f"one id {i}") for i in range(300)] + [(None, f"no id {i}") for i in range(300)] + [(i, f"own {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = neighbours(docs, folder, bucket_chars=300).filter("borrowed = 0")
    sizes = {r["doc_id"]: r["buckets"] for r in dealt.groupBy("doc_id").agg(F.countDistinct("bucket").alias("buckets")).collect()}
    assert sizes[7] > 5 and sizes[None] > 5
    found = fingerprint_documents(docs).collect()
    assert len(found) == len(rows)
    # every row is followed by one row: each text but those without halves is edited by another one's beginning
    follows = neighbours(docs, folder + "x", bucket_chars=300).collect()
    assert sum(r["borrowed"] for r in follows) >= len({r["bucket"] for r in follows})
