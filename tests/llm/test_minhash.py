import random
from collections import defaultdict

import numpy as np
import pytest

from tarmac.llm import minhash
from tarmac.llm.minhash import AGREE, BANDS, COORDINATES, LIMIT, ROWS, bands, near_duplicates, op11_minhash, sketch
from tests.conftest import SF_DIR
from tests.llm.test_jaccard import near_copies, shingles, smallest


def brute_force(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    common, columns = defaultdict(int), defaultdict(list)
    for i, s in sets.items():
        for x in s:
            for j in columns[x]:
                common[j, i] += 1
            columns[x].append(i)
    links = [p for p, n in common.items() if 100 * n >= LIMIT * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    comp = smallest(texts, links)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in texts}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_every_bin_is_filled():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 50, 511, 5000):
        made = sketch(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert len(made) == COORDINATES and (made < np.uint64(2**64 - 1)).all()


def test_sketches_do_not_depend_on_how_many_rounds_are_made_at_once():
    """A set and a larger one agree in just the bins whose least shingle they share."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**64, 40, dtype=np.uint64)
    for extra in (1, 10, 3000):
        b = np.concatenate([a, rng.integers(0, 2**64, extra, dtype=np.uint64)])
        both = np.minimum(sketch(a), sketch(b[40:]))
        assert (sketch(b) == both).all()


@pytest.mark.parametrize("n", [20, 300, 4000])
def test_agreement_estimates_the_similarity(n):
    rng = np.random.default_rng(n)
    off = []
    for _ in range(60):
        own = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        cut = rng.integers(1, n)
        a, b = own[:n], own[cut:n + cut]
        off.append((sketch(a) == sketch(b)).mean() - (n - cut) / (n + cut))
    assert abs(np.mean(off)) < 0.01 and np.max(np.abs(off)) < 6 * 0.5 / COORDINATES**0.5


def test_a_link_is_hardly_ever_missed():
    assert (1 - (LIMIT / 100) ** ROWS) ** BANDS < 1e-8
    assert (LIMIT / 100 - AGREE) / (0.85 * 0.15 / COORDINATES) ** 0.5 > 5
    rng = np.random.default_rng(5)
    for _ in range(200):
        own = rng.integers(0, 2**64, 108, dtype=np.uint64)
        a, b = own[:100], own[8:]  # 92 of 108 in common
        assert (bands(sketch(a)) == bands(sketch(b))).any()


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert found(op11_minhash(spark, SF_DIR)) == brute_force(texts)


def test_near_copies_around_the_limit(docs_of):
    texts = near_copies(1)
    assert found(near_duplicates(docs_of(*texts))) == brute_force(dict(enumerate(texts)))


def test_large_buckets_are_compared_in_chunks(docs_of, monkeypatch):
    """One bucket holds all documents, few of which link with its pivot."""
    monkeypatch.setattr(minhash, "bands", lambda made: np.append(bands(made)[:-1], 1))
    monkeypatch.setattr(minhash, "CHUNK", 10)
    monkeypatch.setattr(minhash, "TASK_ROWS", 100)
    texts = near_copies(2)
    random.Random(3).shuffle(texts)
    assert found(near_duplicates(docs_of(*texts))) == brute_force(dict(enumerate(texts)))


def test_odd_rows(odd, no_docs):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    own = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert own[1] == (3, 1, True) and own[2] == own[3] == (3, 1, False)
    assert own[4] == (0, 4, True) and own[5] == (0, 5, True) and own[6] == (0, 6, True)
    assert own[8] == (1, 8, True) and own[9] == (1, 8, False)
    assert own[None] == (5, None, True)
    assert near_duplicates(no_docs).count() == 0


def test_parities_never_tell_more_differences_than_there_are():
    rng = np.random.default_rng(6)
    for extra in (0, 1, 40, 3000):
        a = rng.integers(0, 2**64, 500, dtype=np.uint64)
        b = np.concatenate([a[20:], rng.integers(0, 2**64, extra, dtype=np.uint64)])
        x, y = (np.frombuffer(minhash.parities(s), np.uint8) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= 20 + extra
