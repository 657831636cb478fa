import random
from collections import defaultdict

import pytest

from tarmac.llm import jaccard
from tarmac.llm.graph import components
from tarmac.llm.jaccard import jaccard_components, op8_jaccard, prefix_size
from tests.conftest import SF_DIR


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def smallest(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute_force(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    common, columns = defaultdict(int), defaultdict(list)
    for i, s in sets.items():
        for x in s:
            for j in columns[x]:
                common[j, i] += 1
            columns[x].append(i)
    links = [p for p, n in common.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    comp = smallest(texts, links)
    return {i: (len(sets[i]), comp[i]) for i in texts}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert found(op8_jaccard(spark, SF_DIR)) == brute_force(texts)


@pytest.fixture
def small_blocks(monkeypatch):
    """So small that every column is hot, dealt over blocks, cut into chunks and compared in many tasks."""
    for name, value in {"BLOCK": 200, "HOT_COLUMN": 3, "CHUNK": 4, "TASK_ROWS": 50, "SHORT_COLUMN": 3}.items():
        monkeypatch.setattr(jaccard, name, value)


def near_copies(seed):
    """Groups with edits around the limit, all with one common passage, chains of copies, exact copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(6):
        base = passage + [word() for _ in range(rng.randint(5, 80))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
        step = list(base)
        for _ in range(5):  # each near the one before
            step[rng.randrange(len(step))] = word()
            texts.append(" ".join(step))
    texts += ["a b c d", "A B  C D", "a b c d e", "", " "]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_around_the_limit(docs_of, seed):
    texts = near_copies(seed)
    assert found(jaccard_components(docs_of(*texts))) == brute_force(dict(enumerate(texts)))


def test_hot_columns_in_small_blocks(docs_of, small_blocks):
    texts = near_copies(3)
    assert found(jaccard_components(docs_of(*texts))) == brute_force(dict(enumerate(texts)))


def test_prefixes_are_long_enough():
    for n in range(1, 200):
        for m in range(n, 300):
            overlap = -(-3 * (n + m) // 7)  # the least that links
            if overlap <= n:
                assert n - prefix_size(n) < overlap and m - prefix_size(m) < overlap


def test_components(spark, folder):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(500, 500)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    ids = {i for link in links if link[0] != link[1] for i in link}
    assert {r["id"]: r["comp"] for r in components(df, folder, "t").collect()} == {
        i: c for i, c in smallest(ids | {500}, links).items() if i != 500}


def test_odd_rows(odd, no_docs):
    rows = jaccard_components(odd).collect()
    assert len(rows) == odd.count()
    own = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert own[2] == (3, 1) and own[3] == (3, 1)
    assert own[4] == (0, 4) and own[5] == (0, 5) and own[6] == (0, 6)
    assert own[8] == (1, 8) and own[9] == (1, 8)
    assert own[None] == (5, None)
    assert jaccard_components(no_docs).count() == 0
