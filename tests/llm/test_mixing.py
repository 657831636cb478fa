import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm.mixing import fit_budget, mix_sources, op1_mixing, source_targets
from tests.conftest import SF_DIR
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, share, most):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return full
        level = (budget - sum(full.values())) / sum(weigh[s] for s in open_)
        over = [s for s in open_ if weigh[s] * level > most * sizes[s]]
        if not over:
            return full | {s: weigh[s] * level for s in open_}
        full |= {s: float(most * sizes[s]) for s in over}


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = {rng.choice("abcdefgh") + str(i): rng.choice([0, 1, 5, 100, 1000]) for i in range(9)} | {None: 40}
        rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        found = {r["source"]: r["target"] for r in source_targets(rows).collect()}
        assert found == pytest.approx(filled(sizes, (3, 1, 2), 1.5, 2))


def test_budget_is_met_as_well_as_by_trying_all_subsets():
    rng = random.Random(1)
    for _ in range(200):
        sizes = sorted(rng.sample(range(0, 30), 4))
        counts = [rng.randint(0, 3) for _ in sizes]
        budget = rng.randint(0, 60)
        taken = fit_budget(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        sums = {sum(s * k for s, k in zip(sizes, ks)) for ks in itertools.product(*(range(c + 1) for c in counts))}
        got, best = sum(s * t for s, t in zip(sizes, taken)), min(abs(x - budget) for x in sums)
        # the start in proportion may cost a little, never more than one document
        assert abs(got - budget) <= best + max(sizes)
        if max(counts) == 1:
            assert abs(got - budget) == best


def test_large_budgets_are_met_exactly():
    rng = random.Random(2)
    sizes = sorted(rng.sample(range(1, 5000), 300))
    counts = [rng.randint(1, 500) for _ in sizes]
    total = sum(s * c for s, c in zip(sizes, counts))
    for budget in (0, 1, total // 3, total // 2 + 1, total, total + 5):
        taken = fit_budget(sizes, counts, budget)
        got = sum(s * t for s, t in zip(sizes, taken))
        assert got == min(budget, total) or budget < sizes[0]


def test_query_takes_each_source_to_its_target(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op1_mixing(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    taken, targets, sizes, sums = {}, {}, {}, {}
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == len(WORD.findall(docs[r["doc_id"]]["text"] or ""))
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[source] = taken.get(source, 0) + r["taken"]
        sizes[source] = sizes.get(source, 0) + r["size"]
        targets[source] = r["target"]
        sums[source] = {s + k * r["size"] for s in sums.get(source, {0}) for k in (0, 1)}
        assert r["source_size"] >= r["size"]
    assert targets == pytest.approx(filled(sizes, (3, 1, 2), 1.5, 2))
    for source, target in targets.items():
        rest = target % sizes[source] if target < 2 * sizes[source] else 0
        best = min(abs(s - rest) for s in sums[source])
        assert abs(target - taken[source]) <= best + 1 + 0.002 * target
    assert sorted(rows) == sorted(op1_mixing(spark, SF_DIR).collect())


def test_one_length_of_one_source_is_cut_exactly(spark):
    rows = [(i, "w w w", "only") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix_sources(docs).groupBy("copies").count().collect()
    assert {r["copies"]: r["count"] for r in found} == {1: 1500, 2: 1500}


def test_odd_rows(odd, no_docs):
    found = by_id(mix_sources(odd))
    assert sum(map(len, found.values())) == odd.count()
    assert [r["size"] for r in found[5] + found[4] + found[6]] == [0, 0, 0]
    assert found[7][0]["size"] == 36000
    assert len(found[1]) == 2 and len(found[None]) == 1
    assert mix_sources(no_docs).count() == 0
    assert mix_sources(odd.withColumn("text", F.lit(None).cast("string"))).filter("taken <> 0").count() == 0
