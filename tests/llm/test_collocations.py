import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import collocations as module
from tarmac.llm.collocations import Filter, collocations, frequent_filters, phrase_counts


def plainly(rows, least=30, top=2000):
    """All phrases of (lang, text) spelled out and counted one by one."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i:i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    frequent = {p: n for p, n in counts.items() if n >= least}
    ranked = {}
    for (lang, *words), a in frequent.items():
        if len(words) < 2:
            continue
        cuts = [(frequent[lang, *words[:k]], frequent[lang, *words[k:]]) for k in range(1, len(words))]
        l, r = min(cuts, key=lambda c: 2_000_000 * a // (c[0] + c[1]))
        around = [n for (other, *longer), n in frequent.items() if other == lang and len(longer) > len(words)
                  and any(longer[i:i + len(words)] == words for i in range(len(longer)))]
        if all(100 * n < 80 * a for n in around):
            ranked.setdefault(lang, []).append((-(2_000_000 * a // (l + r)), -a, " ".join(words).encode(), l, r))
    return {
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, found in ranked.items() for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)}


def found(df):
    return [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


def spoken(seed, size):
    rng = random.Random(seed)
    words = ["The", "the", "of", "new", "york", "city", "é", "漢", "x1", "\x1cw", "É", "rare%d"]
    sentence = lambda: " ".join(
        (w % rng.randrange(200) if "%" in w else w) for w in rng.choices(words, k=rng.randint(0, 9)))
    fixed = ["new york city", "of the new", "New\tYork  City", "the the the the the"]
    marks = [". ", ",", ";x", "\n", "\r\n", "\x0b", "!?", ": "]
    return [(rng.choice(["en", "de", None, "und"]),
             "".join(rng.choice([sentence(), rng.choice(fixed)]) + rng.choice(marks) for _ in range(rng.randint(0, 30))))
            for _ in range(size)]


@pytest.mark.parametrize("run", [50, 1_000_000])
def test_equals_plain_counts(spark, monkeypatch, run):
    monkeypatch.setattr(module, "RUN_CHARS", run)
    rows = spoken(1, 60)
    docs = spark.createDataFrame(rows, "lang string, text string")
    for least, top in ((30, 2000), (3, 5)):
        told = found(collocations(docs, least, top))
        assert len(told) == len(set(told)) and set(told) == plainly(rows, least, top) and told


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With every bit set no window is cut short, with many parts of the filter all of them are found."""
    rows = spoken(2, 40)
    docs = spark.createDataFrame(rows, "lang string, text string")
    full = Filter(np.full(module.FEW_BITS // 8, 255, np.uint8))
    monkeypatch.setattr(module, "frequent_filters", lambda *_: (full, full))
    assert set(found(collocations(docs))) == plainly(rows)
    monkeypatch.setattr(module, "frequent_filters", frequent_filters)
    monkeypatch.setattr(module, "PART", 64)
    assert set(found(collocations(docs))) == plainly(rows)


def test_windows_are_cut_short(spark, folder):
    """Windows that hold no frequent pair are all counted as one row."""
    rows = [("en", " ".join(f"w{i}" for i in range(5000)))] + [("en", "a b c")] * 40
    docs = spark.createDataFrame(rows, "lang string, text string")
    few = module.windows(docs, frequent_filters(docs, folder, 30)).groupBy("w1", "w2", "w3", "w4").agg(F.sum("n").alias("n"))
    told = {(r["w1"], r["w2"], r["w3"]): r["n"] for r in few.collect()}
    assert told[("", "", "")] > 4000 and len(told) < 900 and told[("a", "b", "c")] == 40
    assert sum(told.values()) == 5120
    counts, totals = phrase_counts(docs, folder)
    assert counts.count() == 6 and [tuple(r) for r in totals.collect()] == [("en", 5120)]


def test_odd_rows(spark, odd, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert set(found(collocations(odd, 2))) == plainly(rows, 2)
    assert collocations(no_docs).count() == 0
    many = spark.createDataFrame([(None, "a a a")] * 40 + [("en", None), ("fr", " \t")], "lang string, text string")
    assert found(collocations(many)) == [("und", 1, "a a", 80, 120, 120, 120, 666666), ("und", 2, "a a a", 40, 120, 80, 120, 400000)]
