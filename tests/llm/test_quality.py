import inspect
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import quality
from tarmac.llm.quality import _fitted, classify_quality, gram_costs, op6_quality, perplexities, recurrence_grams, train
from tests.conftest import SF_DIR
from tests.llm.conftest import by_id


def plain_model(texts, order):
    """The same model in plain Python, over strings."""
    counts = [None] * (order + 1)
    counts[order] = Counter()
    for t in texts:
        t = " " * (order - 1) + " ".join(t.split())
        counts[order].update(t[i:i + order] for i in range(len(t) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    offs, totals, gone = {}, {}, {}
    for n in range(1, order + 1):
        many = Counter(counts[n].values())
        y = many[1] / (many[1] + 2 * many[2]) if many[1] + many[2] else None
        d = []
        for k in (1, 2, 3):
            e = k - (k + 1) * y * many[k + 1] / many[k] if many[k] and y is not None else 0
            d.append(e if 0 < e < k else 0.5)
        totals[n], gone[n] = defaultdict(float), defaultdict(float)
        offs[n] = lambda c, d=d: d[min(c, 3) - 1]
        for g, c in counts[n].items():
            totals[n][g[:-1]] += c
            gone[n][g[:-1]] += offs[n](c)
    unknown = 1 / (len(counts[1]) + 1)

    def p(g):
        if not g:
            return unknown
        n, context = len(g), g[:-1]
        if context not in totals[n]:
            return p(g[1:])
        c = counts[n].get(g, 0)
        return ((c - offs[n](c) if c else 0) + gone[n][context] * p(g[1:])) / totals[n][context]

    return p


def packed(g):
    n = 0
    for c in g:
        n = n << 16 | ord(c)
    return n - 2**64 if n >= 2**63 else n


def test_costs_equal_a_plain_model(spark, docs_of, folder):
    texts = ["the thin thing", "that then this there", "a thistle in the north", "on the other hand", "é 漢"] * 2 + ["only once"]
    p = plain_model(texts, 4)
    model = train(docs_of(*texts), folder)
    grams = ["the ", "thin", "xthe", "zzzz", " the", "then", "q th", "   t", "漢x￿?", "￿ the"[:4], "hand"]
    wanted = spark.createDataFrame([("en", packed(g)) for g in grams], "lang string, gram long")
    found = {r["gram"]: r["cost"] for r in gram_costs(wanted, model).collect()}
    assert found == pytest.approx({packed(g): -math.log(p(g)) for g in grams})
    # probabilities after a context add up to one, with one unknown character
    for context in ("the", "zzz"):
        chars = {c for t in texts for c in t} | {"ģ"}
        assert sum(p(context + c) for c in chars) == pytest.approx(1)


def test_query_rejects_junk_and_keeps_trusted_documents(spark):
    labels = spark.read.parquet(f"{SF_DIR}/../sf0.01/labels.parquet")
    rows = op6_quality(spark, f"{SF_DIR}/../sf0.01").join(labels, "doc_id").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(clean) >= 0.98 * len(clean)
    assert sum(junk) <= 0.15 * len(junk)


def test_query_rejects_each_kind_of_junk(spark):
    folder = f"{SF_DIR}/../sf0.1"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.split(F.trim("text"), r"\s+").alias("w"))

    def share(end):
        return F.size(F.filter("w", lambda x: x.rlike(end))) / F.size("w")

    again = F.size(F.filter(F.arrays_zip(F.expr("slice(w, 2, size(w))").alias("a"), F.expr("slice(w, 1, size(w) - 1)").alias("b")),
                            lambda x: x["a"] == x["b"])) / F.size("w")
    kind = F.when(again > 0.2, "repetition").when(share(r"\|$") > 0.2, "menu").when(share(r"!!$") > 0.3, "shout").when(
        share(r"[$%&#*]{3}$") > 0.3, "symbols").otherwise("other")
    kinds = texts.filter("size(w) > 1").select("doc_id", kind.alias("kind"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op6_quality(spark, folder).join(labels, "doc_id").join(kinds, "doc_id").collect()
    junk = Counter(r["kind"] for r in rows if r["quality"] == 0)
    kept = Counter(r["kind"] for r in rows if r["quality"] == 0 and r["kept"])
    for name in ("repetition", "menu", "shout", "symbols"):
        assert junk[name] > 100 and kept[name] <= 0.02 * junk[name], name
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(clean) >= 0.98 * len(clean)


def test_a_rare_language_is_judged_whatever_the_size_of_others(spark):
    docs = spark.read.parquet(f"{SF_DIR}/../sf0.01/documents.parquet").filter("lang = 'en'")
    labels = spark.read.parquet(f"{SF_DIR}/../sf0.01/labels.parquet")
    first = [r["doc_id"] for r in docs.join(labels.filter("quality = 1 AND toxic = 0"), "doc_id").orderBy("doc_id").limit(6).collect()]
    rare = F.col("doc_id").isin(first) | F.col("doc_id").isin([r["doc_id"] for r in labels.filter("quality = 0").collect()])
    docs = docs.withColumn("lang", F.when(rare, "xx").otherwise(F.col("lang")))
    rows = classify_quality(docs, labels, fit_docs=20).filter("lang = 'xx' AND chars > 0").collect()
    junk = [r for r in rows if r["doc_id"] not in first]
    assert len(junk) > 20 and all(r["threshold"] is not None for r in rows)
    assert sum(r["kept"] for r in junk) <= 0.1 * len(junk)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9])
def test_part_of_each_language_is_fitted_and_part_is_not(spark, count):
    own = spark.range(40).selectExpr("id AS doc_id", f"concat('l', id div {count}) AS lang").filter(f"id < {40 // count * count}")
    fitted = Counter(r["lang"] for r in _fitted(own, 2).collect())
    assert len(fitted) == 40 // count and all(1 <= n <= max(1, count - 1) for n in fitted.values())


def test_all_but_the_held_out_documents_are_fitted(spark):
    own = spark.range(40_000).selectExpr("id AS doc_id", "'xx' AS lang")
    held = {r["doc_id"] for r in own.filter(f"pmod(xxhash64(doc_id), {quality.HELD_OUT}) = 0").collect()}
    fitted = {r["doc_id"] for r in _fitted(own).collect()}
    # the last by hash is fitted and the first is not, whatever else
    assert len(fitted ^ (set(range(40_000)) - held)) <= 2 and len(fitted) > 29_000
    assert inspect.signature(classify_quality).parameters["fit_docs"].default is None


def test_the_pipeline_fits_on_all_but_the_held_out_documents(spark, monkeypatch):
    asked, plain = [], quality._fitted
    monkeypatch.setattr(quality, "_fitted", lambda own, fit_docs=None: asked.append(fit_docs) or plain(own, fit_docs))
    corpus_pipeline.quality_stage(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)
    assert asked == [None]


def test_each_block_asks_for_its_grams_once(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i}", "xx") for i in range(8)], "doc_id long, text string, lang string")
    grams = [spark.createDataFrame([("xx", 0, 0.5)], "lang string, gram long, p double"),
             spark.createDataFrame([("xx", 0, 0.5)], "lang string, context long, gamma double")]
    scores = perplexities(docs, {1: tuple(grams)}, 2)
    assert scores.count() == 8
    ran = scores._jdf.queryExecution().executedPlan()
    scores.collect()
    assert ran.toString().split("Initial Plan")[0].count("FlatMapGroupsInArrow") == 1


def test_recurrences_tell_how_far_back_a_word_stands():
    symbols = [g & 0xFFFF for g in recurrence_grams("a b a A c b d d " + " ".join(map(str, range(40))) + " a").tolist()]
    assert symbols == [1, 1, 3, 2, 1, 4, 1, 2] + [1] * 41
    assert recurrence_grams("x X").tolist() == [1 << 16 | 1, 1 << 16 | 2]
    assert len(recurrence_grams(" ")) == 0


def test_odd_rows(spark, odd, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (7, 1, 0), (7, 1, 0), (8, 1, 1), (9, 0, 0), (None, 1, 0), (3, None, None)],
        "doc_id long, quality long, toxic long").withColumn("place", F.lit("x"))
    found = by_id(classify_quality(odd, labels))
    assert sum(map(len, found.values())) == odd.count()
    assert all(r["kept"] for i in (4, 5, 6, 9, 10, None) for r in found[i])
    assert found[5][0]["perplexity"] is None
    assert classify_quality(no_docs, labels).count() == 0
    assert classify_quality(odd, labels.limit(0)).filter("NOT kept").count() == 0


def test_ids_beside_a_null_keep_their_digits(spark, docs_of):
    big = 2**53 + 1
    rows = [(big, "words of some text", "en"), (None, "other words", "en"), (-big, None, "en")]
    docs = spark.createDataFrame(rows * 150, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(big, 1, 0)], "doc_id long, quality int, toxic int")
    found = classify_quality(docs, labels).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in found} == {big: 150, None: 150, -big: 150}


def test_copies_of_a_row_fill_several_blocks(spark, folder):
    copies, others = [("same text here", "en")] * 1000, [(f"text {i}", "en") for i in range(50)]
    docs = spark.createDataFrame([(i if t != "same text here" else 7, t, g) for i, (t, g) in enumerate(copies + others)],
                                 "doc_id long, text string, lang string").coalesce(1)
    packed = docs.withColumn("block", F.xxhash64("doc_id", "text")).mapInArrow(
        quality._packed(16), "doc_id long, lang string, block int, text binary")
    assert packed.filter("doc_id = 7").select("block").distinct().count() == 10
    model = quality.train(docs, folder)
    scores = quality.perplexities(docs, model, 16).filter("doc_id = 7").collect()
    assert len(scores) == 1000 and len({r["perplexity"] for r in scores}) == 1
