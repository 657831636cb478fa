"""Operator 6: quality classifier, interpolated modified Kneser-Ney models of characters and of recurring words."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import lean, release_memory, ship, table, text_rows, work_folder, written

ORDER = 4
SEED = 5
#: One trusted document in HELD_OUT is kept from the fit; these set the thresholds, all others are fitted.
HELD_OUT = 4
#: With fewer held-out documents a language's own quantile is uncertain, and that of all languages counts if it is
#: higher (`few` of classify_quality; 0 goes by each language's own quantile alone).
FEW = 50
#: Share of a language's trusted documents beyond which a perplexity is too high, and a margin on it.
QUANTILE, MARGIN = 0.98, 1.1
#: The mean over few units scatters more: that of so many units twice as far, squared, as that of a long text.
SHORT_CHARS, SHORT_WORDS = 100, 50
BLOCK_CHARS = 16_000_000
#: Fitted documents up to so many (16 bytes each) are broadcast; beyond, their table is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Copies of a row that one task deals into one block; further ones go to other blocks.
COPIES = 100
PENDING = 500_000
GRAM = "lang string, gram long, count long"
#: Ending of the name under which a language's word recurrences are a language of their own.
RECURRENCES = "\x01words"
#: Words further back than this count as not repeated.
NEAR = 32
#: Symbol of each distance.
STEPS = np.array([0] + [2 + (n - 1).bit_length() for n in range(1, NEAR + 1)])


def character_grams(text: str, order: int = ORDER) -> np.ndarray:
    """All grams of a text as 64-bit numbers, 16 bits per character, the last one lowest.

    White space of any kind and length counts as one blank, and the text starts with blanks.
    Characters beyond 16 bits count as the replacement character.
    """
    text = " " * (order - 1) + " ".join(text.split())
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    codes[codes > 0xFFFF] = 0xFFFD
    count = len(codes) - order + 1
    grams = np.zeros(max(count, 0), np.uint64)
    for i in range(order if count > 0 else 0):
        grams = grams << np.uint64(16) | codes[i:i + count]
    return grams.view(np.int64)


def recurrence_grams(text: str) -> np.ndarray:
    """Pairs of neighbouring symbols, one symbol per word: how far back the same word stands.

    2 repeats the word before it, 3 the one before that, 4 a word 3 or 4 back, and so on by
    doubling distances up to NEAR; 1 is a word that does not stand so near, and what precedes the
    text. Case makes no difference. A text that repeats a few words is a run of symbols that
    trusted texts hardly have, however ordinary its characters are.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    # hashes of this process, which are only compared with each other
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    at = np.argsort(codes, kind="stable")
    gap = np.diff(at)
    near = (codes[at[1:]] == codes[at[:-1]]) & (gap <= NEAR)
    symbols = np.ones(len(words) + 1, np.int64)
    symbols[1 + at[1:][near]] = STEPS[gap[near]]
    return symbols[:-1] << 16 | symbols[1:]


def _streams(lang: str | None, text: str):
    """The two sequences of a text with the names of their models."""
    yield lang, character_grams(text)
    if lang is not None:
        yield lang + RECURRENCES, recurrence_grams(text)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and their added counts."""
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([c for _, c in parts]), minlength=len(grams))
    return grams, counts.astype(np.int64)


def _grams(langs, texts) -> dict:
    """Per language: distinct grams and counts, made distinct every PENDING grams to bound the memory."""
    found: dict = {}
    sizes: dict = {}
    for lang, text in zip(langs, texts):
        for name, grams in _streams(lang, text or ""):
            parts = found.setdefault(name, [])
            parts.append(np.unique(grams, return_counts=True))
            sizes[name] = sizes.get(name, 0) + len(parts[-1][0])
            if sizes[name] > PENDING:
                found[name], sizes[name] = [_merged(parts)], 0
    return {lang: _merged(parts) for lang, parts in found.items()}


def _plain(column: pa.Array):
    return (value.as_py() for value in column)


def _count_grams(batches):
    for batch in batches:
        for lang, (grams, counts) in _grams(_plain(batch.column("lang")), _plain(batch.column("text"))).items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "count"])


def _context(gram: str = "gram") -> F.Column:
    return F.shiftrightunsigned(gram, 16)


def _suffix(order: int, gram: str = "gram") -> F.Column:
    """The gram of order - 1 at the end of a gram of this order."""
    return F.col(gram).bitwiseAND((1 << 16 * (order - 1)) - 1)


def train(docs: DataFrame, folder: str, order: int = ORDER) -> dict[int, tuple[DataFrame, DataFrame]]:
    """Model tables by order: probabilities (lang, gram, p) and back-off weights (lang, context, gamma).

    The highest order counts occurrences, lower ones count distinct characters seen before the
    gram. Each order has three discounts per language from its counts of counts. Probabilities
    are interpolated down to the uniform one over the language's characters.
    """
    counts = {order: written(
        docs.select("lang", "text").mapInArrow(lean(_count_grams), GRAM).groupBy("lang", "gram").agg(F.sum("count").alias("count")),
        folder, "grams")}
    for n in range(order - 1, 0, -1):
        counts[n] = written(
            counts[n + 1].groupBy("lang", _suffix(n + 1).alias("gram")).agg(F.count("*").alias("count")), folder, f"grams{n}")
    lower = counts[1].groupBy("lang").agg((F.lit(1.0) / (F.count("*") + 1)).alias("p")).withColumn("gram", F.lit(0).cast("long"))
    model = {}
    for n in range(1, order + 1):
        times = [F.count(F.when(F.col("count") == k, 1)).cast("double") for k in range(1, 5)]
        many = counts[n].groupBy("lang").agg(*[t.alias(f"n{k}") for k, t in enumerate(times, 1)])
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def discount(k: int) -> F.Column:
            exact = k - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}"))
            # counts of counts of a small corpus may miss a step; then half a count is taken off
            return F.when((exact > 0) & (exact < k), exact).otherwise(F.lit(0.5)).alias(f"d{k}")

        discounts = many.select("lang", *[discount(k) for k in (1, 2, 3)])
        off = F.element_at(F.array("d1", "d2", "d3"), F.least("count", F.lit(3)).cast("int"))
        seen = counts[n].join(discounts, "lang").select("lang", "gram", "count", off.alias("off"), _context().alias("context"))
        contexts = written(
            seen.groupBy("lang", "context").agg(F.sum("count").alias("total"), F.sum("off").alias("gone")), folder, f"contexts{n}")
        shares = (
            seen.join(contexts, ["lang", "context"])
            .select("lang", "gram", _suffix(n).alias("shorter"), "total", "gone", (F.col("count") - F.col("off")).alias("rest"))
            .join(lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("shorter_p")), ["lang", "shorter"])
        )
        p = written(shares.select("lang", "gram", ((F.col("rest") + F.col("gone") * F.col("shorter_p")) / F.col("total")).alias("p")), folder, f"p{n}")
        model[n] = (p, contexts.select("lang", "context", (F.col("gone") / F.col("total")).alias("gamma")))
        lower = p
    return model


def gram_costs(wanted: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """lang, gram, cost: minus the logarithm of each gram's probability, by joins with the count tables.

    A gram that was not seen takes its suffix's probability times the weights of the contexts
    that were seen; a character that was never seen, the uniform share of the unknown.
    """
    top = max(model)
    found = wanted.withColumns({"weight": F.lit(1.0), "p": F.lit(None).cast("double")})
    for n in range(top, 0, -1):
        own = F.col("gram").bitwiseAND((1 << 16 * n) - 1 if n < 4 else -1)
        p, gammas = model[n]
        found = found.withColumns({"own": own, "context": F.shiftrightunsigned(own, 16)})
        found = (
            found.join(p.select("lang", F.col("gram").alias("own"), F.col("p").alias("own_p")), ["lang", "own"], "left")
            .join(gammas, ["lang", "context"], "left")
            .select(
                "lang", "gram", F.coalesce("p", F.col("weight") * F.col("own_p")).alias("p"),
                (F.col("weight") * F.coalesce("gamma", F.lit(1.0))).alias("weight"))
        )
    chars = model[1][0].groupBy("lang").agg((F.lit(1.0) / (F.count("*") + 1)).alias("unknown"))
    return found.join(chars, "lang").select(
        "lang", "gram", (-F.log(F.coalesce("p", F.col("weight") * F.col("unknown")))).alias("cost"))


def _packed(blocks: int):
    """Texts compressed for the shuffle, one by one, and the hash in column block turned into a block's number."""
    def pack(batches):
        copies: dict[int, int] = {}
        for batch in batches:
            dealt = []
            for h in batch.column("block").to_pylist():
                before = copies.get(h, 0)
                copies[h] = before + 1
                dealt.append((h + before // COPIES) % blocks)
            if len(copies) > 500_000:
                copies = {}
            texts = pa.array((zlib.compress(t.encode("utf-8"), 3) for t in _plain(batch.column("text"))), pa.binary())
            names = [n for n in batch.schema.names if n not in ("block", "text")]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(dealt, pa.int32()), texts], names=[*names, "block", "text"])

    return lean(pack)


def _unpacked(texts):
    """The texts of a column, one at a time."""
    return (zlib.decompress(text).decode("utf-8") for text in _plain(texts))


def perplexities(docs: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]], blocks: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, lang, chars, perplexity, words, word_perplexity (of the words' recurrences), and columns to carry along.

    Perplexities are null for a language that the model has not seen.

    Documents are dealt into blocks, copies of one row over as many as they fill. Each block asks
    for the costs of its distinct grams, the joins with the sharded tables answer, and the
    block's texts are scored with its answers. What is asked grows with the corpus; what a task
    holds is one block and its answers. Both sides use one shuffle of the texts. Identifiers and
    columns to carry along pass as they are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    carried = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carry)
    rows = text_rows(docs, "lang", *carry).withColumn("block", F.xxhash64("doc_id", "text"))
    dealt = rows.mapInArrow(_packed(blocks), f"doc_id {kind}, lang string, {carried}block int, text binary")

    def ask(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        parts = [
            pa.table({"block": pa.array(np.full(len(grams), block, np.int32)),
                      "lang": pa.array([lang] * len(grams), pa.string()), "gram": pa.array(grams)})
            for lang, (grams, _) in _grams(_plain(rows.column("lang")), _unpacked(rows.column("text"))).items()
        ]
        release_memory()
        return pa.concat_tables(parts)

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        costs = {}
        for lang in pc.unique(answers.column("lang")).to_pylist():
            part = answers.filter(pc.equal(answers.column("lang"), lang))
            grams, cost = part.column("gram").to_numpy(), part.column("cost").to_numpy()
            order = np.argsort(grams)
            costs[lang] = grams[order], cost[order]
        sizes, found = {"chars": [], "words": []}, {"chars": [], "words": []}
        for lang, text in zip(_plain(rows.column("lang")), _unpacked(rows.column("text"))):
            for unit, name, grams in (("chars", lang, character_grams(text)),
                                      ("words", f"{lang}{RECURRENCES}", recurrence_grams(text))):
                sizes[unit].append(len(grams))
                if name in costs and len(grams):
                    known, cost = costs[name]
                    found[unit].append(float(np.exp(cost[np.searchsorted(known, grams)].mean())))
                else:
                    found[unit].append(None)
        release_memory()
        return pa.table({
            "doc_id": rows.column("doc_id"), "lang": rows.column("lang"), **{c: rows.column(c) for c in carry},
            "chars": pa.array(sizes["chars"], pa.int64()), "perplexity": pa.array(found["chars"], pa.float64()),
            "words": pa.array(sizes["words"], pa.int64()), "word_perplexity": pa.array(found["words"], pa.float64())})

    # both uses read every column of one shuffle, so that each block asks once
    asked = dealt.groupBy("block").applyInArrow(ask, "block int, lang string, gram long").repartition("lang", "gram")
    wanted = asked.groupBy("lang", "gram").agg(F.min("block").alias("first")).filter("first IS NOT NULL").select("lang", "gram")
    answered = asked.join(gram_costs(wanted, model), ["lang", "gram"])
    return dealt.groupBy("block").cogroup(answered.select("block", "lang", "gram", "cost").groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, lang string, {carried}chars long, perplexity double, words long, word_perplexity double")


#: The perplexity of each unit and where its mean counts as short.
UNITS = {"chars": ("perplexity", SHORT_CHARS), "words": ("word_perplexity", SHORT_WORDS)}


def _scatter(unit: str) -> F.Column:
    return F.sqrt(1 + UNITS[unit][1] / F.greatest(unit, F.lit(1)))


def _limits(judges: DataFrame, few: int) -> DataFrame:
    """Per language and unit: the middle of the logarithms of perplexities and how far above it they go, over _scatter."""
    def most(column: F.Column, share: float) -> F.Column:
        return F.percentile_approx(column, share, 100_000)

    middles = judges.groupBy("lang").agg(*[most(F.log(p), 0.5).alias(f"{u}_middle") for u, (p, _) in UNITS.items()])
    above = judges.join(middles, "lang").select("lang", *[f"{u}_middle" for u in UNITS], *[
        ((F.log(p) - F.col(f"{u}_middle")) / _scatter(u)).alias(f"{u}_above") for u, (p, _) in UNITS.items()])
    spreads = [most(F.col(f"{u}_above"), QUANTILE).alias(f"{u}_spread") for u in UNITS]
    own = above.groupBy("lang").agg(
        F.count("*").alias("judges"), *[F.first(f"{u}_middle").alias(f"{u}_middle") for u in UNITS], *spreads)
    # one row
    overall = above.agg(*spreads)
    o, a = own.alias("o"), overall.alias("a")
    return o.crossJoin(F.broadcast(a)).select("lang", *[f"{u}_middle" for u in UNITS], *[
        F.when(F.col("judges") < few, F.greatest(f"o.{u}_spread", f"a.{u}_spread")).otherwise(F.col(f"o.{u}_spread")).alias(f"{u}_spread")
        for u in UNITS])


def _fitted(own: DataFrame, fit_docs: int | None = None) -> DataFrame:
    """The rows of own (doc_id, lang) to fit: all that are not held out; with `fit_docs`, about so many of each language.

    Of two or more documents of a language at least one is fitted and one is not.
    """
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    own = own.withColumns({"hash": F.xxhash64("doc_id"), "held": held})
    share = F.lit(1.0)
    if fit_docs is not None:
        share = F.least(share, fit_docs / F.greatest(F.count_if(~F.col("held")), F.lit(1)))
    counts = own.groupBy("lang").agg(
        F.min("hash").alias("first"), F.max("hash").alias("last"), (share * (1 << 30)).alias("limit"))
    drawn = ~F.col("held") & (F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) < F.col("limit"))
    return own.join(counts, "lang").filter(
        (F.col("hash") == F.col("last")) | drawn & (F.col("hash") != F.col("first"))).select("doc_id", "lang")


def classify_quality(docs: DataFrame, labels: DataFrame, fit_docs: int | None = None, order: int = ORDER,
                     carry: tuple[str, ...] = (), few: int = FEW) -> DataFrame:
    """Per row: doc_id, lang, chars, perplexity, threshold, words, word_perplexity, word_threshold, kept,
    and columns to carry along.

    The models of a language are fitted on all its trusted documents (quality 1, not toxic) but one
    in HELD_OUT (only with `fit_docs`, on about so many of them). The two thresholds of a language, for
    character 4-grams and for recurring words, are quantiles over all its trusted documents
    outside the fit, with a margin (of all languages' if it has fewer than `few` and theirs is higher); those of short texts are as much wider as their means
    scatter more. A document above either goes. Words are told apart by white space, so in
    texts without any, repetition is not seen.

    Kept without a verdict: null or empty texts, and languages (null too) with fewer than two
    trusted documents, of which one is fitted and one judged. Repeated doc_ids are rows like others; a doc_id that is labelled more than once
    is trusted if all its labels say so. Empty tables give an empty result. Columns other than
    doc_id, text, lang, and of labels doc_id, quality, toxic, are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = work_folder(spark, "quality")
    trusted = written(
        labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .filter("quality = 1 AND toxic = 0").select("doc_id"),
        folder, "trusted")
    # blank texts are nothing to fit or judge by
    own = written(
        docs.filter("lang IS NOT NULL AND length(trim(text)) > 0").select("doc_id", "lang").join(trusted, "doc_id").distinct(),
        folder, "own")
    fitted = written(_fitted(own, fit_docs), folder, "fitted")
    # its size is checked, as there is no bound on languages
    fitted = F.broadcast(fitted) if fitted.count() <= BROADCAST_ROWS else fitted
    model = train(docs.select("doc_id", "text", "lang").join(fitted, ["doc_id", "lang"], "left_semi"), folder, order)
    total = docs.agg(F.sum(F.length("text"))).collect()[0][0] or 0
    scores = written(perplexities(docs, model, max(1, -(-total // BLOCK_CHARS)), carry), folder, "scores")
    judges = scores.filter("perplexity IS NOT NULL").join(trusted, "doc_id").join(
        fitted, ["doc_id", "lang"], "left_anti")
    limits = written(_limits(written(judges, folder, "judges"), few), folder, "limits")
    s, t = scores.alias("s"), limits.alias("t")
    s = s.join(t, F.col("s.lang") == F.col("t.lang"), "left").select("s.*", *[
        (F.exp(F.col(f"{u}_middle") + F.col(f"{u}_spread") * _scatter(u)) * MARGIN).alias(f"{u}_high") for u in UNITS])
    kept = (F.col("perplexity") <= F.col("chars_high")) & (F.col("word_perplexity") <= F.col("words_high"))
    return s.select(
        "doc_id", "lang", "chars", "perplexity", F.col("chars_high").alias("threshold"),
        "words", "word_perplexity", F.col("words_high").alias("word_threshold"),
        F.coalesce(kept, F.lit(True)).alias("kept"), *carry)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
