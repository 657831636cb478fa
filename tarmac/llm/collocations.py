"""Operator 13: phrase collocations; only windows of full length are counted, Spark's ROLLUP sums their beginnings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import ship, table, work_folder, written

#: Words of the longest phrases, least count of a phrase, and phrases returned per language.
WINDOW, LEAST, TOP = 4, 30, 2000
SCALE = 2_000_000
#: A phrase goes if a longer one around it has this share (of 100) of its count.
INSIDE = 80
UNKNOWN = "und"
#: Characters of text whose windows are made distinct at once.
RUN_CHARS = 1_000_000
#: Bits of a filter of frequent phrases: 16 for each, within these bounds; when it fills up, more pass.
FEW_BITS, MOST_BITS = 1 << 16, 1 << 27
#: Bytes of one part of the filter.
PART = 1 << 16

#: The marks that end a piece become one of them, a tab a blank.
_MARK = b"."
_TABLE = bytes.maketrans(b".,;:!?\n\v\f\r\t", _MARK * 10 + b" ")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_END = xxhash.xxh3_64_intdigest(_MARK)


def _words(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with a mark between pieces."""
    return text.encode("utf-8").lower().translate(_TABLE).replace(_MARK, b" . ").split()


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(31))) * _MIX[0] + b
    h = (h ^ (h >> np.uint64(29))) * _MIX[1]
    return h ^ (h >> np.uint64(32))


def _runs(batch: pa.RecordBatch):
    """(lang, words) of about RUN_CHARS of a language at a time, each text followed by a mark."""
    held: dict[str, tuple[list[bytes], int]] = {}
    for lang, text in zip(batch.column("lang"), batch.column("text")):
        lang, text = lang.as_py(), text.as_py()
        words, size = held.get(lang, ([], 0))
        words += _words(text)
        words.append(_MARK)
        held[lang] = words, size + len(text)
        if size + len(text) >= RUN_CHARS:
            yield lang, words
            del held[lang]
    for lang, (words, _) in held.items():
        yield lang, words


class Hashed:
    """Hashes of the words of a run and of the pairs and triples that begin at each place and lie within a piece."""

    def __init__(self, lang: str, words: list[bytes]):
        seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8"))
        raw = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.word = raw != np.uint64(_END)
        # a word may share the hash of the mark, which decides nothing
        for at in np.flatnonzero(~self.word).tolist():
            self.word[at] = words[at] != _MARK
        one = _mixed(raw, np.full(len(raw), seed, np.uint64))
        two = _mixed(one, _following(one))
        self.one, self.two, self.three = _mixed(one, np.uint64(WINDOW)), two, _mixed(two, _following(_following(one)))
        self.pair = self.word & _following(self.word)


def _following(values: np.ndarray) -> np.ndarray:
    """Each value's next one; nothing follows the last."""
    return np.append(values[1:], values.dtype.type(0))


class Filter:
    """Bits by hash. What was put in is known; little else is, unless the filter is full."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def knows(self, h: np.ndarray) -> np.ndarray:
        at = (h & np.uint64(8 * len(self.bits) - 1)).astype(np.int64)
        return self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def _counted(texts: DataFrame, hashes) -> DataFrame:
    """Hashes (h) that hashes(run) gives for the runs of all texts, and their counts (n), distinct within a run."""
    def count(batches):
        for batch in batches:
            for lang, words in _runs(batch):
                found, counts = np.unique(hashes(Hashed(lang, words)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["h", "n"])

    return texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def frequent_filter(counted: DataFrame, folder: str, name: str, least: int) -> Filter:
    """A filter of all hashes that are counted `least` times or more.

    What shares a hash is counted together, so no frequent phrase is missed. The bits are put
    together by Spark in parts and are MOST_BITS at most, however many phrases there are; others
    that share a bit pass too, which costs time and no result.
    """
    frequent = written(counted.filter(F.col("n") >= least).select("h"), folder, name)
    bits, count = FEW_BITS, frequent.count()
    while bits < min(MOST_BITS, 16 * count):
        bits *= 2
    size = min(PART, bits // 8)

    def part(key: tuple, hashes: pa.Table) -> pa.Table:
        made = np.zeros(8 * size, bool)
        made[hashes.column("place").to_numpy() % (8 * size)] = True
        packed = np.packbits(made, bitorder="little").tobytes()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([packed], pa.binary())})

    place = frequent.select(F.col("h").bitwiseAND(bits - 1).alias("place")).distinct()
    parts = place.withColumn("part", F.shiftright("place", (8 * size).bit_length() - 1).cast("int"))
    found = {r["part"]: r["bits"] for r in parts.groupBy("part").applyInArrow(part, "part int, bits binary").collect()}
    return Filter(np.frombuffer(b"".join(found.get(i, bytes(size)) for i in range(bits // 8 // size)), np.uint8))


def frequent_filters(texts: DataFrame, folder: str, least: int) -> tuple[Filter, Filter]:
    """Filters of the frequent words and pairs, and of the frequent triples, which are counted where both pairs are frequent."""
    short = frequent_filter(
        _counted(texts, lambda run: np.concatenate([run.one[run.word], run.two[run.pair]])), folder, "frequent", least)
    held = texts.sparkSession.sparkContext.broadcast(short)

    def triples(run: Hashed) -> np.ndarray:
        goes_on = run.pair & held.value.knows(run.two)
        return run.three[goes_on & _following(goes_on)]

    return short, frequent_filter(_counted(texts, triples), folder, "triples", least)


_COLUMNS = [f"w{i}" for i in range(1, WINDOW + 1)]


def windows(texts: DataFrame, filters: tuple[Filter, Filter]) -> DataFrame:
    """lang, w1 to w4, n: the window that begins at each word, counted within a run.

    A window ends early, filled up with empty words, at the end of its piece and before a word
    that makes a rare pair or triple with those before it, as no frequent phrase goes on there.
    A rare word's own window is all empty: it only counts as a word.
    """
    held = texts.sparkSession.sparkContext.broadcast(filters)

    def lead(batches):
        short, long = held.value
        for batch in batches:
            for lang, words in _runs(batch):
                run = Hashed(lang, words)
                pair = run.pair & short.knows(run.two)
                triple = pair & _following(pair) & long.knows(run.three)
                at = np.flatnonzero(run.word)
                none = len(words)  # the place of the empty word
                key, columns = np.zeros(len(at), np.uint64), []
                alive = short.knows(run.one[at])
                # whether the window goes on to its second word, its third and its fourth
                for i, goes_on in enumerate((pair, triple, _following(triple), None)):
                    place = np.minimum(at + i, none - 1)
                    columns.append(np.where(alive, place, none))
                    key = _mixed(key, np.where(alive, run.one[place], np.uint64(0)))
                    if goes_on is not None:
                        alive = alive & goes_on[at]
                _, first, counts = np.unique(key, return_index=True, return_counts=True)
                texts = pa.array([*words, b""], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(first), pa.string()),
                     *[texts.take(pa.array(c[first])).cast(pa.string()) for c in columns], pa.array(counts)],
                    names=["lang", *_COLUMNS, "n"])

    return texts.mapInArrow(lead, "lang string, " + ", ".join(f"{c} string" for c in _COLUMNS) + ", n long")


def phrase_counts(docs: DataFrame, folder: str, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all phrases of 1 to 4 words with f >= least, and (lang, n) of all words."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    # each distinct window once before it is rolled up, as most of them lie in every task
    counted = written(
        windows(texts, frequent_filters(texts, folder, least)).groupBy("lang", *_COLUMNS).agg(F.sum("n").alias("n")), folder, "windows")
    sums = counted.rollup("lang", *_COLUMNS).agg(F.grouping_id().alias("level"), F.sum("n").alias("f"))
    # a bit of the level for each column that is summed away, the last one lowest
    length = F.lit(WINDOW) - F.bit_count("level")
    told = written(
        sums.withColumn("length", length).filter(F.col("length") >= 0)
        .withColumn("words", F.slice(F.array(*_COLUMNS), 1, F.greatest("length", F.lit(1))))
        .filter((F.col("length") == 0) | (F.col("f") >= least) & (F.element_at("words", -1) != ""))
        .select("lang", "length", F.when(F.col("length") > 0, F.col("words")).alias("words"), "f"),
        folder, "counts")
    return told.filter("length > 0").select("lang", "words", "f"), told.filter("length = 0").select("lang", F.col("f").alias("n"))


def _exact(value) -> F.Column:
    return F.col(value).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP) -> DataFrame:
    """Per language the phrases of 2 to 4 words that hold together best: lang, rank, phrase, a, l, r, n, score.

    Words are runs of other than blank and tab between the marks `.,;:!?` and line ends, A-Z
    lower-cased. A phrase occurs a times, within pieces between marks, overlaps included. Cut
    in two it scores floor(2000000 * a / (l + r)) with the counts of both parts; the worst cut
    counts, at equal scores the first. Phrases inside a longer frequent one that has 80 % of
    their count are left out. The first `top` of each language by score, then count, then
    phrase are returned; None returns all.

    Null text counts as empty, null lang as `und`. Repeated rows are documents like others. A
    language without frequent phrases and an empty table give no rows. Columns other than lang
    and text are not read. Words stay apart by their letters; hashes only decide which windows
    are cut short, never for a frequent phrase.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = work_folder(spark, "collocations")
    counts, totals = phrase_counts(docs, folder, least)
    phrases = counts.filter("size(words) > 1")
    cuts = phrases.select(
        "lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    part = lambda name: counts.select("lang", F.col("words").alias(f"{name}_words"), F.col("f").alias(name))
    cuts = (
        cuts.withColumns({
            "l_words": F.slice("words", F.lit(1), F.col("k")),
            "r_words": F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))})
        .join(part("l"), ["lang", "l_words"]).join(part("r"), ["lang", "r_words"])
        .withColumn("score", F.expr(f"(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    )
    worst = cuts.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "words", "cut.*")
    # the contiguous parts of each longer phrase, of two words or more
    inner = phrases.filter("size(words) > 2").select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))"
    )).alias("words")).groupBy("lang", "words").agg(F.max("f").alias("around"))
    kept = worst.join(inner, ["lang", "words"], "left").filter(
        F.col("around").isNull() | (100 * _exact("around") < INSIDE * _exact("a")))
    order = "PARTITION BY lang ORDER BY score DESC, a DESC, phrase"
    ranked = kept.withColumn("phrase", F.array_join("words", " ")).withColumn("rank", F.expr(f"row_number() OVER ({order})").cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
    SELECT lang, unnest(w) AS w1, unnest(list_concat(w[2:], [NULL])) AS w2,
        unnest(list_concat(w[3:], [NULL, NULL])) AS w3, unnest(list_concat(w[4:], [NULL, NULL, NULL])) AS w4
    FROM split
), grams AS (
    SELECT lang, unnest([1, 2, 3, 4]) AS k,
        unnest([w1, w1 || ' ' || w2, w1 || ' ' || w2 || ' ' || w3, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4]) AS phrase
    FROM starts WHERE w1 IS NOT NULL
), f AS MATERIALIZED (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS w, CAST(count(*) AS HUGEINT) AS f
    FROM grams WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
), halves AS MATERIALIZED (
    SELECT lang, phrase, f, v.k AS cut_at,
        array_to_string(w[1:v.k], ' ') AS first_words, array_to_string(w[v.k + 1:], ' ') AS last_words
    FROM f JOIN (VALUES (1), (2), (3)) AS v(k) ON v.k < f.k
), cuts AS (
    SELECT h.lang, h.phrase, h.f AS a, x.f AS l, y.f AS r, cut_at, 2000000 * h.f // (x.f + y.f) AS score
    FROM halves AS h JOIN f AS x ON x.lang = h.lang AND x.phrase = first_words
    JOIN f AS y ON y.lang = h.lang AND y.phrase = last_words
), worst AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1
), inner_phrases AS (
    SELECT b.lang, array_to_string(b.w[i.i:i.i + m.m - 1], ' ') AS phrase, max(b.f) AS around
    FROM f AS b, (VALUES (1), (2), (3)) AS i(i), (VALUES (2), (3)) AS m(m)
    WHERE m.m < b.k AND i.i + m.m - 1 <= b.k GROUP BY 1, 2
), ranked AS (
    SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
    FROM worst AS w LEFT JOIN inner_phrases AS b ON b.lang = w.lang AND b.phrase = w.phrase
    WHERE b.around IS NULL OR 100 * b.around < 80 * w.a
), totals AS (
    SELECT lang, count(w1) AS n FROM starts GROUP BY lang
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
